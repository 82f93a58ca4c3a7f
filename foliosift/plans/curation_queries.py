"""Queries of duplicate removal, scoring, annotation, joins and the whole run."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import annotations as A
from foliosift.operators import annotate, dedup, joins, scoring
from foliosift.plans import check_sql as q
from foliosift.plans.curation import curate
from foliosift.plans.registry import query
from foliosift.plans.text_queries import cascade_ctes, documents, driver_rules
from foliosift.session import input_partitions, scratch_path, table

# --- Duplicates -----------------------------------------------------------------------


@query(
    "ded1_minhash_signature",
    f"""WITH docs AS (SELECT doc_id, text FROM documents), {q.minhash_ctes('docs')}
        SELECT doc_id, band, key FROM bands""",
)
def _(spark, sf):
    keys = dedup.band_keys(dedup.minhash_signature(documents(spark, sf)))
    return keys.select(
        F.col("first_id").alias("doc_id"), "band",
        F.concat_ws("-", "r0", "r1", "r2", "r3").alias("key"),
    )


@query(
    "ded2_drop_near_duplicates",
    f"""WITH docs AS (SELECT doc_id, text FROM documents), {q.minhash_ctes('docs')}
        SELECT doc_id, text FROM docs SEMI JOIN firsts USING (doc_id) ANTI JOIN near USING (doc_id)""",
)
def _(spark, sf):
    return dedup.drop_near_duplicates(documents(spark, sf))


@query(
    "ded2_mark_duplicates",
    f"""WITH docs AS (SELECT doc_id, text FROM documents), {q.minhash_ctes('docs')}
        SELECT doc_id, CASE WHEN doc_id NOT IN (SELECT doc_id FROM firsts) THEN 'exact_duplicate'
               WHEN doc_id IN (SELECT doc_id FROM near) THEN 'near_duplicate' END AS reject_reason FROM docs""",
)
def _(spark, sf):
    open_docs = documents(spark, sf).withColumn("reject_reason", F.lit(None).cast("string"))
    return dedup.mark_duplicates(open_docs).select("doc_id", "reject_reason")


@query(
    "ded2_shared_and_text_ids",
    f"""WITH docs AS (SELECT row_number() OVER (ORDER BY doc_id // 2, md5(text)) AS doc_id, doc_id // 2 AS shared, text FROM documents),
        {q.minhash_ctes('docs')}
        SELECT 'urn:' || lpad(shared::VARCHAR, 12, '0') AS doc_id, md5(text) AS text_md5
        FROM docs SEMI JOIN firsts USING (doc_id) ANTI JOIN near USING (doc_id)""",
)
def _(spark, sf):
    # Ids are texts, and two neighbours share one.
    urn = F.concat(F.lit("urn:"), F.lpad(F.expr("doc_id div 2").cast("string"), 12, "0"))
    shared = documents(spark, sf).withColumn("doc_id", urn)
    return dedup.drop_near_duplicates(shared).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "ded3_drop_exact_duplicates",
    "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY md5(text)",
)
def _(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return dedup.drop_exact_duplicates(docs).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "win3_keep_first",
    f"""WITH docs AS (SELECT doc_id, text FROM documents), {q.minhash_ctes('docs')}
        SELECT band, key, doc_id AS first_id FROM ranked WHERE doc_id = first_id""",
)
def _(spark, sf):
    firsts = dedup.bucket_first(dedup.band_keys(dedup.minhash_signature(documents(spark, sf))))
    return firsts.select("band", F.concat_ws("-", "r0", "r1", "r2", "r3").alias("key"), "first_id")


# --- Scores -----------------------------------------------------------------------------


def lexical(spark, sf):
    return scoring.score_texts(documents(spark, sf), scoring.LexicalScorer())


@query(
    "udf3_score_lexical",
    f"WITH {q.score_cte()} SELECT doc_id, round(score, 6) AS score, score >= 2.5 AS is_educational FROM scored",
)
def _(spark, sf):
    return lexical(spark, sf).select("doc_id", F.round("score", 6).alias("score"), "is_educational")


@query(
    "udf3_score_ml",
    "SELECT count(*)::BIGINT AS documents, count(*)::BIGINT AS in_range, true AS good_above_bad FROM documents",
)
def _(spark, sf):
    # A fitted model's scores are no matter of SQL; what must hold of them is.
    docs = documents(spark, sf)
    labelled = docs.join(table(spark, sf, "labels", "doc_id", "quality"), "doc_id")
    scorer = scoring.MlScorer.fit(labelled)
    scored = scoring.score_texts(docs, scorer).select("doc_id", "score")
    known = scored.join(table(spark, sf, "labels", "doc_id", "quality"), "doc_id", "left")
    mean = [F.avg(F.when(F.col("quality") == label, F.col("score"))) for label in (0, 1)]
    return known.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("score").between(0, 4)).alias("in_range"),
        (mean[1] > mean[0]).alias("good_above_bad"),
    )


def length_model():
    """A stand-in model: a function of length and of one key word."""

    def predict(texts):
        sizes = np.array([len(t) for t in texts])
        bonus = np.array([1.0 if "the" in t.lower() else 0.0 for t in texts])
        return (sizes % 400) / 100.0 + bonus

    return predict


@query(
    "udf3_score_batch",
    r"""SELECT doc_id, round(score, 6) AS score, score >= 2.5 AS is_educational FROM (
          SELECT doc_id, (length(head) % 400) / 100.0::DOUBLE
                 + CASE WHEN contains(lower(head), 'the') THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM (
            SELECT doc_id, array_to_string(string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')[1:512], ' ') AS head
            FROM documents))""",
)
def _(spark, sf):
    scored = scoring.score_texts(documents(spark, sf), scoring.BatchScorer(length_model))
    return scored.select("doc_id", F.round("score", 6).alias("score"), "is_educational")


# --- Annotations --------------------------------------------------------------------------

_TURNS = "(SELECT conv_id, turn, text FROM conversations)"
_KEYS = ("conv_id", "turn")


def requests(spark, sf):
    return table(spark, sf, "conversations", *_KEYS, "text")


def recorded(spark, sf):
    """Recorded answers per request and task: valid, unknown value, cut off, or absent."""
    turns = requests(spark, sf)
    seed = F.col("conv_id") * 3 + F.col("turn")

    def pick(allowed, shift):
        return F.element_at(F.array(*[F.lit(v) for v in allowed]), (F.pmod(seed + shift, len(allowed)) + 1).cast("int"))

    bad = F.pmod(seed, F.lit(5)) == 0
    answers = {
        "difficulty": F.struct(
            F.concat(F.lit("The user wants item "), F.col("conv_id")).alias("intent"),
            F.lit("general facts").alias("knowledge"),
            F.when(bad, "extreme").otherwise(pick(values.DIFFICULTY_LEVELS, 0)).alias("difficulty"),
        ),
        "quality": F.struct(
            F.lit("short but clear").alias("explanation"),
            F.when(bad, F.lit(None)).otherwise(pick(values.QUALITY_LEVELS, 1)).alias("quality"),
        ),
        "classification": F.struct(
            pick(values.TASK_TAGS, 2).alias("primary_tag"),
            F.array(pick(values.TASK_TAGS, 5), F.when(bad, "Chatting").otherwise(pick(values.TASK_TAGS, 7))).alias("other_tags"),
        ),
    }
    rows = turns.select(
        *_KEYS,
        F.inline(F.array(*[
            F.struct(F.lit(task).alias("task"), F.to_json(body).alias("response"))
            for task, body in answers.items()
        ])),
    )
    cut = F.when(F.pmod(seed, F.lit(7)) == 0, F.expr("left(response, length(response) - 4)")).otherwise(F.col("response"))
    answered = rows.where(F.pmod(seed, F.lit(11)) != 0).withColumn("response", cut)
    # Some got a second answer that says nothing; a valid one has to win over it.
    second = answered.where(F.pmod(seed, F.lit(3)) == 0).withColumn("response", F.lit("~ sorry"))
    return answered.unionByName(second)


def _pick_sql(allowed, shift):
    return f"[{', '.join(q.quote(v) for v in allowed)}][(seed + {shift}) % {len(allowed)} + 1]"


# The checks say which answers are good and what they hold, without going through JSON.
_ANSWERS = f"""answers AS (SELECT conv_id, turn, text, seed, seed % 11 <> 0 AS present, seed % 7 = 0 AS cut, seed % 5 = 0 AS bad,
      'The user wants item ' || conv_id AS intent,
      CASE WHEN seed % 5 = 0 THEN 'extreme' ELSE {_pick_sql(values.DIFFICULTY_LEVELS, 0)} END AS difficulty,
      CASE WHEN seed % 5 = 0 THEN NULL ELSE {_pick_sql(values.QUALITY_LEVELS, 1)} END AS quality,
      {_pick_sql(values.TASK_TAGS, 2)} AS primary_tag,
      {_pick_sql(values.TASK_TAGS, 5)} || '|' || CASE WHEN seed % 5 = 0 THEN 'Chatting' ELSE {_pick_sql(values.TASK_TAGS, 7)} END AS other_tags
    FROM (SELECT *, conv_id * 3 + turn AS seed FROM {_TURNS})),
    checked AS (SELECT *, present AND NOT cut AS parsed, present AND NOT cut AND NOT bad AS valid FROM answers)"""


@query(
    "prj9_build_prompt",
    " UNION ALL ".join(
        f"SELECT conv_id, turn, '{name}' AS task, replace({q.quote(task.template)}, '{{input}}', text) AS prompt FROM {_TURNS}"
        for name, task in A.TASKS.items()
    ),
)
def _(spark, sf):
    prompted = annotate.with_prompts(requests(spark, sf))
    rows = [F.struct(F.lit(n).alias("task"), F.col(f"{n}_prompt").alias("prompt")) for n in A.TASKS]
    return prompted.select(*_KEYS, F.inline(F.array(*rows)))


def _wide(spark, sf):
    return joins.pivot_responses(recorded(spark, sf), _KEYS)


@query(
    "prj10_parse_annotation",
    f"""WITH {_ANSWERS} SELECT conv_id, turn, CASE WHEN parsed THEN intent END AS intent,
          CASE WHEN parsed THEN 'general facts' END AS knowledge, CASE WHEN parsed THEN 'short but clear' END AS explanation,
          CASE WHEN parsed THEN difficulty END AS difficulty, CASE WHEN parsed THEN quality END AS quality,
          CASE WHEN parsed THEN primary_tag END AS primary_tag, CASE WHEN parsed THEN other_tags END AS other_tags
        FROM checked WHERE present""",
)
def _(spark, sf):
    parsed = _wide(spark, sf).select(
        *_KEYS, *[A.parse_annotation(F.col(n), t).alias(n) for n, t in A.TASKS.items()]
    )
    tags = F.col("classification.other_tags")
    return parsed.select(
        *_KEYS, "difficulty.intent", "difficulty.knowledge", "difficulty.difficulty",
        "quality.explanation", "quality.quality",
        "classification.primary_tag",
        F.when(tags.isNotNull(), F.array_join(tags, "|")).alias("other_tags"),
    )


@query(
    "prj11_validate_annotation",
    f"""WITH {_ANSWERS} SELECT conv_id, turn, valid AS difficulty_ok, valid AS quality_ok, valid AS classification_ok
        FROM checked WHERE present""",
)
def _(spark, sf):
    return _wide(spark, sf).select(
        *_KEYS,
        *[A.validate_annotation(A.parse_annotation(F.col(n), t), t).alias(f"{n}_ok") for n, t in A.TASKS.items()],
    )


@query(
    "prj12_with_error_placeholder",
    f"""WITH {_ANSWERS} SELECT conv_id, turn, CASE WHEN valid THEN difficulty END AS difficulty,
          CASE WHEN NOT valid THEN 'Failed to get difficulty' END AS difficulty_error,
          CASE WHEN valid THEN quality END AS quality, CASE WHEN NOT valid THEN 'Failed to get quality' END AS quality_error,
          CASE WHEN valid THEN primary_tag END AS primary_tag,
          CASE WHEN NOT valid THEN 'Failed to get classification' END AS classification_error
        FROM checked WHERE present""",
)
def _(spark, sf):
    records = [A.annotation(F.col(name), task).alias(f"{name}_record") for name, task in A.TASKS.items()]
    return _wide(spark, sf).select(*_KEYS, *records).select(
        *_KEYS, "difficulty_record.difficulty", "quality_record.quality", "classification_record.primary_tag",
        *[F.col(f"{name}_record.error").alias(f"{name}_error") for name in A.TASKS],
    )


_ANNOTATED = f"""WITH {_ANSWERS} SELECT conv_id, turn,
      CASE WHEN valid THEN difficulty END AS difficulty, CASE WHEN NOT valid THEN 'Failed to get difficulty' END AS difficulty_error,
      CASE WHEN valid THEN quality END AS quality, CASE WHEN NOT valid THEN 'Failed to get quality' END AS quality_error,
      CASE WHEN valid THEN primary_tag END AS primary_tag, CASE WHEN NOT valid THEN 'Failed to get classification' END AS tag_error,
      CASE WHEN valid THEN intent END AS intent, CASE WHEN valid THEN 'general facts' END AS knowledge,
      CASE WHEN valid THEN 'short but clear' END AS explanation, CASE WHEN valid THEN other_tags END AS other_tags
    FROM checked"""


def _annotated_columns(df):
    tags = F.col("classification.other_tags")
    return df.select(
        *_KEYS,
        F.col("difficulty_rating.difficulty").alias("difficulty"),
        F.col("difficulty_rating.error").alias("difficulty_error"),
        F.col("quality_rating.quality").alias("quality"),
        F.col("quality_rating.error").alias("quality_error"),
        F.col("classification.primary_tag").alias("primary_tag"),
        F.col("classification.error").alias("tag_error"),
        "difficulty_rating.intent",
        "difficulty_rating.knowledge",
        "quality_rating.explanation",
        F.when(tags.isNotNull(), F.array_join(tags, "|")).alias("other_tags"),
    )


@query("join3_attach_annotations", _ANNOTATED)
def _(spark, sf):
    return _annotated_columns(joins.attach_annotations(requests(spark, sf), recorded(spark, sf), _KEYS))


@query("udf4_annotate_table", _ANNOTATED)
def _(spark, sf):
    annotator = annotate.TableAnnotator(recorded(spark, sf), _KEYS)
    return _annotated_columns(annotator.annotate(requests(spark, sf)))


def sample_client():
    """A stand-in client: answers by prompt length, fails on some prompts."""
    import json

    def call(prompt, schema, **options):
        if len(prompt) % 11 == 0:
            raise RuntimeError("no answer")
        answer = {}
        for name, kind in schema["properties"].items():
            if kind["type"] == "array":
                answer[name] = kind["items"]["enum"][:2]
            elif "enum" in kind:
                answer[name] = kind["enum"][len(prompt) % len(kind["enum"])]
            else:
                answer[name] = f"{len(prompt)} characters"
        return json.dumps(answer)

    return call


def _client_sql():
    columns = []
    for name, field, error in (
        ("difficulty", "difficulty", "difficulty_error"),
        ("quality", "quality", "quality_error"),
        ("classification", "primary_tag", "tag_error"),
    ):
        task = A.TASKS[name]
        n = f"length(replace({q.quote(task.template)}, '{{input}}', text))"
        allowed = dict(task.enums)[field]
        picked = f"[{', '.join(q.quote(v) for v in allowed)}][{n} % {len(allowed)} + 1]"
        columns.append(f"CASE WHEN {n} % 11 <> 0 THEN {picked} END AS {field}")
        columns.append(f"CASE WHEN {n} % 11 = 0 THEN {q.quote(task.error)} END AS {error}")
    n = {name: f"length(replace({q.quote(task.template)}, '{{input}}', text))" for name, task in A.TASKS.items()}
    said = f"CASE WHEN {n['difficulty']} % 11 <> 0 THEN {n['difficulty']} || ' characters' END"
    columns += [f"{said} AS intent", f"{said} AS knowledge"]
    columns.append(f"CASE WHEN {n['quality']} % 11 <> 0 THEN {n['quality']} || ' characters' END AS explanation")
    columns.append(f"CASE WHEN {n['classification']} % 11 <> 0 THEN {q.quote('|'.join(values.TASK_TAGS[:2]))} END AS other_tags")
    return f"SELECT conv_id, turn, {', '.join(columns)} FROM {_TURNS}"


@query("udf4_annotate_callable", _client_sql())
def _(spark, sf):
    annotator = annotate.CallableAnnotator(sample_client, attempts=2)
    return _annotated_columns(annotator.annotate(requests(spark, sf)))


@query("udf4_annotate_stored", _client_sql())
def _(spark, sf):
    # A first run over a third of the turns, then one over all: it asks for the rest.
    annotator = annotate.StoredAnnotator(annotate.CallableAnnotator(sample_client, attempts=2), scratch_path(spark, "answers"), wave=500)
    turns = requests(spark, sf)
    annotator.annotate(turns.where(F.col("conv_id") % 3 == 0))
    return _annotated_columns(annotator.annotate(turns))


# --- Joins by key -------------------------------------------------------------------------


@query(
    "join1_attach_scores",
    f"""WITH {q.score_cte()} SELECT doc_id, length(text)::INTEGER AS characters, round(score, 6) AS score FROM scored""",
)
def _(spark, sf):
    scores = lexical(spark, sf).select("doc_id", "score")
    return joins.attach_scores(table(spark, sf, "documents", "doc_id", "text"), scores).select(
        "doc_id", F.length("text").alias("characters"), F.round("score", 6).alias("score")
    )


@query(
    "join2_alignment_audit",
    """SELECT doc_id, 'right' AS missing_from FROM documents ANTI JOIN labels USING (doc_id)
       UNION ALL SELECT doc_id, 'left' FROM labels ANTI JOIN documents USING (doc_id)""",
)
def _(spark, sf):
    return joins.alignment_audit(table(spark, sf, "documents", "doc_id"), table(spark, sf, "labels", "doc_id"))


@query(
    "join4_attach_truth",
    f"""WITH {q.score_cte()} SELECT doc_id, round(score, 6) AS score, 4.0 * quality::DOUBLE AS truth
        FROM scored JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    truth = table(spark, sf, "labels", "doc_id", "quality").select("doc_id", (4.0 * F.col("quality")).alias("truth"))
    scored = lexical(spark, sf).select("doc_id", F.round("score", 6).alias("score"))
    return joins.attach_truth(scored, truth)


@query(
    "join5_original_values",
    """SELECT l_orderkey, l_linenumber, p_partkey AS id, p_size::INTEGER AS original_value
       FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS k FROM lineitem)
       JOIN part ON p_partkey = k""",
)
def _(spark, sf):
    # A third of the rows share one key.
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey"))
    rows = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select(
        "l_orderkey", "l_linenumber", key.cast("bigint").alias("id")
    )
    source = table(spark, sf, "part", "p_partkey", "p_size").toDF("id", "value")
    return joins.original_values(rows, source)


# --- Whole run ----------------------------------------------------------------------------


def _doc_answers(spark, sf):
    """Recorded answers for documents, in the same manner as for conversations."""
    docs = table(spark, sf, "documents", "doc_id")
    level = F.element_at(F.array(*[F.lit(v) for v in values.QUALITY_LEVELS]), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.where("doc_id % 4 <> 0").select(
        "doc_id", F.lit("quality").alias("task"),
        F.to_json(F.struct(F.lit("as recorded").alias("explanation"), level.alias("quality"))).alias("response"),
    )


def run_everything(spark, sf):
    return curate(
        table(spark, sf, "documents", "doc_id", "text"),
        driver_rules(),
        scoring.LexicalScorer(),
        annotate.TableAnnotator(_doc_answers(spark, sf)),
        scratch_path(spark, "curated"),
        partitions=input_partitions(spark),
    )


def _kept_ctes():
    dup = q.minhash_ctes("passed", t="text_clean")
    return f"""{cascade_ctes()},
      passed AS MATERIALIZED (SELECT doc_id, text_clean FROM judged WHERE reject_reason IS NULL), {dup},
      kept AS (SELECT doc_id, text_clean FROM passed SEMI JOIN firsts USING (doc_id) ANTI JOIN near USING (doc_id))"""


@query(
    "prj16_assemble_result",
    f"""WITH {_kept_ctes()}, {q.score_cte('kept', 'text_clean')}
        SELECT md5(text_clean) AS text_md5, round(score, 6) AS score, score >= 2.5 AS is_educational,
               'Failed to get difficulty' AS difficulty_error,
               CASE WHEN doc_id % 4 <> 0 THEN [{', '.join(q.quote(v) for v in values.QUALITY_LEVELS)}][doc_id % 5 + 1] END AS quality,
               CASE WHEN doc_id % 4 = 0 THEN 'Failed to get quality' END AS quality_error
        FROM scored""",
)
def _(spark, sf):
    results = run_everything(spark, sf).results
    return results.select(
        F.md5("text").alias("text_md5"), F.round("score", 6).alias("score"), "is_educational",
        F.col("difficulty_rating.error").alias("difficulty_error"),
        F.col("quality_rating.quality").alias("quality"),
        F.col("quality_rating.error").alias("quality_error"),
    )


@query(
    "curate_reasons",
    f"""WITH {_kept_ctes()},
        all_reasons AS (
          SELECT reject_reason FROM judged WHERE reject_reason IS NOT NULL
          UNION ALL SELECT CASE WHEN doc_id NOT IN (SELECT doc_id FROM firsts) THEN 'exact_duplicate'
                                WHEN doc_id IN (SELECT doc_id FROM near) THEN 'near_duplicate' END FROM passed)
        SELECT reject_reason, count(*)::BIGINT AS documents FROM all_reasons WHERE reject_reason IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return run_everything(spark, sf).reasons
