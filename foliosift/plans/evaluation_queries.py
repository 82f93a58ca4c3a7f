"""Queries of score functions, evaluation reports and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import scores
from foliosift.operators import evaluate
from foliosift.operators.scoring import LexicalScorer, score_texts
from foliosift.plans import check_sql as q
from foliosift.plans.curation_queries import lexical
from foliosift.plans.registry import query
from foliosift.plans.text_queries import documents
from foliosift.session import table
from foliosift.sources.readers import read_labelled

# Scores over the whole line items, with exact halves and values outside 0 to 4.
_RAW = "(SELECT l_orderkey, l_linenumber, l_quantity / 10.0::DOUBLE - 0.5::DOUBLE AS s FROM lineitem)"


def raw_scores(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 10.0 - 0.5).alias("s")
    )


@query("prj13_clip_score", f"SELECT l_orderkey, l_linenumber, {q.clip('s')}::DOUBLE AS clipped FROM {_RAW}")
def _(spark, sf):
    return raw_scores(spark, sf).select("l_orderkey", "l_linenumber", scores.clip_score(F.col("s")).alias("clipped"))


@query("prj14_score_class", f"SELECT l_orderkey, l_linenumber, {q.grade('s')} AS grade FROM {_RAW}")
def _(spark, sf):
    return raw_scores(spark, sf).select("l_orderkey", "l_linenumber", scores.score_class(F.col("s")).alias("grade"))


@query("prj15_is_educational", f"SELECT l_orderkey, l_linenumber, s >= 2.5 AS is_educational FROM {_RAW}")
def _(spark, sf):
    return raw_scores(spark, sf).select("l_orderkey", "l_linenumber", scores.is_educational(F.col("s")).alias("is_educational"))


@query("agg4_corpus_size", "SELECT count(*)::BIGINT AS documents, sum(length(text))::BIGINT AS characters FROM documents")
def _(spark, sf):
    return evaluate.corpus_size(table(spark, sf, "documents", "text"))


@query(
    "agg5_educational_ratio",
    f"""WITH {q.score_cte()} SELECT count(*) FILTER (score >= 2.5)::BIGINT AS educational, count(*)::BIGINT AS total,
        round(100.0 * count(*) FILTER (score >= 2.5) / count(*)::DOUBLE, 6)::DOUBLE AS percent FROM scored""",
)
def _(spark, sf):
    return evaluate.educational_ratio(lexical(spark, sf)).withColumn("percent", F.round("percent", 6))


_EDGES = [0.4 * i for i in range(11)]


@query(
    "agg6_score_histogram",
    f"""WITH {q.score_cte()}, edges AS (SELECT unnest(range(1, 11)) AS bin),
        binned AS (SELECT {' + '.join(f'(greatest(0.0, least(4.0, score)) >= {e!r}::DOUBLE)::INTEGER' for e in _EDGES[1:-1])} + 1 AS bin FROM scored),
        counted AS (SELECT edges.bin, count(binned.bin) AS n FROM edges LEFT JOIN binned USING (bin) GROUP BY 1)
        SELECT bin::INTEGER AS bin, round((bin - 1) * 0.4::DOUBLE, 6) AS bin_start, round(bin * 0.4::DOUBLE, 6) AS bin_end, n::BIGINT AS documents,
               coalesce(floor(n / nullif((SELECT max(n) FROM counted) / 20.0::DOUBLE, 0)), 0)::INTEGER AS stars FROM counted""",
)
def _(spark, sf):
    return evaluate.score_histogram(lexical(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("bin_start", "bin_end")}
    )


# --- Predictions against labels -----------------------------------------------------------

_GRADED = f"""WITH {q.score_cte()}, pairs AS (SELECT {q.grade('score')} AS p, {q.grade('4.0 * quality::DOUBLE')} AS a
        FROM scored JOIN labels USING (doc_id))"""
_BINARY = f"""WITH {q.score_cte()}, pairs AS (SELECT (score >= 2.5)::INTEGER AS p, (4.0 * quality >= 2.5)::INTEGER AS a
        FROM scored JOIN labels USING (doc_id))"""


def evaluated(spark, sf):
    labelled = read_labelled(documents(spark, sf), table(spark, sf, "labels", "doc_id", "quality"))
    return score_texts(labelled, LexicalScorer())


def _matrix_sql(labels):
    cells = ", ".join(f"count(*) FILTER (p = {x})::BIGINT AS pred_{x}" for x in labels)
    return f"""SELECT g.a::INTEGER AS actual, {', '.join(f'coalesce(pred_{x}, 0)::BIGINT AS pred_{x}' for x in labels)}
        FROM (SELECT unnest({list(labels)}) AS a) g LEFT JOIN (SELECT a, {cells} FROM pairs GROUP BY a) m ON g.a = m.a"""


def _report_sql(labels):
    return f""", g AS (SELECT unnest({list(labels)}) AS label),
      c AS (SELECT label, (SELECT count(*) FROM pairs WHERE a = label AND p = label) AS hits,
                   (SELECT count(*) FROM pairs WHERE a = label) AS support, (SELECT count(*) FROM pairs WHERE p = label) AS predicted FROM g),
      m AS (SELECT label, hits, support, coalesce(hits / nullif(predicted, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall FROM c),
      f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m),
      r AS (SELECT label::VARCHAR AS label, precision, recall, f1, support FROM f
        UNION ALL SELECT 'accuracy', sum(hits) / sum(support)::DOUBLE, sum(hits) / sum(support)::DOUBLE, sum(hits) / sum(support)::DOUBLE, sum(support) FROM f
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)
      SELECT label, round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall, round(f1, 6)::DOUBLE AS f1, support::BIGINT AS support FROM r"""


def _rounded(report):
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("agg7_confusion_5_class", f"{_GRADED} {_matrix_sql(values.SCORE_CLASSES)}")
def _(spark, sf):
    return evaluate.confusion_matrix(evaluate.graded_pairs(evaluated(spark, sf)), values.SCORE_CLASSES)


@query("agg8_report_5_class", f"{_GRADED}{_report_sql(values.SCORE_CLASSES)}")
def _(spark, sf):
    return _rounded(evaluate.classification_report(evaluate.graded_pairs(evaluated(spark, sf)), values.SCORE_CLASSES))


@query("agg9_confusion_binary", f"{_BINARY} {_matrix_sql((0, 1))}")
def _(spark, sf):
    return evaluate.confusion_matrix(evaluate.binary_pairs(evaluated(spark, sf)), (0, 1))


@query("agg10_report_binary", f"{_BINARY}{_report_sql((0, 1))}")
def _(spark, sf):
    return _rounded(evaluate.classification_report(evaluate.binary_pairs(evaluated(spark, sf)), (0, 1)))


@query(
    "agg11_key_metrics",
    f"""{_BINARY}, s AS (SELECT count(*) FILTER (a = 1 AND p = 1) AS tp, count(*) FILTER (p = 1) AS pp, count(*) FILTER (a = 1) AS ap,
                            count(*) FILTER (a = p) AS ok, count(*) AS n FROM pairs)
        SELECT 'Precision' AS metric, round(coalesce(tp / nullif(pp, 0)::DOUBLE, 0), 4)::DOUBLE AS value FROM s
        UNION ALL SELECT 'Recall', round(coalesce(tp / nullif(ap, 0)::DOUBLE, 0), 4)::DOUBLE FROM s
        UNION ALL SELECT 'F1-score', round(coalesce(2 * tp / nullif(pp + ap, 0)::DOUBLE, 0), 4)::DOUBLE FROM s
        UNION ALL SELECT 'Accuracy', round(coalesce(ok / nullif(n, 0)::DOUBLE, 0), 4)::DOUBLE FROM s""",
)
def _(spark, sf):
    return evaluate.key_metrics(evaluate.binary_pairs(evaluated(spark, sf)))


@query(
    "agg15_loss_and_accuracy",
    f"""WITH {q.score_cte()} SELECT round(avg((score - 4.0 * quality) ** 2), 6)::DOUBLE AS mean_loss,
        round(100.0 * avg(((score >= 2.5) = (quality = 1))::INTEGER), 6)::DOUBLE AS accuracy FROM scored JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    loss = (F.col("score") - F.col("truth")) * (F.col("score") - F.col("truth"))
    report = evaluate.loss_and_accuracy(
        evaluated(spark, sf), loss, F.col("is_educational"), F.col("truth") >= 2.5
    )
    return report.select(F.round("mean_loss", 6).alias("mean_loss"), F.round("accuracy", 6).alias("accuracy"))


@query(
    "srt1_extreme_examples",
    f"""WITH {q.score_cte()}, r AS (SELECT doc_id, round(score, 6) AS score, round({q.clip('score')}, 6)::DOUBLE AS clipped_score,
            score >= 2.5 AS is_educational, left(text, 200) || '...' AS preview,
            row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS hi, row_number() OVER (ORDER BY round(score, 6), doc_id DESC) AS lo FROM scored)
        SELECT doc_id, score, clipped_score, is_educational, preview, 'high' AS side FROM r WHERE hi <= 3
        UNION ALL SELECT doc_id, score, clipped_score, is_educational, preview, 'low' FROM r WHERE lo <= 3""",
)
def _(spark, sf):
    # Rounded first, so that both engines break ties between equal scores alike.
    scored = lexical(spark, sf).withColumn("score", F.round("score", 6))
    return evaluate.extreme_examples(scored).withColumn("clipped_score", F.round("clipped_score", 6))


@query(
    "srt1_extreme_unusable",
    """WITH s AS (SELECT doc_id, text, length(text)::DOUBLE AS score FROM documents WHERE doc_id % 3 = 2),
       r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS hi, row_number() OVER (ORDER BY score, doc_id DESC) AS lo FROM s)
       SELECT doc_id, score, left(text, 200) || '...' AS preview, 'high' AS side FROM r WHERE hi <= 3
       UNION ALL SELECT doc_id, score, left(text, 200) || '...', 'low' FROM r WHERE lo <= 3""",
)
def _(spark, sf):
    # A third of the scores is null, a third is NaN: neither may be the highest or the lowest.
    score = F.when(F.col("doc_id") % 3 == 1, F.lit(float("nan"))).when(F.col("doc_id") % 3 == 2, F.length("text").cast("double"))
    scored = table(spark, sf, "documents", "doc_id", "text").withColumn("score", score)
    return evaluate.extreme_examples(scored.withColumn("is_educational", F.col("score") >= 2.5)).select(
        "doc_id", "score", "preview", "side"
    )


@query("src5_read_labelled", "SELECT doc_id, md5(text) AS text_md5, 4.0 * quality::DOUBLE AS truth FROM documents JOIN labels USING (doc_id)")
def _(spark, sf):
    labelled = read_labelled(table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels", "doc_id", "quality"))
    return labelled.select("doc_id", F.md5("text").alias("text_md5"), "truth")
