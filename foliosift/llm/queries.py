"""The registered queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosift.llm import (
    exact_dedup,
    language_mixture,
    license_digest,
    line_windows,
    near_dup_forest,
    prefix_forest,
    pu_quality,
    sentencepiece_nbest,
    source_mix,
    spelling_variants,
    token_alignment,
    token_files,
    url_filter,
)
from foliosift.llm.common import crc_bucket
from foliosift.llm.known_licenses import LICENSES
from foliosift.llm.known_licenses import known as known_licenses
from foliosift.session import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The four best segmentations of every document, and whether decoding gives the text back."""
    vocabulary = sentencepiece_nbest.Vocabulary.load()
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = sentencepiece_nbest.decode(sentencepiece_nbest.encode(docs, vocabulary), vocabulary)
    return found.select(
        "doc_id",
        F.size("ids").alias("n_pieces"),
        "score",
        F.transform("alternatives", lambda a: a["score"]).alias("next_scores"),
        F.xxhash64("ids").alias("ids_hash"),
        F.xxhash64("alternatives").alias("alternatives_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


#: Fixed values of the query: (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@_query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, folder, "pages", "page_id", "url"), rules)


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
CHECKS["op2_url_filter"] = rf"""
WITH rest AS (
  SELECT page_id, row_number() OVER () AS r,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
met AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM parsed LEFT JOIN met USING (r)"""


@_query
def op3_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_windows.remove_repeats(table(spark, folder, "documents", "doc_id", "text"))
    return cleaned.select(
        "doc_id", "lines", F.size("removed").alias("lines_removed"), F.sha2("text", 256).alias("text_sha256")
    )


CHECKS["op3_line_windows"] = r"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i AS pos, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM doc WHERE len(l) >= 3)
  WHERE regexp_matches(l[i] || l[i + 1] || l[i + 2], '[^\x20\x09-\x0D]')),
later AS (
  SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1),
covered AS (
  SELECT doc_id, list_distinct(list_concat(list(pos), list(pos + 1), list(pos + 2))) AS gone FROM later GROUP BY doc_id)
SELECT doc.doc_id, len(l)::INT AS lines, len(coalesce(gone, []))::INT AS lines_removed,
       sha256(CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
         [l[i] FOR i IN range(1, len(l) + 1) IF NOT list_contains(gone, i)], chr(10)), '') END) AS text_sha256
FROM doc LEFT JOIN covered USING (doc_id)"""


def _language_rows(docs: DataFrame) -> DataFrame:
    """The rows that languages are learned from."""
    return docs.where((crc_bucket("doc_id", 3) != 1) & F.col("lang").isNotNull())


@_query
def op4_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = language_mixture.fit(_language_rows(docs))
    held_out = F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return language_mixture.identify(docs.drop("lang"), model).select(
        "doc_id", held_out, "lang_pred", "score", "languages", "shares"
    )


@_query
def op5_near_dup_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup_forest.classes(table(spark, folder, "documents", "doc_id", "text"))


CHECKS["op5_near_dup_forest"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(lower(text), '\s+') IF x <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y, p.s = q.s AS equal, md5(array_to_string(q.s, '|')) AS key FROM pairs
  JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE k >= 0.8 * (len(p.s) + len(q.s) - k) - 1e-6),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT y, root FROM reach JOIN links ON x = reach.doc_id),
class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY 1),
counts AS (
  SELECT x, count(*) AS n_links, count(DISTINCT key) FILTER (NOT equal) AS n_linked_texts FROM links GROUP BY 1)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size,
       coalesce(n_links, 0) AS n_links, coalesce(n_linked_texts, 0) AS n_linked_texts
FROM class LEFT JOIN counts ON x = doc_id"""


@_query
def op6_license_digest(spark: SparkSession, folder: str) -> DataFrame:
    known = spark.createDataFrame(known_licenses(), "name string, text string")
    return license_digest.scan(table(spark, folder, "documents", "doc_id", "text"), known)


def _canonical_sql(text: str) -> str:
    line = license_digest.COPYRIGHT_LINE.replace("'", "''")
    out = f"regexp_replace(' ' || regexp_replace(lower(coalesce({text}, '')), '{line}', '', 'g') || ' ', '{license_digest.NOT_WORD}', ' ', 'g')"
    for variant, standard in license_digest.SPELLINGS:
        for _ in range(2):  # neighbours share a space
            out = f"replace({out}, ' {variant} ', ' {standard} ')"
    return out


_LICENSE_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in LICENSES)
CHECKS["op6_license_digest"] = f"""
WITH known(name, text) AS (VALUES {_LICENSE_ROWS}),
digests AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(name) AS license FROM known GROUP BY 1),
forms AS (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents)
SELECT doc_id, CASE WHEN form <> ' ' THEN sha256(form) END AS canonical_sha256, license
FROM forms LEFT JOIN digests ON form <> ' ' AND digest = sha256(form)"""


@_query
def op6_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Known licenses and notices that stand as whole lines inside the documents."""
    known = spark.createDataFrame(known_licenses(), "name string, text string")
    return license_digest.notices(table(spark, folder, "documents", "doc_id", "text"), known)


CHECKS["op6_license_notices"] = f"""
WITH known(name, text) AS (VALUES {_LICENSE_ROWS}),
wanted AS (SELECT trim({_canonical_sql("text")}) || ' ' AS w, min(name) AS license FROM known GROUP BY 1),
doc AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT r, unnest(l) AS text, unnest(range(1, len(l) + 1)) AS i FROM doc),
form AS (SELECT r, i, ltrim({_canonical_sql("text")}) AS f FROM line),
part AS (SELECT * FROM form WHERE f <> ''),
rest AS (
  SELECT r, string_agg(f, '' ORDER BY i) OVER later AS f, len(string_agg(f, '' ORDER BY i) OVER later) AS n
  FROM part WINDOW later AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
ends AS (SELECT r, n FROM rest UNION SELECT r, 0 FROM rest),
met AS (
  SELECT DISTINCT rest.r, license FROM rest JOIN wanted ON starts_with(f, w)
  JOIN ends ON ends.r = rest.r AND ends.n = rest.n - len(w)),
all_of AS (SELECT r, list_sort(list(license)) AS licenses FROM met GROUP BY r)
SELECT doc_id, coalesce(licenses, []) AS licenses FROM doc LEFT JOIN all_of USING (r)"""


@_query
def op7_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Positives are labels of the rows not held out; unlabelled are the rows without any
    label, which are not held out either."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    learned = crc_bucket("doc_id", 5) != 0
    trusted = labels.where(learned & (F.col("quality") == 1)).select("doc_id")
    unlabelled = docs.select("doc_id").where(learned).join(labels.select("doc_id"), "doc_id", "left_anti")
    model = pu_quality.fit(docs, trusted, unlabelled)
    return pu_quality.score(docs, model).select(
        "doc_id",
        F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark(table(spark, folder, "documents", "doc_id", "text"))


CHECKS["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))"""


@_query
def op9_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return prefix_forest.nearest(vectors, F.col("vec_id") % 100 == 0)


@_query
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix(table(spark, folder, "documents", "doc_id", "text", "source"))


def _seats_sql(name: str, parties: str, group: str, party: str) -> str:
    """All quotients of all parties, ranked: (group, party, quota) from (…, w, seats)."""
    return f"""{name} AS (
  SELECT {group}, {party}, count(*) AS quota FROM (
    SELECT {group}, {party}, seats, row_number() OVER (PARTITION BY {group} ORDER BY w / (2 * seat - 1) DESC, {party}, seat) AS rank
    FROM (SELECT *, unnest(range(1, seats + 1)) AS seat FROM {parties} WHERE w > 0))
  WHERE rank <= seats GROUP BY 1, 2)"""


CHECKS["op10_source_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('0|' || coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, source_size::DOUBLE * 2.0 AS cap FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (SELECT arg_min(level, (cap / weight, place)) FILTER (level <= cap / weight) AS level FROM levels),
targets AS (
  SELECT source, place, source_size, least(cap, coalesce(weight * final.level, cap)) AS target FROM weighed, final),
placed AS (
  SELECT s.*, place, source_size, target,
         ('0x' || substr(md5('shard|' || key), 1, 8))::BIGINT % greatest(1, ceil(source_size / 1000000)::BIGINT) AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shards AS (SELECT place, shard // 1024 AS rack, shard, sum(size)::BIGINT AS words FROM placed GROUP BY ALL),
p1 AS (SELECT 0 AS every, place, target AS w, round((SELECT sum(target) FROM targets) / 32)::BIGINT AS seats FROM targets),
{_seats_sql("q1", "p1", "every", "place")},
p2 AS (
  SELECT place, rack, sum(words)::DOUBLE AS w, any_value(quota) AS seats FROM shards JOIN q1 USING (place) GROUP BY place, rack),
{_seats_sql("q2", "p2", "place", "rack")},
p3 AS (
  SELECT (place, rack) AS whole, shard, words::DOUBLE AS w, quota AS seats FROM shards JOIN q2 USING (place, rack)),
{_seats_sql("q3", "p3", "whole", "shard")},
quotas AS (
  SELECT place, s.shard, words, ceil(words / 32)::BIGINT AS blocks, least(quota, 2 * ceil(words / 32)::BIGINT) AS quota
  FROM shards s JOIN q3 ON whole = (s.place, s.rack) AND q3.shard = s.shard),
started AS (
  SELECT *, quota % blocks AS rest,
         ('0x' || substr(md5('start|0|' || place || '|' || shard), 1, 8))::BIGINT % blocks AS start FROM quotas),
stream AS (
  SELECT p.*, sum(size) OVER (PARTITION BY place, shard ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop
  FROM placed p)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 OR quota IS NULL THEN 0 ELSE (quota // blocks) * size
         + greatest(0, least(least(start + rest, blocks) * 32, stop) - greatest(start * 32, stop - size))
         + greatest(0, least(greatest(start + rest - blocks, 0) * 32, stop) - greatest(0, stop - size)) END)::BIGINT AS taken
FROM stream LEFT JOIN started USING (place, shard)"""


@_query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.link_counts(table(spark, folder, "documents", "doc_id", "text"))


#: Fixed values of the query: letters, least length and count, one run in so many loses a letter.
RUN_LETTERS = "[A-Za-zÀ-ÿ]"
RUN_LENGTH, RUN_COUNT, RUN_NOISE = 7, 2, 31


def spelled_words(docs: DataFrame) -> DataFrame:
    """(word, n): the runs, of which those whose checksum (with the id; a null id reads as
    nothing) ``RUN_NOISE`` divides lack a letter."""
    runs = spelling_variants.runs(docs, RUN_LETTERS, RUN_LENGTH)
    checksum = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % RUN_NOISE == 0, short).otherwise(F.col("run"))
    words = runs.select("run", checksum.alias("h")).select(word.alias("word")).where(F.length("word") >= RUN_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= RUN_COUNT)


@_query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.group(spelled_words(table(spark, folder, "documents", "doc_id", "text")))


# Independent of the engine's way: near words are found by the words left after deleting each letter.
CHECKS["op12_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)),
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS t),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
run AS (SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM found WHERE length(run) >= 7),
hashed AS (
  SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
    lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1]))) AS h FROM run, crc),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
word AS (SELECT word, count(*) AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
gone AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM word)),
pair AS (
  SELECT a.word AS word, b.word AS near FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT gone.word, word.word FROM gone JOIN word ON rest = word.word
  UNION SELECT word.word, gone.word FROM gone JOIN word ON rest = word.word),
best AS (
  SELECT pair.word, count(*) AS n_near, arg_min(near, (-word.n, near)) AS near, max(word.n) AS near_n
  FROM pair JOIN word ON word.word = near GROUP BY pair.word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM word LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS steps FROM judged
  UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN judged ON here = judged.word WHERE form IS NOT NULL)
SELECT word, form, (SELECT arg_max(here, steps) FROM walk WHERE walk.word = judged.word) AS root, n, n_near, form_n FROM judged"""


@_query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents", "doc_id", "text"), path)
    return token_files.read(spark, path, with_ids=False)


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
