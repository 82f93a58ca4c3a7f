"""Queries of record tables, files and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import records
from foliosift.operators import items, numbering
from foliosift.plans import check_sql as q
from foliosift.plans.curation_queries import _doc_answers, lexical
from foliosift.plans.registry import query
from foliosift.session import input_partitions, scratch_path, spread, table
from foliosift.operators.annotate import TableAnnotator, assemble_result
from foliosift.sources import readers, writers

_PART = "(SELECT p_partkey AS id, p_name AS name, p_size AS value FROM part)"
# Items with gaps: every 7th name empty, every 11th value 0, every 13th id missing.
_GAPS = """(SELECT CASE WHEN p_partkey % 13 <> 5 THEN p_partkey END AS id,
    CASE WHEN p_partkey % 7 = 3 THEN '' ELSE p_name END AS name,
    CASE WHEN p_partkey % 11 = 2 THEN 0 ELSE p_size END AS value, p_partkey FROM part)"""


def part_items(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_name", "p_size").toDF("id", "name", "value")


def gappy_items(spark, sf):
    key = F.col("p_partkey")
    return table(spark, sf, "part", "p_partkey", "p_name", "p_size").select(
        F.when(key % 13 != 5, key).alias("id"),
        F.when(key % 7 == 3, "").otherwise(F.col("p_name")).alias("name"),
        F.when(key % 11 == 2, 0).otherwise(F.col("p_size")).alias("value"),
        "p_partkey",
    )


# --- Sources ------------------------------------------------------------------------------


@query("src1_read_json_corpus", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def _(spark, sf):
    # Documents as many JSON array files of at most 250 entries, with entries to skip in each.
    path = scratch_path(spark, "arrays")
    docs = table(spark, sf, "documents", "doc_id", "text")
    arrays = docs.groupBy(F.floor(F.col("doc_id") / 250).alias("file")).agg(
        F.concat(
            F.lit('["stray", {"note": 1}, '),
            F.array_join(F.collect_list(F.to_json(F.struct("doc_id", "text"))), ", "),
            F.lit("]"),
        ).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    corpus = readers.read_json_corpus(spark, f"{path}/*", id_field="doc_id")
    return corpus.select("doc_id", F.md5("text").alias("text_md5"))


@query("src1_read_one_array", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def _(spark, sf):
    # All documents in one array of one line, written by many tasks as the parts of that line, in
    # order. Rows of one id are spread as well.
    path = scratch_path(spark, "array")
    docs = table(spark, sf, "documents", "doc_id", "text")
    docs = docs.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    entry = F.concat(F.when(F.monotonically_increasing_id() == 0, F.lit("[")).otherwise(F.lit(",")), F.to_json(F.struct("doc_id", "text")))
    end = spark.range(1, numPartitions=1).select(F.lit("]").alias("value"))
    docs.select(entry.alias("value")).unionByName(end).write.text(path, lineSep=" ")
    corpus = readers.read_json_corpus(spark, path, id_field="doc_id", joined=True)
    return corpus.select("doc_id", F.md5("text").alias("text_md5"))


@query("src1_read_jsonl_corpus", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "documents", "doc_id", "text").write.json(path)
    corpus = readers.read_json_corpus(spark, path, lines=True, id_field="doc_id")
    return corpus.select("doc_id", F.md5("text").alias("text_md5"))


@query("src2_require_input", "SELECT doc_id, n_chars FROM documents")
def _(spark, sf):
    return readers.require_input(table(spark, sf, "documents", "doc_id", "n_chars"))


@query(
    "src3_read_json_objects",
    "SELECT event_id, (json_extract(props, '$.k'))::INTEGER AS k FROM events",
)
def _(spark, sf):
    path = scratch_path(spark, "objects")
    rows = table(spark, sf, "events", "event_id", "props").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    rows.write.json(path)
    objects = readers.read_json_objects(
        spark, path, strict=True, schema="event_id bigint, props struct<k: int>", lines=True
    )
    return objects.select("event_id", F.col("props.k").alias("k"))


_PARTIES = """SELECT 'customer' AS category, c_custkey AS id, c_name AS name, c_nationkey AS value FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier"""


def _party(spark, sf, name):
    key = {"customer": "c_custkey", "supplier": "s_suppkey"}[name]
    p = key[0]
    return table(spark, sf, name, key, f"{p}_name", f"{p}_nationkey").toDF("id", "name", "value")


@query("src4_read_many", _PARTIES)
def _(spark, sf):
    paths = {}
    for name in ("customer", "supplier"):
        paths[name] = scratch_path(spark, name)
        _party(spark, sf, name).write.json(paths[name])
    return readers.read_many(spark, paths, "id bigint, name string, value int")


@query("set1_union_items", _PARTIES)
def _(spark, sf):
    parties = [_party(spark, sf, n).withColumn("category", F.lit(n)) for n in ("customer", "supplier")]
    return parties[0].unionByName(parties[1])


# --- Sinks, read back ------------------------------------------------------------------------


@query("snk1_write_texts_jsonl", "SELECT text FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "texts")
    writers.write_texts_jsonl(table(spark, sf, "documents", "text"), path)
    return spark.read.schema("text string").json(path)


@query(
    "snk2_write_results_jsonl",
    f"""WITH {q.score_cte()} SELECT md5(text) AS text_md5, round(score, 6) AS score, score >= 2.5 AS is_educational,
          'Failed to get difficulty' AS difficulty_error,
          CASE WHEN doc_id % 4 <> 0 THEN [{', '.join(q.quote(v) for v in values.QUALITY_LEVELS)}][doc_id % 5 + 1] END AS quality
        FROM scored""",
)
def _(spark, sf):
    path = scratch_path(spark, "results")
    annotated = TableAnnotator(_doc_answers(spark, sf)).annotate(lexical(spark, sf))
    final = assemble_result(annotated)
    writers.write_results_jsonl(final, path)
    return spark.read.schema(final.schema).json(path).select(
        F.md5("text").alias("text_md5"), F.round("score", 6).alias("score"), "is_educational",
        F.col("difficulty_rating.error").alias("difficulty_error"),
        F.col("quality_rating.quality").alias("quality"),
    )


@query("snk3_write_json", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "pretty")
    writers.write_json(table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice"), path, pretty=True)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    # Indented objects follow each other in a file; a closing brace in column one ends each.
    objects = spark.read.option("lineSep", "\n}").text(path).where("trim(value) <> '' AND value <> '\n'")
    return objects.select(F.from_json(F.concat("value", F.lit("\n}")), schema).alias("o")).select("o.*")


@query(
    "snk4_write_chunks",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS chunk FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "chunks")
    writers.write_chunks(numbering.chunk(table(spark, sf, "orders", "o_orderkey"), 4000, ["o_orderkey"]), path)
    return spark.read.schema("o_orderkey bigint, chunk bigint").json(path)


@query(
    "snk5_write_recovery_report",
    f"""SELECT 'processed' AS part, count(*)::BIGINT AS items, sum(value * 2)::BIGINT AS total FROM {_GAPS} WHERE id IS NOT NULL AND name <> ''
        UNION ALL SELECT 'failed', count(*)::BIGINT, sum(value)::BIGINT FROM {_GAPS} WHERE id IS NULL OR name = ''
        UNION ALL SELECT 'summary', count(*)::BIGINT, count(*) FILTER (id IS NOT NULL AND name <> '')::BIGINT FROM {_GAPS}""",
)
def _(spark, sf):
    path = scratch_path(spark, "report")
    validated = items.validate_items(gappy_items(spark, sf))
    writers.write_recovery_report(validated, items.double_value, path)
    summary = spark.read.schema("total_input bigint, successful bigint, failed bigint").json(f"{path}/summary")
    parts = summary.select(
        F.lit("summary").alias("part"), F.col("total_input").alias("items"), F.col("successful").alias("total")
    )
    for name in ("processed", "failed"):
        rows = spark.read.schema("value bigint").json(f"{path}/{name}")
        parts = parts.unionByName(
            rows.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("items"), F.sum("value").alias("total"))
        )
    return parts


# --- Record shape and status --------------------------------------------------------------


@query(
    "prj7_flatten",
    """SELECT o_orderkey AS "order.key", o_custkey AS "order.customer.key", o_totalprice AS "order.customer.total", o_orderstatus AS status FROM orders""",
)
def _(spark, sf):
    nested = table(spark, sf, "orders").select(
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.struct(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("total")).alias("customer"),
        ).alias("order"),
        F.col("o_orderstatus").alias("status"),
    )
    return records.flatten(nested)


@query(
    "prj7_flatten_json",
    """SELECT event_id, 'type' AS path, event_type AS value FROM events
       UNION ALL SELECT event_id, 'body.user', user_id::VARCHAR FROM events
       UNION ALL SELECT event_id, 'body.props.k', json_extract_string(props, '$.k') FROM events
       UNION ALL SELECT event_id, 'body.list', '[1,2]' FROM events
       UNION ALL SELECT event_id, 'body.nothing', NULL FROM events
       UNION ALL SELECT event_id, 'body.word', 'null' FROM events
       UNION ALL SELECT event_id, 'body.yes', 'true' FROM events""",
)
def _(spark, sf):
    events = spread(table(spark, sf, "events", "event_id", "event_type", "user_id", "props"), "event_id", input_partitions(spark))
    nested = F.concat(
        F.lit('{"type": "'), "event_type", F.lit('", "none": {}, "body": {"list": [1, 2], "nothing": null, "word": "null", "yes": true, "user": '),
        F.col("user_id").cast("string"), F.lit(', "props": '), "props", F.lit("}}"),
    )
    return records.flatten_json(events.select("event_id", nested.alias("j")), "j", "event_id")


@query(
    "prj7_flatten_json_order",
    """SELECT event_id, 'a.b' AS path, CASE event_id % 3 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN event_type ELSE NULL END AS value FROM events
       UNION ALL SELECT event_id, 'c', event_type FROM events WHERE event_id % 3 = 0
       UNION ALL SELECT event_id, 'd.e', '[{"x":1.5}]' FROM events""",
)
def _(spark, sf):
    # Two members with one path, in either order, and the empty name: the later one counts.
    user, kind = F.col("user_id").cast("string"), F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    nested = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"a.b": 1, "c": 2, "": {"c": '), kind, F.lit('}, "a": {"b": '), user, F.lit("}")))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"a": {"b": '), user, F.lit('}, "a.b": '), kind))
        .otherwise(F.concat(F.lit('{"a": {"b": '), user, F.lit(', "b": null}')))
    )
    texts = F.concat(nested, F.lit(', "d": {"e": [{"x": 1.50}], "f": {}}}'))
    return records.flatten_json(table(spark, sf, "events", "event_id", "event_type", "user_id").select("event_id", texts.alias("j")), "j", "event_id")


@query("prj8_process", f"SELECT id, name, value * 2 AS value, true AS processed FROM {_PART}")
def _(spark, sf):
    return items.process(part_items(spark, sf), items.double_value)


@query("udf2_process_rows", f"SELECT id, name, value * 2 AS value, true AS processed FROM {_PART}")
def _(spark, sf):
    def doubled(batches):
        for batch in batches:
            yield batch.assign(value=batch["value"] * 2, processed=True)

    return items.process_rows(part_items(spark, sf), doubled, "id bigint, name string, value int, processed boolean")


@query(
    "prj17_mark_status",
    f"""SELECT p_partkey, CASE WHEN id IS NULL OR name = '' THEN 'error' WHEN value > 10 THEN 'success' ELSE 'pending' END AS status,
          NOT (id IS NULL OR name = '') AND value > 10 AS processed FROM {_GAPS}""",
)
def _(spark, sf):
    validated = items.validate_items(gappy_items(spark, sf))
    return validated.select("p_partkey", *records.mark_status(F.col("is_valid"), F.col("value") > 10))


# --- Filters --------------------------------------------------------------------------------


@query("flt15_where_equal", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def _(spark, sf):
    return items.where_equal(table(spark, sf, "customer", "c_custkey", "c_mktsegment"), "c_mktsegment", "BUILDING")


@query("flt15_where_null", f"SELECT p_partkey FROM {_GAPS} WHERE id IS NULL")
def _(spark, sf):
    return items.where_equal(gappy_items(spark, sf), "id", None).select("p_partkey")


@query("flt15_where_null_all", f"SELECT p_partkey FROM {_GAPS}")
def _(spark, sf):
    return items.where_equal(gappy_items(spark, sf), "id", None, null_mode="all").select("p_partkey")


_OPS = (
    ("eq", "c_mktsegment", "MACHINERY", "= 'MACHINERY'"),
    ("ne", "c_mktsegment", "MACHINERY", "<> 'MACHINERY'"),
    ("gt", "c_acctbal", 5000.0, "> 5000"),
    ("lt", "c_acctbal", 0.0, "< 0"),
    ("gte", "c_nationkey", 20, ">= 20"),
    ("lte", "c_nationkey", 3, "<= 3"),
    ("in", "c_nationkey", [1, 5, 7], "IN (1, 5, 7)"),
    ("contains", "c_name", "77", "LIKE '%77%'"),
)


@query(
    "flt16_where_op",
    " UNION ALL ".join(f"SELECT '{op}' AS op, c_custkey FROM customer WHERE {key} {sql}" for op, key, _, sql in _OPS),
)
def _(spark, sf):
    customers = table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey", "c_name")
    frames = [
        items.where_op(customers, key, op, value).select(F.lit(op).alias("op"), "c_custkey")
        for op, key, value, _ in _OPS
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _errors_sql(strict):
    parts = ["CASE WHEN id IS NULL THEN 'id is missing' END", "CASE WHEN name = '' THEN 'name is empty' END"]
    if strict:
        parts.insert(1, "CASE WHEN id = 0 THEN 'id is empty' END")
        parts.append("CASE WHEN value = 0 THEN 'value is empty' END")
    return f"array_to_string([{', '.join(parts)}], '; ')"


for _strict in (False, True):

    @query(
        f"flt17_validate_items{'_strict' if _strict else ''}",
        f"SELECT p_partkey, coalesce(e, '') AS errors, coalesce(e, '') = '' AS is_valid FROM (SELECT p_partkey, {_errors_sql(_strict)} AS e FROM {_GAPS})",
    )
    def _(spark, sf, strict=_strict):
        return items.validate_items(gappy_items(spark, sf), strict=strict).select(
            "p_partkey", F.array_join("errors", "; ").alias("errors"), "is_valid"
        )


@query(
    "flt18_split_valid",
    f"""SELECT p_partkey, 'failed' AS part, value FROM {_GAPS} WHERE id IS NULL OR name = ''
        UNION ALL SELECT p_partkey, 'valid', value * 2 FROM {_GAPS} WHERE id IS NOT NULL AND name <> ''""",
)
def _(spark, sf):
    valid, failed = items.split_valid(items.validate_items(gappy_items(spark, sf)))
    doubled = valid.transform(items.double_value).select("p_partkey", F.lit("valid").alias("part"), "value")
    return doubled.unionByName(failed.select("p_partkey", F.lit("failed").alias("part"), "value"))


@query("flt19_require_non_empty", f"SELECT id, value FROM {_PART}")
def _(spark, sf):
    return items.require_non_empty(part_items(spark, sf)).select("id", "value")


@query("flt20_split_by_range", f"SELECT id, CASE WHEN id <= 500 THEN 'low' ELSE 'high' END AS side FROM {_PART}")
def _(spark, sf):
    low, high = items.split_by_range(part_items(spark, sf), "id", 500)
    return low.select("id", F.lit("low").alias("side")).unionByName(high.select("id", F.lit("high").alias("side")))


# --- Summaries, numbering, order -----------------------------------------------------------


@query(
    "agg12_validation_summary",
    f"""SELECT count(*)::BIGINT AS total_input, count(*) FILTER (id IS NOT NULL AND name <> '')::BIGINT AS successful,
               count(*) FILTER (id IS NULL OR name = '')::BIGINT AS failed FROM {_GAPS}""",
)
def _(spark, sf):
    return items.validation_summary(items.validate_items(gappy_items(spark, sf)))


@query(
    "agg13_fill_level",
    "SELECT p_type, count(*)::BIGINT AS items, round(100.0 * count(*) / 1500, 1)::DOUBLE AS used_percent FROM part GROUP BY 1",
)
def _(spark, sf):
    return items.fill_level(table(spark, sf, "part", "p_type"), 1500, ["p_type"])


@query(
    "agg14_match_rate",
    """SELECT count(*) FILTER (c_mktsegment = 'BUILDING')::BIGINT AS matched, count(*)::BIGINT AS total,
       round(100.0 * count(*) FILTER (c_mktsegment = 'BUILDING') / count(*), 1)::DOUBLE AS match_rate FROM customer""",
)
def _(spark, sf):
    return items.match_rate(table(spark, sf, "customer", "c_mktsegment"), F.col("c_mktsegment") == "BUILDING")


@query(
    "win1_chunk",
    """SELECT chunk, count(*)::BIGINT AS items, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM (
         SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 1000 AS chunk FROM lineitem) GROUP BY 1""",
)
def _(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    chunked = numbering.chunk(table(spark, sf, "lineitem", *keys), 1000, keys)
    return chunked.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("items"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order")
    )


@query(
    "win1_chunk_array",
    r"""WITH w AS (SELECT doc_id, string_split(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS w FROM documents)
        SELECT doc_id, c::INTEGER AS chunk, array_to_string(w[c * 100 + 1 : c * 100 + 100], ' ') AS words
        FROM (SELECT doc_id, w, unnest(range(0, (len(w) + 99) // 100)) AS c FROM w)""",
)
def _(spark, sf):
    words = table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.split(F.regexp_replace("text", r"\s+", " "), " ").alias("w")
    )
    chunks = words.select("doc_id", F.posexplode(numbering.chunk_array(F.col("w"), 100)).alias("chunk", "part"))
    return chunks.select("doc_id", "chunk", F.array_join("part", " ").alias("words"))


@query(
    "win2_enforce_capacity",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) > 3000
         THEN 'Cannot add item: max_items limit (3000) reached' END AS error FROM orders""",
)
def _(spark, sf):
    return items.enforce_capacity(
        table(spark, sf, "orders", "o_orderkey", "o_orderstatus"), 3000, ["o_orderkey"], ["o_orderstatus"]
    )


@query(
    "srt2_sort_spec",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS place FROM orders",
)
def _(spark, sf):
    spec = [("o_orderstatus", "asc"), ("o_totalprice", "desc"), ("o_orderkey", "asc")]
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    # The place of every sorted row, so that a check that ignores row order still sees the order.
    placed = items.sort_spec(orders, spec).withColumn("at", F.monotonically_increasing_id())
    return numbering.with_position(placed, ["at"], name="place").select("o_orderkey", "place")


@query("src6_read_table_file", "SELECT c_custkey, c_name, c_acctbal, 'csv' AS kind FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal, 'json' FROM customer UNION ALL SELECT NULL, c_name, NULL, 'txt' FROM customer")
def _(spark, sf):
    customers = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal")
    path = {kind: scratch_path(spark, kind) for kind in ("csv", "json", "txt")}
    customers.write.csv(path["csv"], header=True)
    customers.write.json(path["json"])
    customers.select("c_name").write.text(path["txt"])
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    frames = [readers.read_table_file(spark, path[kind], kind, schema) for kind in ("csv", "json")]
    lines = readers.read_table_file(spark, path["txt"], "txt").select(
        F.lit(None).cast("bigint").alias("c_custkey"), F.col("value").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal")
    )
    out = lines.withColumn("kind", F.lit("txt"))
    for kind, frame in zip(("csv", "json"), frames):
        out = out.unionByName(frame.withColumn("kind", F.lit(kind)))
    return out


@query(
    "srt3_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40",
)
def _(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    page = items.page(orders, 3, 20, [("o_orderdate", "desc"), ("o_orderkey", "asc")])
    return page.select("o_orderkey", "o_totalprice")


@query(
    "srt3_deep_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 10000",
)
def _(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    page = items.page(orders, 21, 500, [("o_orderdate", "desc"), ("o_orderkey", "asc")])
    return page.select("o_orderkey", "o_totalprice")


@query(
    "srt3_indexed_pages",
    """SELECT o_orderkey, place, (place - 1) // 500 + 1 AS page FROM
       (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders) WHERE (place - 1) // 500 % 7 = 2""",
)
def _(spark, sf):
    # Every seventh page of one stored order.
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    index = items.page_index(orders, [("o_orderdate", "desc"), ("o_orderkey", "asc")])
    pages = -(-orders.count() // 500)
    return index.pages(range(3, pages + 1, 7), 500).select("o_orderkey", "place", "page")


@query(
    "srt3_tied_pages",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*)::BIGINT AS times FROM lineitem GROUP BY ALL",
)
def _(spark, sf):
    """All pages over keys that are all equal: every row stands on exactly one page."""
    rows = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn("tie", F.lit(1))
    size = max(1, -(-rows.count() // 4))
    parts = [items.page(rows, number, size, [("tie", "asc")]) for number in (1, 2, 3, 4)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
