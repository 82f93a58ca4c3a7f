import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliosift.functions import records
from foliosift.operators import items, numbering
from foliosift.sources import readers, writers

ITEM = "id int, name string, value int"


@pytest.fixture
def three(spark):
    return spark.createDataFrame([(1, "Item 1", 100), (2, "", 200), (3, "Item 3", 0)], ITEM)


def test_validation_variants(three, spark):
    assert [r.is_valid for r in items.validate_items(three).orderBy("id").collect()] == [True, False, True]
    strict = items.validate_items(three, strict=True).orderBy("id").collect()
    assert [r.errors for r in strict] == [[], ["name is empty"], ["value is empty"]]
    assert items.validate_items(three, enabled=False).where("is_valid").count() == 3
    missing = items.validate_items(three.drop("value")).first()
    assert "value is missing" in missing.errors


def test_recovery_report(three, spark, tmp_path):
    validated = items.validate_items(three)
    writers.write_recovery_report(validated, items.double_value, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/summary").first().asDict() == {"total_input": 3, "successful": 2, "failed": 1}
    assert {r.value for r in spark.read.json(f"{tmp_path}/processed").collect()} == {200, 0}
    assert spark.read.json(f"{tmp_path}/failed").first().errors == ["name is empty"]


def test_filters(three):
    assert items.where_equal(three, "name", "Item 1").count() == 1
    assert items.where_equal(three, "nothing", None).count() == 3
    assert items.where_equal(three, "name", None).count() == 0
    assert items.where_equal(three, "name", None, null_mode="all").count() == 3
    assert items.where_equal(three, None).count() == 3
    assert [items.where_op(three, "value", op, v).count() for op, v in (("gt", 0), ("gte", 0), ("lt", 100), ("lte", 100), ("eq", 0), ("ne", 0), ("in", [0, 100]))] == [2, 3, 1, 2, 1, 2, 2]
    assert items.where_op(three, "name", "contains", "tem").count() == 2
    with pytest.raises(ValueError):
        items.where_op(three, "name", "like", "x")


def test_empty_input(three):
    empty = three.where("false")
    with pytest.raises(ValueError, match="cannot be empty"):
        items.process(empty, items.double_value)
    assert items.process(empty, items.double_value, validate=False).count() == 0
    assert items.match_rate(empty, F.col("id") == 1).first().match_rate == 0.0


def test_capacity(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "box string, id int")
    got = {(r.box, r.id): r.error for r in items.enforce_capacity(df, 2, ["id"], ["box"]).collect()}
    assert got[("a", 1)] is None and got[("a", 2)] is None and got[("b", 9)] is None
    assert "max_items limit (2)" in got[("a", 3)]
    with pytest.raises(ValueError, match="must be positive"):
        items.enforce_capacity(df, 0, ["id"])


def test_position_within_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 50).alias("g"), ((F.col("id") * 7919) % 3001).alias("k"))
    got = numbering.with_position(df, ["k"], ["g"])
    wrong = got.withColumn("expected", F.expr("row_number() over (partition by g order by k)")).where("expected <> position")
    assert got.count() == 3000 and wrong.count() == 0


def test_equal_order_keys_are_numbered_alike_for_any_partitioning(spark):
    df = spark.range(2000).select("id", F.lit(1).alias("k"), F.lit(2).alias("a.b"))
    one, other = (
        {r.id: r.position for r in numbering.with_position(df.repartition(n), ["k"]).collect()} for n in (1, 7)
    )
    assert one == other and sorted(one.values()) == list(range(1, 2001))


def test_batches_and_chunk_files(spark, tmp_path):
    df = spark.range(1, 1001).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("Item "), "id").alias("name"), (F.col("id") * 10).alias("value"))
    assert numbering.chunk(df, 100, ["id"]).select("chunk").distinct().count() == 10
    writers.write_chunks(numbering.chunk(items.process(df, items.double_value), 200, ["id"]), str(tmp_path / "c"))
    back = spark.read.json(str(tmp_path / "c"))
    assert sorted(r[1] for r in back.groupBy("chunk").count().collect()) == [200] * 5


@pytest.mark.parametrize("n, size, chunks", [(10, 1, 10), (10, 5, 2), (10, 10, 1), (10, 15, 1), (0, 5, 0)])
def test_chunk_cases(spark, n, size, chunks):
    df = spark.range(n)
    assert numbering.chunk(df, size, ["id"]).select("chunk").distinct().count() == chunks
    row = df.agg(F.collect_list("id").alias("a")).select(numbering.chunk_array(F.col("a"), size)).first()
    assert len(row[0]) == chunks


@pytest.mark.parametrize("size", [0, -1])
def test_chunk_size_must_be_positive(spark, size):
    with pytest.raises(ValueError):
        numbering.chunk(spark.range(3), size, ["id"])
    with pytest.raises(ValueError):
        numbering.chunk_array(F.col("a"), size)


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.integers(0, 10**6), max_size=300, unique=True), size=st.integers(1, 100))
def test_chunks_keep_all_rows_in_order(spark, values, size):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [(r.v, r.chunk) for r in numbering.chunk(df, size, ["v"]).orderBy("v").collect()]
    assert got == [(v, i // size) for i, v in enumerate(sorted(values))]


def test_pages(spark):
    df = spark.range(100)
    page = items.page(df, 2, 10, [("id", "desc")])
    assert [r.id for r in page.collect()] == list(range(89, 79, -1))
    deep = items.page(spark.range(12000), 1101, 10, [("id", "desc")])
    assert sorted(r.id for r in deep.collect()) == list(range(990, 1000))
    with pytest.raises(ValueError):
        items.sort_spec(df, [("id", "up")])


# --- Flatten -----------------------------------------------------------------------------------


def test_flatten_columns(spark):
    df = spark.sql("SELECT 1 a, named_struct('c', 2, 'd', named_struct('e', array(1, 2), 'f', cast(null as int))) b, 5 `b.c`")
    flat = records.flatten(df)
    assert flat.columns == ["a", "b.c", "b.d.e", "b.d.f"]
    assert list(flat.first()) == [1, 5, [1, 2], None]
    assert records.flatten(df.select("b"), separator="/", prefix="root").columns == ["root/b/c", "root/b/d/e", "root/b/d/f"]


def leaves(node, path=""):
    if isinstance(node, dict):
        return [x for k, v in node.items() for x in leaves(v, f"{path}.{k}" if path else k)]
    return [(path, node)]


@settings(max_examples=6, deadline=None)
@given(tree=st.recursive(st.integers(0, 9) | st.text("xyz", max_size=3) | st.lists(st.integers(0, 3), max_size=2), lambda c: st.dictionaries(st.text("abc", min_size=1, max_size=2), c, max_size=3), max_leaves=12).filter(lambda t: isinstance(t, dict)))
def test_flatten_json_keeps_every_leaf(spark, tree):
    df = spark.createDataFrame([(1, json.dumps(tree))], "id int, j string")
    got = {(r.path, r.value) for r in records.flatten_json(df, "j", "id", max_depth=12).collect()}
    expected = {(p, v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))) for p, v in leaves(tree)}
    assert got == expected


def test_flatten_json_refuses_to_cut(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":1}}}')], "id int, j string")
    with pytest.raises(Exception, match="max_depth"):
        records.flatten_json(df, "j", "id", max_depth=2).collect()


# --- Files -------------------------------------------------------------------------------------


def test_json_array_corpus(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps([{"text": "一"}, "stray", {"no": 1}, {"text": None}, {"text": "b", "x": [1]}], ensure_ascii=False, indent=1), encoding="utf-8")
    got = readers.read_json_corpus(spark, str(path)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in got] == [(0, "一"), (1, None), (2, "b")]


def test_input_guards(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_json_corpus(spark, str(tmp_path / "missing"))
    (tmp_path / "e.json").write_text("[]")
    with pytest.raises(ValueError, match="No texts"):
        readers.require_input(readers.read_json_corpus(spark, str(tmp_path / "e.json")))


def test_json_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "name": "x", "nested": {"key": "値"}}', encoding="utf-8")
    (tmp_path / "b.json").write_text("{invalid json}")
    (tmp_path / "c.json").write_text("[1, 2]")
    (tmp_path / "d.json").write_text('{"name": "x"} {"name": "y"}')
    (tmp_path / "e.json").write_text('{"name": "x"}, {"name": "y"}')
    (tmp_path / "f.json").write_text('{"name": "x", "name": "y"}')
    read = lambda name, **kw: readers.read_json_objects(spark, str(tmp_path / name), **kw).collect()
    got = read("a.json", schema="name string, nested struct<key: string>")[0]
    assert (got.name, got.nested.key) == ("x", "値")
    assert read("f.json", schema="name string")[0].name == "y"
    for name, kw in (("b.json", {}), ("b.json", {"strict": False}), ("c.json", {}), ("d.json", {}), ("e.json", {})):
        with pytest.raises(Exception):
            read(name, **kw)
    assert len(read("c.json", strict=False)) == 1


def test_texts_are_escaped_and_round_trip(texts, spark, tmp_path):
    path = str(tmp_path / "deep" / "out")
    for _ in range(2):  # overwrites
        writers.write_texts_jsonl(texts(["日本語 \"q\"\n", "é"]), path)
    raw = "".join(r.value for r in spark.read.text(path).collect())
    assert raw.isascii()
    assert {r.text for r in spark.read.schema("text string").json(path).collect()} == {"日本語 \"q\"\n", "é"}


def test_write_json_forms(texts, spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_json(texts(["日本"]), path, pretty=True)
    body = "\n".join(r.value for r in spark.read.text(path).collect())
    assert "日本" in body and "\n" in body and json.loads(body) == {"doc_id": 0, "text": "日本"}
    writers.write_json(texts(["日本", None]), path, ensure_ascii=True)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert all(x.isascii() for x in lines) and any('"text":null' in x for x in lines)


def test_read_many_and_formats(spark, tmp_path):
    (tmp_path / "u.json").write_text('{"id": 1, "name": "A", "value": 1}\n{"id": 2, "name": "B", "value": 2}')
    (tmp_path / "p.json").write_text('{"id": 3, "name": "C", "value": 3}')
    (tmp_path / "t.csv").write_text("id,name,value\n1,x,2\n")
    both = readers.read_many(spark, {"users": str(tmp_path / "u.json"), "products": str(tmp_path / "p.json")}, ITEM)
    low, high = items.split_by_range(both, "id", 2)
    assert (low.count(), high.count(), high.first().category) == (2, 1, "products")
    assert readers.read_table_file(spark, str(tmp_path / "t.csv"), "csv", ITEM).first().value == 2
    assert readers.read_table_file(spark, str(tmp_path / "t.csv"), "txt").count() == 2
    with pytest.raises(ValueError):
        readers.read_table_file(spark, "x", "yaml")


@pytest.mark.parametrize("top_k", [0, 10_000])
def test_pages_over_ties_hold_every_row_once(spark, monkeypatch, top_k):
    monkeypatch.setattr(items, "TOP_K_ROWS", top_k)
    df = spark.range(95).select("id", F.lit(1).alias("tie"))
    pages = [[r.id for r in items.page(df, number, 20, [("tie", "asc")]).collect()] for number in range(1, 6)]
    assert sorted(x for p in pages for x in p) == list(range(95))
    test_pages_over_ties_hold_every_row_once.seen = getattr(test_pages_over_ties_hold_every_row_once, "seen", pages)
    assert pages == test_pages_over_ties_hold_every_row_once.seen


def test_flatten_json_finds_its_own_depth(spark):
    text = '{"a":null,"b":"null","c":{"d":{"e":{"f":{"g":{"h":{"i":{"j":{"k":1}}}}}}}},"x{":"}\\\\\\"{"}'
    got = records.flatten_json(spark.createDataFrame([(1, text)], "id int, j string"), "j", "id").collect()
    assert {(r.path, r.value) for r in got} == {("a", None), ("b", "null"), ("c.d.e.f.g.h.i.j.k", "1"), ("x{", '}\\"{')}


def test_array_files_skip_what_is_no_text_and_refuse_what_is_no_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('["x", 1, null, {"text": "t", "id": "urn:1"}, {"note": 1}, [2]]')
    got = readers.read_json_corpus(spark, str(tmp_path / "a.json"), id_field="id", id_type="string").collect()
    assert [tuple(r) for r in got] == [("urn:1", "t")]
    for name, text in (("b.json", '{"text": "t"}'), ("c.json", "[1] [2]"), ("d.json", '[{"te')):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception):
            readers.read_json_corpus(spark, str(tmp_path / name)).collect()
