"""Array files cut into byte ranges of any size give the entries that a JSON parser gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliosift.sources import readers
from foliosift.sources.json_arrays import _pieces


@pytest.fixture
def ranges(spark):
    """Sets the size of the byte ranges."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def set_to(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "0" if size < 1 << 20 else str(size))

    yield set_to
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def entry(rng, depth=0):
    hostile = ['{"text": "x"}', "}", "{", '\\"', "\\\\", '"', "[", "]", ",", "日本", "\n", "a" * 40, "}}}", "\\", "𝒳"]
    kind = rng.random()
    if depth > 2 or kind < 0.5:
        return "".join(rng.choices(hostile, k=rng.randrange(3)))
    if kind < 0.6:
        return rng.choice([1, -2.5, True, None])
    if kind < 0.75:
        return [entry(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "}b", '"c', "text"]): entry(rng, depth + 1) for _ in range(rng.randrange(4))}


def kept(entries):
    return [e for e in entries if isinstance(e, dict) and "text" in e]


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_entries(spark, tmp_path, ranges, size):
    rng = random.Random(size)
    everything = {}
    for k in range(3):
        entries = []
        for i in range(rng.randrange(5, 30)):
            if rng.random() < 0.6:
                entries.append({"id": 1000 * k + i, "more": entry(rng), "text": "".join(map(str, [entry(rng), i, "z" * rng.choice([0, 5, 300])]))})
            else:
                entries.append(entry(rng))
        text = json.dumps(entries, ensure_ascii=bool(k % 2), indent=k % 3 or None, separators=(",", ":") if k == 4 else None)
        (tmp_path / f"{k}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n"]), encoding="utf-8")
        everything[k] = kept(entries)
    ranges(size)
    assert _pieces(spark, str(tmp_path)).rdd.getNumPartitions() > (20 if size < 1000 else 0)
    got = readers.read_json_corpus(spark, str(tmp_path), id_field="id").collect()
    want = [(e["id"], e["text"]) for k in everything for e in everything[k] if "id" in e]
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted(want)
    assert len(got) == sum(map(len, everything.values()))
    for k in everything:
        rows = readers.read_json_corpus(spark, str(tmp_path / f"{k}.json")).orderBy("doc_id").collect()
        assert len(rows) == len(everything[k])
        for r, e in zip(rows, everything[k], strict=True):
            assert r.text == e["text"] or not isinstance(e["text"], str)
        if size == 1 << 20:
            assert [r.doc_id for r in rows] == list(range(len(rows)))


@pytest.mark.parametrize("size", [5])
@pytest.mark.parametrize(
    "text", ['{"text": "t"}', "[1] [2]", '[{"te', " ", '[{"text": "a"} {"text": "b"}]', '[{"text": "a"},]', "[,]", '["a', '[{"text": "a"}]]', '[{"text": "a"}],', '[{"text": "a"}, x]', '{"a": [{"text": "b"}]}']
)
def test_what_is_no_array(spark, tmp_path, ranges, size, text):
    (tmp_path / "a.json").write_text(text)
    ranges(size)
    with pytest.raises(Exception):
        readers.read_json_corpus(spark, str(tmp_path / "a.json")).collect()


def test_only_fragments_are_shuffled(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "t" * 50, "i": i} for i in range(200)]))
    ranges(2000)
    plan = readers.read_json_corpus(spark, str(tmp_path / "a.json"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert readers.read_json_corpus(spark, str(tmp_path / "a.json")).count() == 200


def cut(rng, entries, n):
    """The text of one array in ``n`` parts that end between entries, before or after a comma."""
    rows = [json.dumps(e, ensure_ascii=False) for e in entries]
    at = sorted(rng.sample(range(1, len(rows)), n - 1))
    parts = [",".join(rows[a:b]) for a, b in zip([0, *at], [*at, len(rows)], strict=True)]
    parts[0], parts[-1] = "[" + parts[0], parts[-1] + "]"
    for k in range(n - 1):
        blank = rng.choice(["", " ", "\n"])
        parts[k], parts[k + 1] = rng.choice([(parts[k] + blank, "," + parts[k + 1]), (parts[k] + "," + blank, parts[k + 1])])
    return parts


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_one_array_in_several_files(spark, tmp_path, ranges, size):
    rng = random.Random(size + 1)
    entries = []
    for i in range(60):
        more = {"id": i, "more": entry(rng), "text": "".join(map(str, [entry(rng), i, "z" * rng.choice([0, 5, 300])]))}
        entries.append(more if rng.random() < 0.6 else entry(rng))
    parts = cut(rng, entries, 9)
    parts.insert(4, "")
    for k, part in enumerate(parts):
        (tmp_path / f"part-{k:05d}.json").write_text(part, encoding="utf-8")
    ranges(size)
    rows = readers.read_json_corpus(spark, str(tmp_path), joined=True).orderBy("doc_id").collect()
    assert len(rows) == len(kept(entries))
    for r, e in zip(rows, kept(entries), strict=True):
        assert r.text == e["text"] or not isinstance(e["text"], str)
    with pytest.raises(Exception):
        readers.read_json_corpus(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "parts",
    [
        ['[{"text": "a"}', '{"text": "b"}]'], ['[{"text": "a"}', ',,{"text": "b"}]'], ['[{"text": "a"},', ",", "1]"],
        ['[{"text": "a"}]', ""], ['[{"text": "a"}]', '[{"text": "b"}]'], ['[{"text": "a"', ', "b": 1}]'], ['[{"text": "a"', ', "b": 1}', ',{"text": "c"}', ',{"text": "d"}]'],
        ['[{"text": "a', 'b"}]'], ['[{"text": "a"}', ', {"text": "b"}'], ['{"text": "a"}', ', {"text": "b"}]'], ['[[{"text": "a"}', ']]'],
    ],
)
def test_several_files_that_are_no_array(spark, tmp_path, ranges, parts):
    for k, part in enumerate(parts):
        (tmp_path / f"{k}.json").write_text(part)
    ranges(5)
    read = readers.read_json_corpus(spark, str(tmp_path), joined=True)
    if parts[1:] == [""]:
        assert [r.text for r in read.collect()] == ["a"]  # an empty file holds nothing
    else:
        with pytest.raises(Exception):
            read.collect()


def test_no_task_writes_the_whole_array(spark, tmp_path, monkeypatch):
    from foliosift.plans import item_queries
    from foliosift.plans.registry import QUERIES

    rows = [(i // 3 if i % 10 else None, f"{i} }} \\ \" [" * 20) for i in range(300)] + [(7, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(item_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # the table is small
    try:
        read = QUERIES["src1_read_one_array"](spark, str(tmp_path))
    finally:
        spark.conf.unset(coalesce)
    want = docs.where("text IS NOT NULL").select("doc_id", F.md5("text").alias("text_md5"))
    assert read.count() == want.count() and read.exceptAll(want).isEmpty()
    sizes = sorted(f.stat().st_size for f in (tmp_path / "array").glob("part-*"))
    assert len(sizes) > 2 and sizes[-1] < 0.6 * sum(sizes)
