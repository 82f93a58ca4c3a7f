"""Positions within groups, stored orders and two-phase duplicates: rows and plans."""

import random

import pytest
from pyspark.sql import functions as F

from foliosift.operators import dedup, items
from foliosift.operators.numbering import with_position


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shape", ["hot", "many", "one"])
def test_positions_within_groups(spark, shape):
    rng = random.Random(1)
    group = {"hot": lambda: rng.choice(["a", "hot", "hot", "hot", "z", None]), "many": lambda: str(rng.randrange(300)), "one": lambda: "x"}[shape]
    rows = [(group(), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, k int, i int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_position(df, ["k", "i"], ["g"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        want.setdefault(r[0], []).append(r)
    assert {(r.g, r.k, r.i): r.position for r in got} == {r: n for group in want.values() for n, r in enumerate(group, 1)}


def test_groups_move_rows_once(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3).withColumn("payload", F.repeat(F.lit("x"), 100))
    numbered = with_position(df, ["id"], ["g"])
    # The stored, sorted rows meet one small row per partition.
    assert "SortMergeJoin" not in plan(numbered) and "BroadcastHashJoin" in plan(numbered)
    for line in plan(numbered).split("\n"):
        assert "Exchange" not in line or "payload" not in line


def test_pages_of_a_stored_order(spark):
    df = spark.range(20_000).select("id", (F.col("id") * 7919 % 1000).alias("k"), F.create_map(F.lit("m"), F.col("id")).alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = items.page_index(df, [("k", "desc"), ("id", "asc")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = [r.id for r in df.orderBy(F.desc("k"), "id").collect()]
    assert len(index.rows.inputFiles()) == 4
    for number in (1, 999, 1000, 2000):
        page = index.page(number, 10)
        assert len(page.inputFiles()) == 1
        assert [r.id for r in page.collect()] == want[10 * (number - 1) : 10 * number]
    assert index.page(2001, 10).collect() == [] and page.columns == df.columns
    assert [r.id for r in index.page(1, 20_000).collect()] == want
    with pytest.raises(ValueError):
        index.page(0, 10)


def test_rows_that_differ_in_a_map_only(spark):
    """Both ways of paging give tied rows in one order."""
    df = spark.range(100).select(F.lit(1).alias("k"), F.create_map(F.lit("m"), F.col("id")).alias("m"))
    early = [r.m["m"] for n in range(1, 11) for r in items.page(df, n, 10, [("k", "asc")]).collect()]
    assert sorted(early) == list(range(100))
    assert [r.m["m"] for r in items.page_index(df, [("k", "asc")]).page(1, 100).collect()] == early


def test_copies_are_not_shingled(spark, texts):
    """Signatures are made of the rows that the narrow keys leave."""
    df = texts(["one two three four five six seven"] * 50 + [f"another text number {i} with enough words in it" for i in range(5)])
    kept = dedup.near_first(df, copies_first=True)
    tree = kept._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [next(i for i, line in enumerate(tree) if mark in line) for mark in ("Generate explode", "LeftSemi")]
    assert depth[0] < depth[1]  # the join stands below
    assert 0 in {r.doc_id for r in kept.collect()} and not {r.doc_id for r in kept.collect()} & set(range(1, 50))


@pytest.mark.parametrize("numbers", [range(3, 28, 7), range(27, 2, -7), range(1, 28), range(40, 50), range(0)])
def test_many_pages_of_a_stored_order_are_one_plan(spark, numbers):
    df = spark.createDataFrame([(i % 90, i) for i in range(1301)], "k int, id int").repartition(5)
    index = items.page_index(df, [("k", "desc"), ("id", "asc")])
    found = index.pages(numbers, 50)
    rows = sorted(((r.place, r.page, r.k, r.id) for r in found.collect()))
    order = sorted(((i % 90, i) for i in range(1301)), key=lambda r: (-r[0], r[1]))
    assert rows == [(p, (p - 1) // 50 + 1, *order[p - 1]) for p in range(1, 1302) if (p - 1) // 50 + 1 in numbers]
    assert "Union" not in plan(found)
    with pytest.raises(ValueError):
        index.pages(range(0, 3), 50)
