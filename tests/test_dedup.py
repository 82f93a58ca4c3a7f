import hashlib
import random

import pytest
from pyspark.sql import functions as F

from foliosift import values
from foliosift.operators import dedup


def corpus(seed=11, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            rows.append(rng.choice(rows))
        elif rows and kind < 0.45:
            base = rng.choice(rows).split()
            base[rng.randrange(len(base))] = rng.choice(words)
            rows.append(" ".join(base))
        elif kind < 0.55:
            rows.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))))
        else:
            rows.append(" ".join(rng.choice(words) for _ in range(rng.randrange(5, 80))))
    return rows


def brute_force(rows):
    """Kept ids by the definition: no band bucket with a smaller id."""
    buckets, kept, seen = {}, [], set()
    for doc, text in enumerate(rows):
        if text in seen:
            continue
        seen.add(text)
        w = text.lower().split()
        grams = [" ".join(w[i : i + 5]) for i in range(len(w) - 4)] or [" ".join(w)]
        xs = [int(hashlib.md5(g.encode()).hexdigest()[:7], 16) for g in grams]
        sig = [min((a * x + b) % values.MINHASH_PRIME for x in xs) for a, b in values.MINHASH_COEFFICIENTS]
        keys = [(band, *sig[4 * band : 4 * band + 4]) for band in range(8)]
        if all(key not in buckets for key in keys):
            kept.append(doc)
        for key in keys:
            buckets.setdefault(key, doc)
    return kept


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_near_duplicates_equal_brute_force_for_any_partitioning(texts, partitions):
    rows = corpus()
    kept = dedup.near_first(texts(rows).repartition(partitions)).collect()
    assert sorted(r[0] for r in kept) == brute_force(rows)


def test_a_third_of_all_rows_in_one_group(texts):
    rows = corpus(n=60) + ["the same junk page again and again"] * 30
    docs = texts(rows).repartition(6)
    assert sorted(r[0] for r in dedup.near_first(docs).collect()) == brute_force(rows)
    assert dedup.drop_exact_duplicates(docs).count() == len(set(rows))


def test_marking_keeps_earlier_reasons_and_names_the_stage(texts):
    rows = ["a b c d e f g h i j", "a b c d e f g h i j", "q r s t u v w", "q r s t u v w"]
    df = texts(rows).withColumn("reject_reason", F.when(F.col("doc_id") == 2, "doc_length"))
    got = [r[0] for r in dedup.mark_duplicates(df).orderBy("doc_id").select("reject_reason").collect()]
    assert got == [None, "exact_duplicate", "doc_length", None]


def test_only_narrow_rows_are_shuffled(texts):
    plan = dedup.near_first(texts(["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning") == 3


def test_null_ids_are_refused(spark):
    rows = spark.createDataFrame([(None, "one text of words"), (1, "another text of words")], "doc_id bigint, text string")
    for work in (dedup.drop_near_duplicates, dedup.drop_exact_duplicates):
        with pytest.raises(Exception, match="ids that are not null"):
            work(rows).collect()


def test_two_texts_under_one_id_both_stay(spark):
    rows = [(5, "one text of six plain words"), (5, "quite another text about other things"), (5, "one text of six plain words"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for work in (dedup.drop_near_duplicates, dedup.drop_exact_duplicates):
        assert sorted((r.doc_id, r.text or "") for r in work(df).collect()) == sorted({(i, t or "") for i, t in rows})
    marked = dedup.mark_duplicates(df.withColumn("reject_reason", F.lit(None).cast("string")))
    assert marked.count() == 4 and marked.where("reject_reason IS NULL").count() == 4


@pytest.mark.parametrize("copies_first", [True, False])
def test_shingles_of_text_ids_are_not_sorted(texts, copies_first):
    rows = corpus(n=60)
    docs = texts(rows).withColumn("doc_id", F.format_string("urn:%05d", "doc_id")).repartition(4)
    kept = dedup.near_first(docs.unionAll(docs), copies_first=copies_first)
    assert sorted(int(r.doc_id[4:]) for r in kept.collect()) == brute_force(rows)
    tree = dedup.near_first(docs, copies_first=copies_first)._jdf.queryExecution().executedPlan().toString()
    above = tree[: tree.index("Generate explode")].split("\n")
    assert [line.split("Aggregate")[0][-4:] for line in above if "Aggregate" in line][-1] == "Hash"
