"""JSON in member order, stored answers, batches by length, emoji sequences and NFKC in the JVM."""

import json
import os
import sys
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliosift.functions import records, text
from foliosift.operators import annotate, scoring


def flat(spark, value, **options):
    df = spark.createDataFrame([(1, value if value is None or isinstance(value, str) else json.dumps(value))], "id int, j string")
    return sorted(((r.path, r.value) for r in records.flatten_json(df, "j", "id", **options).collect()), key=str)


def test_later_member_wins(spark):
    assert flat(spark, '{"a.b":1,"a":{"b":2}}') == [("a.b", "2")]
    assert flat(spark, '{"a":{"b":2},"a.b":1}') == [("a.b", "1")]
    assert flat(spark, '{"a":1,"a":{"b":[{"c":1.50}]},"e":{}}') == [("a.b", '[{"c":1.5}]')]
    assert flat(spark, '{"":{"b":1},"b":2}') == [("b", "2")]
    assert flat(spark, None) == [("", None)] and flat(spark, "[1]", prefix="p") == [("p", "[1]")]
    deep = '{"a":' * 200 + '"é"' + "}" * 200
    assert flat(spark, deep, separator="/") == [("/".join("a" * 200), "é")]
    for bad in ("{", "NaN", '{"a":1} {"b":2}', ""):
        with pytest.raises(Exception):
            flat(spark, bad)


def counting_client(folder, limit=None):
    def make():
        def call(prompt, schema, **options):
            if limit is not None and len(os.listdir(folder)) >= limit:
                os._exit(1)  # the loss of the process
            with open(os.path.join(folder, f"{os.getpid()}-{len(os.listdir(folder))}-{abs(hash(prompt))}-{np.random.rand()}"), "w"):
                pass
            return json.dumps({name: (kind["enum"][0] if "enum" in kind else kind["items"]["enum"][:1] if kind["type"] == "array" else "x") for name, kind in schema["properties"].items()})

        return call

    return make


def test_a_run_goes_on_where_one_was_lost(spark, texts, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    df = texts([f"text {i % 40}" for i in range(80)])  # every text twice
    lost = annotate.StoredAnnotator(annotate.CallableAnnotator(counting_client(str(calls), 60)), store, wave=12, concurrency=2)
    with pytest.raises(Exception):
        lost.annotate(df)
    before = len(os.listdir(calls))
    kept = spark.read.parquet(store).count()
    assert 0 < kept <= before <= 60
    again = annotate.StoredAnnotator(annotate.CallableAnnotator(counting_client(str(calls))), store, wave=12, concurrency=2)
    rows = again.annotate(df).collect()
    assert len(rows) == 80 and all(r[name] is not None for r in rows for name in rows[0].asDict())
    assert len(os.listdir(calls)) == before + 120 - kept  # three prompts for each of 40 texts
    again.annotate(df)
    assert len(os.listdir(calls)) == before + 120 - kept


def test_batches_of_like_length(texts):
    rows = ["w " * (i * 37 % 100 + 1) for i in range(200)] + [""]
    df = texts(rows).coalesce(1)

    def padded():
        return lambda batch: np.full(len(batch), max(len(t.split()) for t in batch), dtype=float)

    def own():
        return lambda batch: np.array([float(len(t.split())) for t in batch])

    got = [r.score for r in scoring.BatchScorer(own, batch_size=16).score(df).orderBy("doc_id").collect()]
    assert got == [float(len(r.split())) for r in rows]
    total = sum(r.score for r in scoring.BatchScorer(padded, batch_size=16).score(df).collect())
    unsorted = sum(16 * max(len(r.split()) for r in rows[k : k + 16]) for k in range(0, 200, 16))
    assert sum(got) <= total < 0.65 * unsorted
    with pytest.raises(Exception):
        scoring.BatchScorer(lambda: lambda batch: np.zeros(1)).score(df).collect()


def test_emoji_sequences(texts):
    gone = ["™", "‼", "▪", "↔", "ℹ", "◻", "©", "👍🏽", "👩‍🚀", "🏳️‍🌈", "🇯🇵", "1️⃣", "*⃣", "❤️", "🏴\U000e0067\U000e0062\U000e007f", "🀄", "🫠"]
    stay = ["✓", "➀", "1", "#", "•", "→", "★", "a‍b", "🄰", "🇯"]
    got = [r[0] for r in texts([f"x{t}y" for t in gone + stay]).orderBy("doc_id").select(text.strip_emojis(F.col("text"), keycaps=True)).collect()]
    assert got == ["xy"] * len(gone) + [f"x{t}y" for t in stay]


def test_nfkc_of_all_assigned_characters(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    parts = ["|".join(chars[k : k + 500]) for k in range(0, len(chars), 500)] + ["a" + "|a".join(chars[k : k + 500]) for k in range(0, len(chars), 500)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "i int, t string")
    normal = df.select("i", "t", text.normalize_nfkc(F.col("t")).alias("n"))
    assert "Python" not in normal._jdf.queryExecution().executedPlan().toString()
    for r in normal.collect():
        assert r.n == unicodedata.normalize("NFKC", r.t)
