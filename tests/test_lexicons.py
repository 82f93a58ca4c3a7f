"""Lexicons as tables against the regular expressions of the lexicon rules."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliosift.functions import measures
from foliosift.operators import cascade, lexicons, rules

TEXTS = [
    "これは広告です。広告をクリック",
    "click   here now, click here NOW. Click Here",
    "Buy now! SALE, resale. buy nowbuy now",
    "",
    None,
    "ÉTÉ été Straße STRASSE İstanbul 𝒳𝒳𝒳 a.b a+b (x",
    "abababab",
]
TERMS = ["広告", "広告をクリック", "クリック", "click here", "click here now", "now", "buy now", "sale", "été", "straße", "𝒳𝒳", "a.b", "a+b", "(x", "aba", "bab", "abab"]


@pytest.mark.parametrize("max_terms", [3, 1000])
def test_equal_to_the_rules(texts, spark, max_terms):
    rng = random.Random(1)
    rows = [(c, t) for c in ("one", "two") for t in TERMS if rng.random() < 0.7]
    lexicon = spark.createDataFrame([*rows, *rows, ("one", ""), ("one", None), (None, "now")], "category string, term string")
    df = texts([*TEXTS, *("".join(rng.choices("ab ", k=40)) for _ in range(50))])
    hits = lexicons.counter(lexicon, max_terms)
    plain = {c: measures.lexicon_hits(F.col("text"), [t for x, t in rows if x == c]) for c in ("one", "two")}
    got = lexicons.attach_lexicon_hits(df, lexicon, max_terms=max_terms)
    assert got.columns == [*df.columns, "lexicon_hits"]
    for r in got.select("*", hits(F.col("text")).alias("column"), *[plain[c].alias(c) for c in plain]).collect():
        assert r.column == r.lexicon_hits
        if r.text is None:
            assert r.lexicon_hits is None
        else:
            assert {c: r.lexicon_hits.get(c, 0) for c in plain} == {c: r[c] for c in plain}


def test_rows_count_for_themselves(spark):
    """Null and repeated ids."""
    df = spark.createDataFrame([(1, "a now"), (1, "now now"), (None, "now"), (None, "x")], "doc_id int, text string")
    lexicon = spark.createDataFrame([("c", "Now")], "category string, term string")
    got = lexicons.attach_lexicon_hits(df, lexicon).select("text", F.col("lexicon_hits")["c"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a now", 1), ("now now", 2), ("now", 1), ("x", None)], key=str)


def test_empty_lexicon_and_rule(texts, spark):
    lexicon = spark.createDataFrame([("ads", "広告"), ("other", "です")], "category string, term string")
    assert lexicons.attach_lexicon_hits(texts(["a", None]), lexicon.where("false")).select("lexicon_hits").collect()[0][0] == {}
    df = texts(["<b>広告</b>", "<b>広</b>告", "です"])
    steps = [rules.Rule("strip", transform=lambda c: F.regexp_replace(c, "<[^>]*>", "")), lexicons.lexicon_rule("ads", lexicon, 1)]
    got = cascade.apply_cascade(df, steps).orderBy("doc_id").collect()
    assert [r.reject_reason for r in got] == ["ads", "ads", None]


def _rows(rng, n):
    return ["".join(rng.choices(["a", "b", " ", "é", "広", "告", "𝒳", "ab", "aba aba aba aba aba aba"], k=rng.randrange(60))) for _ in range(n)]


def _parts(rng, texts, n):
    """Terms cut from the texts, short and long, within one another and with common beginnings."""
    some = [(t, a, a + rng.choice([1, 2, 3, 5, 9, 16, 17, 25, 40])) for t in rng.choices([t for t in texts if t], k=n) for a in [rng.randrange(len(t))]]
    return sorted({t[a:b] for t, a, b in some} | {t[a:b] + "!" for t, a, b in some})


def test_more_terms_than_one_automaton_holds(spark, monkeypatch):
    """As with one automaton, categories in the same order; the texts are not read again for more terms."""
    rng = random.Random(7)
    values = _rows(rng, 80)
    rows = [(c, t) for t in _parts(rng, values, 150) for c in ("one", "two", "three") if rng.random() < 0.5]
    lexicon = spark.createDataFrame([*rows, *rows[:20], ("four", "never met")], "category string, term string")
    df = spark.createDataFrame([(k % 7 or None, t) for k, t in enumerate([*values, *values[:9], "", None, None])], "doc_id int, text string")
    whole = lexicons.attach_lexicon_hits(df, lexicon)
    monkeypatch.setattr(lexicons, "BLOCK", 300, raising=False)
    stored = []
    monkeypatch.setattr(lexicons, "materialise", lambda df, *label, f=lexicons.materialise: stored.append(1) or f(df, *label))
    parts = lexicons.attach_lexicon_hits(df, lexicon, max_terms=5)
    assert len(stored) <= 2
    assert parts.columns == ["doc_id", "text", "lexicon_hits"]

    def told(frame):
        return sorted(((r.doc_id, r.text, r.lexicon_hits and list(r.lexicon_hits.items()), r.lexicon_hits == {}) for r in frame.collect()), key=str)

    assert told(parts) == told(whole)


@pytest.mark.parametrize("same", [False, True])
def test_terms_are_compared_in_full(monkeypatch, same):
    """Also if all windows of a length share a number."""
    rng = random.Random(3)
    texts = [*_rows(rng, 40), None, ""]
    terms = _parts(rng, [t for t in texts if t], 60)
    if same:
        monkeypatch.setattr(lexicons, "_extended", lambda numbers, *_: numbers)
    column = pa.chunked_array([pa.array(terms)])
    categories = ["even" if len(t) % 2 else "odd" for t in terms]
    held = np.zeros((1 << 16) + 256, bool)
    held[next(lexicons._neighbours(iter([pa.RecordBatch.from_pydict({"term": terms})]))).column(0).to_numpy()] = True
    lengths = np.unique(lexicons._filled(np.array([len(t.encode()) for t in terms]))).tolist()
    shared = SimpleNamespace(value=(held[: 1 << 16], held[1 << 16 :], None, 0, lengths))
    rows = pa.table({"id": list(range(len(texts))), "_lower": texts})
    got = lexicons._in_block(shared, ["id"], "hits")(rows, pa.table({"term": column, "category": categories}))
    automaton = lexicons._automaton([(t, [c]) for t, c in zip(terms, categories, strict=True)])
    want = [None if t is None else list(zip(*lexicons._settled(lexicons._spans(automaton, t)), strict=True)) for t in texts]
    assert got.column("hits").to_pylist() == want
