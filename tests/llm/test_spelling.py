"""Spelling variants against plain Python, with every size of key and odd rows."""

import random

import pytest

from foliosift.llm import spelling_variants
from foliosift.llm.queries import spelled_words


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v.encode()), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (form, n, len(near), None if form is None else counts[form])

    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w

    return {w: (x[0], root(w), *x[1:]) for w, x in out.items()}


@pytest.mark.parametrize("most", [40, 1 << 20])
def test_group(spark, most):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé𝒳") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    words |= {"aaaaaaaa", "aaaaaaaaa", "aaaaaaa", "abababab", "ababababa", "babababa", "", "x" * 300, "x" * 299 + "y", "x" * 301}
    counts = {w: rng.choice([1, 2, 7, 30, 900, 20_000]) for w in words}
    rows = [(w, n) for w, n in counts.items() if n != 2] + [(w, 1) for w, n in counts.items() if n == 2 for _ in range(2)]
    table = spark.createDataFrame([*rows, (None, 3), ("lost", None)], "word string, n int").withColumnsRenamed({"n": "count", "word": "a.b"})
    got = spelling_variants.group(table, word_col="a.b", n_col="count", most=most).collect()
    assert len(got) == len(counts)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == expected(counts, 10)


def test_chain_of_forms(spark):
    """Nine steps, each a tenfold count, end at one root."""
    words = ["abcdefghij"[:k] for k in range(1, 11)]
    table = spark.createDataFrame([(w, 10**k) for k, w in enumerate(words)], "word string, n bigint")
    got = {r.word: r for r in spelling_variants.group(table).collect()}
    assert [got[w].form for w in words[1:-1]] == words[2:]
    assert {got[w].root for w in words[1:]} == {words[-1]}
    assert got["a"].form == "ab" and got["a"].n_near == 1


def test_runs_and_empty_tables(spark):
    texts = [(1, "Überall ABCDEFG, abcdefg\nabc"), (2, None), (3, ""), (None, "abcdefg x" + "y" * 100_000), (1, "abcdefg")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = sorted(r.run for r in spelling_variants.runs(docs, "[A-Za-zÀ-ÿ]", 7).collect())
    assert got == sorted(["Überall", *["abcdefg"] * 4, "x" + "y" * 100_000])
    none = docs.where("false")
    assert spelled_words(none).count() == 0
    assert spelling_variants.group(spelled_words(none)).count() == 0
