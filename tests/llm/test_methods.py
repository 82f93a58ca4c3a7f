"""The operators' methods against brute force and held-out rows."""

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliosift.llm import graph, language_mixture, near_dup_forest, prefix_forest, pu_quality, sentencepiece_nbest, source_mix
from foliosift.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def tiny_vocabulary():
    pieces = ["<unk>", "<s>", "</s>", *[f"<0x{b:02X}>" for b in range(256)], "a", "b", "ab", "ba", "▁", "▁a", "▁ab", "aba", "bab", "▁▁"]
    scores = [0.0] * 259 + [-2.0, -2.5, -3.0, -3.5, -1.0, -2.25, -4.0, -5.0, -5.5, -2.0]
    return sentencepiece_nbest.Vocabulary(pieces, scores, list(range(3, 259)))


def all_segmentations(vocabulary, text):
    chars = (" " + text).replace(" ", sentencepiece_nbest.SPACE)
    arcs = vocabulary.lattice(chars)
    out = []

    def walk(at, score, ids):
        if at == len(chars):
            out.append((score, ids))
        for i, j, s, more in arcs:
            if i == at:
                walk(j, score + s, ids + more)

    walk(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["ab", "abab ba", "aabb", "ba  ab", "abc ab", "é\nab", "a.b, ab", "x"])
def test_n_best_is_exact(text):
    vocabulary = tiny_vocabulary()
    every = all_segmentations(vocabulary, text)
    ids, counts, scores, more = sentencepiece_nbest.Encoder(vocabulary, 5).encode([text])
    got = [(scores[0], tuple(ids.tolist()))] + [(a["score"], tuple(sentencepiece_nbest.apply_edits(ids.tolist(), a["edits"]))) for a in more[0]]
    assert np.allclose([s for s, _ in got], [s for s, _ in every[:5]])
    assert len({i for _, i in got}) == len(got) and all(any(np.isclose(s, t) and i == j for t, j in every) for s, i in got)
    assert {vocabulary.text(i) for _, i in got} == {text}


def test_n_best_of_ties():
    pieces = ["<unk>", "<s>", "</s>", *[f"<0x{b:02X}>" for b in range(256)], "▁", "a", "aa", "aaa"]
    vocabulary = sentencepiece_nbest.Vocabulary(pieces, [0.0] * 259 + [-1.0, -1.0, -2.0, -3.0], list(range(3, 259)))
    for length in (3, 6, 3000):  # every segmentation has the same score
        ids, _, scores, more = sentencepiece_nbest.Encoder(vocabulary, 4).encode(["a" * length])
        got = [tuple(ids.tolist())] + [tuple(sentencepiece_nbest.apply_edits(ids.tolist(), a["edits"])) for a in more[0]]
        assert len(set(got)) == 4 and {vocabulary.text(i) for i in got} == {"a" * length}
        assert np.allclose([scores[0], *[a["score"] for a in more[0]]], -1.0 - length)


def test_n_best_of_a_very_long_chunk():
    vocabulary = sentencepiece_nbest.Vocabulary.load()
    text = "".join(map(chr, np.random.default_rng(6).integers(97, 123, 60_000)))
    ids, _, _, more = sentencepiece_nbest.Encoder(vocabulary, 4).encode([text])
    got = [ids.tolist()] + [sentencepiece_nbest.apply_edits(ids.tolist(), a["edits"]) for a in more[0]]
    assert len(set(map(tuple, got))) == 4 and {vocabulary.text(i) for i in got} == {text}
    assert [a["score"] for a in more[0]] == sorted((a["score"] for a in more[0]), reverse=True)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(f"{a:03}".encode(), f"{b:03}".encode()) for a, b in rng.integers(0, 300, size=(220, 2))] + [(b"998", b"999")]
    edges += [(f"c{i:02}".encode(), f"c{i + 1:02}".encode()) for i in range(40)]
    found = {bytes(r.node): bytes(r.root) for r in graph.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: r for x, r in root.items() if x not in alone}


@pytest.mark.parametrize("block", [4, 256])
def test_near_copies_by_blocks(spark, block):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 120)]
    texts = []
    for _ in range(30):
        own = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            own[at] = f"x{rng.integers(0, 10_000)}"
        texts.append(" ".join(own))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for t in texts]
    links = [sum(i != j and len(a & b) / len(a | b) >= 0.8 for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    rows = near_dup_forest.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), block=block).collect()
    assert {r.doc_id: r.n_links for r in rows} == dict(enumerate(links))


def test_prefix_depth():
    depth = near_dup_forest.prefix_depth(0.8, 20, 0.995)
    assert 1 - (1 - 0.8**depth) ** 20 >= 0.995 > 1 - (1 - 0.8 ** (depth + 1)) ** 20 or depth == 6
    with pytest.raises(ValueError):
        near_dup_forest.prefix_depth(0.1, 2, 0.999)


def test_highest_quotients(spark):
    rng = np.random.default_rng(1)
    cases = [(g, p, int(w), seats) for g, seats in ((1, 7), (2, 100), (3, 1), (4, 2500)) for p, w in enumerate(rng.integers(0, 1000, 9) ** 2)]
    rows = source_mix.highest_quotients(spark.createDataFrame(cases, "g int, p int, w bigint, s bigint"), "g", "p", "w", "s").collect()
    for g, some in itertools.groupby(cases, key=lambda c: c[0]):
        some = list(some)
        won = dict.fromkeys((p for _, p, *_ in some), 0)
        for _ in range(some[0][3]):
            best = max((p for _, p, w, _ in some if w), key=lambda p: (some[p][2] / (2 * won[p] + 1), -p))
            won[best] += 1
        assert {r.p: r.quota for r in rows if r.g == g and r.quota} == {p: n for p, n in won.items() if n}


def test_mixture_of_languages():
    rng = np.random.default_rng(2)
    probabilities = rng.dirichlet(np.full(language_mixture.BUCKETS, 0.05), 3) + 1e-9
    model = language_mixture.Model(["x", "y", "z"], probabilities / probabilities.sum(axis=1, keepdims=True), 8.0, 40)
    counts = rng.multinomial(3000, 0.7 * model.probabilities[0] + 0.3 * model.probabilities[2])
    shares, _ = model._mixture(model.probabilities[:, counts > 0], counts[counts > 0].astype(float))
    assert np.allclose(shares, [0.7, 0, 0.3], atol=0.05)


def test_positive_unlabelled_learning():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(1, 1, (4000, 3)), rng.normal(-1, 1, (4000, 3))
    model = pu_quality.learn(good[:1500], np.concatenate((good[1500:3600], bad[:900])))
    assert abs(model.prior - 0.7) < 0.08
    assert (model.scores(good[3600:]) > 0.5).mean() > 0.9 and (model.scores(bad[900:]) < 0.5).mean() > 0.85


@needs_tables
def test_language_held_out(spark):
    lang = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op4_language_mixture"](spark, FOLDER).where("held_out").join(lang, "doc_id")
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


@needs_tables
def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op7_pu_quality"](spark, FOLDER).where("held_out").join(labels, "doc_id")
    assert found.select(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


@needs_tables
def test_forest_recall(spark):
    import duckdb

    rows = duckdb.sql(f"select vec_id, embedding from '{FOLDER}/../sf0.1/embeddings.parquet' order by vec_id").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = QUERIES["op9_prefix_forest"](spark, f"{FOLDER}/../sf0.1").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        true = [i for i in ids[np.lexsort((ids, far))] if i != q][:10]
        hits, total = hits + len(set(true) & set(got[q])), total + 10
        assert all(abs(far[ids == i][0] - s) < 1e-12 for i, s in got[q].items()) and len(got[q]) == 10
    assert hits / total >= 0.9
    assert prefix_forest.block_count(10**9) == 15_259


@needs_tables
def test_pipeline_stages(spark):
    import corpus_pipeline

    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mix", "encode"]


def test_second_languages_are_found_among_many():
    """Mixtures of two of forty languages, after the few steps that are run in production."""
    rng = np.random.default_rng(8)
    probabilities = rng.dirichlet(np.full(language_mixture.BUCKETS, 0.02), 40) + 1e-9
    model = language_mixture.Model([f"l{k:02}" for k in range(40)], probabilities / probabilities.sum(axis=1, keepdims=True), 8.0, 12)
    seen = rng.multinomial(400, 0.6 * model.probabilities[3] + 0.4 * model.probabilities[17])
    text_of = language_mixture.trigrams
    try:
        language_mixture.trigrams = lambda text: np.repeat(np.arange(language_mixture.BUCKETS), seen)
        found = model.infer("x")
    finally:
        language_mixture.trigrams = text_of
    assert found[0] == "l03" and found[2] == ["l03", "l17"]


def test_language_sets_against_all_sets():
    """With four languages: no other set, run to convergence, pays for its size better."""
    from itertools import combinations

    rng = np.random.default_rng(5)
    probabilities = rng.dirichlet(np.full(language_mixture.BUCKETS, 0.05), 4) + 1e-9
    model = language_mixture.Model(list("abcd"), probabilities / probabilities.sum(axis=1, keepdims=True), 8.0, 12)
    text_of = language_mixture.trigrams
    try:
        for mix in ([1, 0, 0, 0], [0.7, 0, 0.3, 0], [0.4, 0.3, 0, 0.3], [0.25] * 4):
            seen = rng.multinomial(600, np.array(mix) @ model.probabilities)
            language_mixture.trigrams = lambda text, seen=seen: np.repeat(np.arange(language_mixture.BUCKETS), seen)
            at = np.flatnonzero(seen)
            counts, best = seen[at].astype(float), None
            for size in range(1, 5):
                for some in combinations(range(4), size):
                    likelihood = model.probabilities[np.ix_(some, at)]
                    shares = np.full(size, 1 / size)
                    for _ in range(300):
                        shares = shares * (likelihood @ (counts / (shares @ likelihood))) / counts.sum()
                    value = counts @ np.log(shares @ likelihood) - 8.0 * np.log(601) * (size - 1)
                    if best is None or value > best[0]:
                        best = (value, sorted("abcd"[k] for k in some))
            assert sorted(model.infer("x")[2]) == best[1]
    finally:
        language_mixture.trigrams = text_of
