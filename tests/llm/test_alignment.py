"""Token alignment against the tokenizer libraries and plain loops."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest

from foliosift.llm import token_alignment
from foliosift.session import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """Text to its tokens on both sides, (ids, bytes), by the libraries on the whole text."""
    sentencepiece = pytest.importorskip("sentencepiece")
    tokenizers = pytest.importorskip("tokenizers")
    a = tokenizers.Tokenizer.from_file(token_alignment.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECES)
    raw_a = token_alignment.Pair().raw[0].to_pylist()

    def raw_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [raw_a[i] for i in ids_a], [raw_b(i) for i in ids_b]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return [], [], [], []
        return ids_a, ids_b, bytes_a, bytes_b

    return tokens


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def groups(ids_a, ids_b, bytes_a, bytes_b):
    a, b = spans(bytes_a), spans(bytes_b)
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    out, i, j = [], 0, 0
    for cut in cuts:
        n, m = i, j
        while n < len(a) and a[n][1] <= cut:
            n += 1
        while m < len(b) and b[m][1] <= cut:
            m += 1
        out.append((ids_a[i:n], ids_b[j:m]))
        i, j = n, m
    return out


def expected(texts, tokens):
    every = [groups(*tokens(t)) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in every]
    count = Counter(p for link in links for p in link)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for g, link in zip(every, links, strict=True):
        name = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append(
            (
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                sum(link.values()),
                sum(n for p, n in link.items() if count[p] == best[p[0]]),
                sum(n * count[p] for p, n in link.items()),
                hashlib.sha256(name.encode()).hexdigest() if g else "",
            )
        )
    return out


ODD = [
    None,
    "",
    " ",
    "  two  spaces   three\n\n new\n line \t tab \n",
    "\n",
    "a\n b\n  c",
    "ends in space ",
    "ends in line\n",
    "don't we'll 'tis it's I'm",
    "literal ▁ mark",
    "<|endoftext|> and <s> <unk> <0x41>",
    "日本語のテキスト と emoji 👩‍👩‍👧 𝒳 and é é ﬁ ² Ⅷ ٣",
    "x" * 3000 + "aé" * 2000 + "=" * 500,
    "control \x00\x1c\x1f\x85\xa0 　 signs   line",
    "Ab1 c2d3 !!! ?!​ zero",
    "same text",
    "same text",
    "word " * 40_000,
]


@pytest.mark.parametrize("most", [1, 1 << 21])
def test_odd_texts(spark, plain, most):
    rows = [(i // 2, t, 1, 2) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "`a.b` bigint, body string, block int, place int").repartition(3)
    got = token_alignment.link_counts(docs, "a.b", "body", most=most)
    assert got.columns == ["a.b", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i // 2, *r) for i, r in enumerate(expected(ODD, plain))]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert want[0][1:] == want[1][1:] == want[9][1:] == (0, 0, 0, 0, 0, 0, "")
    assert want[3][1] > 0 and want[10][1] > 0 and want[11][1] > 0


def test_wide_groups(plain, monkeypatch):
    """The way of very wide groups counts the same links."""
    import pyarrow as pa

    texts = pa.array([t for t in ODD if t])
    worker = token_alignment._Worker(token_alignment.BYTE_BPE, token_alignment.PIECES)
    usual = [x.tolist() for x in worker.align(texts).links()]
    monkeypatch.setattr(token_alignment, "_WIDE", 1)
    assert [x.tolist() for x in worker.align(texts).links()] == usual


def test_overlaps(spark, plain):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    for r in token_alignment.align(docs).collect():
        ids_a, ids_b, bytes_a, bytes_b = plain(ODD[r.doc_id])
        assert (r.a_ids, r.b_ids) == (ids_a, ids_b)
        assert [(g.a, g.b) for g in r.groups] == [(len(a), len(b)) for a, b in groups(ids_a, ids_b, bytes_a, bytes_b)]
        a, b, i, j, want = spans(bytes_a), spans(bytes_b), 0, 0, []
        while i < len(a) and j < len(b):
            want.append((i, j))
            i, j = i + (a[i][1] <= b[j][1]), j + (b[j][1] <= a[i][1])
        assert [(o.a, o.b) for o in r.overlaps] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_alignment.link_counts(docs).count() == token_alignment.align(docs).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_query(spark, plain):
    from foliosift.llm.queries import QUERIES

    docs = table(spark, FOLDER, "documents", "doc_id", "text").collect()
    want = [(d.doc_id, *r) for d, r in zip(docs, expected([d.text for d in docs], plain), strict=True)]
    assert sorted(map(tuple, QUERIES["op11_token_alignment"](spark, FOLDER).collect())) == sorted(want)
