"""Token files: exact round trips against the tokenizer library, damage, checkpoints, size."""

import os
import zlib

import numpy as np
import pytest

from foliosift.llm import token_files
from foliosift.session import scratch_path, table

FOLDER = "/root/testdata/sf0.001"

ODD = [
    (None, None),
    (None, "null id"),
    (7, ""),
    (3, "  Two  spaces\n\nAND lines\t\ttabs "),
    (3, "  Two  spaces\n\nAND lines\t\ttabs "),
    (3, "another text of this id"),
    (-5, "don't WE'LL 'tis it's ÀÉß x2 10% a--b!? </w> snake_case é"),
    (4, "<|endoftext|> and a<|startoftext|>b <| |>"),
    (9, "日本語 emoji 👩‍👩‍👧 𝒳 é ﬁ ² Ⅷ ٣ İ Σς"),
    (10, "control \x00\x1c\x1f\x85\xa0　  signs"),
    (11, "x" * 5000 + "é" * 3000),
    (1 << 40, "word soup, " * 30_000),
]


@pytest.fixture(scope="module")
def encode():
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_file(token_files.WORD_BPE)
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


def expected(rows, encode):
    out, start = [], 0
    for doc_id, text in rows:
        ids = encode(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_round_trip(spark, encode):
    docs = spark.createDataFrame([(t, i, 0, 1) for i, t in ODD], "`the text` string, doc_id bigint, file int, start int").repartition(3)
    path = scratch_path(spark, "test-tokens")
    token_files.write(docs, path, text_col="the text")
    got = sorted(map(tuple, token_files.read(spark, path).collect()), key=lambda r: r[1])
    order = [i for i, *_ in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    # Texts of one id stand in the order of a hash.
    texts = {tuple(encode(t)): t for _, t in ODD if t}
    assert got == expected([(i, texts.get(tuple(ids))) for i, *_, ids in got], encode)
    assert sorted((str(r[0]), r[4]) for r in got) == sorted((str(i), encode(t)) for i, t in ODD)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    path = scratch_path(spark, "test-tokens")
    token_files.write(docs, path)
    assert token_files.read(spark, path).count() == 0


def sections(monkeypatch, docs, section=1000, block=256, step=64):
    for name, value in (("SECTION", section), ("BLOCK", block), ("STEP", step)):
        monkeypatch.setattr(token_files, name, value)
    writer = token_files.SectionWriter(3)
    records = [r for i, ids in docs for r in writer.add(i, np.array(ids, np.int64))]
    return b"".join(r + b"\n" for r in [*records, *writer.close()])


@pytest.mark.parametrize("sizes", [[1], [256, 256], [255, 1, 1], [0, 5, 0], [3, 5000, 2, 999], [1000, 1000], [257]])
def test_sections(monkeypatch, sizes):
    """Documents across blocks and sections, at all borders."""
    rng = np.random.default_rng(1)
    docs = [(k if k else None, rng.zipf(1.3, n) % 49_000) for k, n in enumerate(sizes)]
    content, back = sections(monkeypatch, docs), []
    for file, ids, pieces in token_files.read_sections(content):
        assert file == 3
        start = 0
        for doc_id, n, again in pieces:
            if again:
                back[-1][1].extend(ids[start : start + n].tolist())
            else:
                back.append([doc_id, ids[start : start + n].tolist()])
            start += n
        assert start == len(ids)
    assert back == [[i, x.tolist()] for i, x in docs]


def test_parts_alone(monkeypatch):
    """Any part decodes from its checkpoint without what stands before it."""
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50, 1024)
    monkeypatch.setattr(token_files, "STEP", 128)
    bits, symbols, given = token_files.frequencies(ids)
    words, borders, marks, before = token_files.code_blocks(np.searchsorted(symbols, ids).reshape(2, 512), given, bits)
    for block in range(2):
        for part in range(4):
            own = words[borders[block] : borders[block + 1]]
            found, *_ = token_files.decode_parts(own, before[block, part : part + 1], marks[block, part : part + 1], np.array([128]), given, bits)
            assert (symbols[found[0]] == ids[512 * block + 128 * part :][:128]).all()


def test_damage_is_found(monkeypatch):
    content = sections(monkeypatch, [(k, np.arange(50) * k % 97) for k in range(30)])
    list(token_files.read_sections(content))
    rng = np.random.default_rng(3)
    for at in [0, 5, len(content) - 2, *rng.integers(0, len(content), 60)]:
        bad = bytearray(content)
        bad[at] ^= 1 << rng.integers(0, 8)
        with pytest.raises(token_files.CorruptFile):
            list(token_files.read_sections(bytes(bad)))
    with pytest.raises(token_files.CorruptFile):
        list(token_files.read_sections(content[:-10]))


def test_frequencies_and_size():
    """The table sums up to its scale, and the words come near the entropy."""
    rng = np.random.default_rng(4)
    for ids in (np.array([5]), np.arange(40_000), rng.zipf(1.2, 1 << 17) % 49_408):
        bits, symbols, given = token_files.frequencies(ids)
        assert given.sum() == 1 << bits and given.min() >= 1 and len(symbols) == len(given)
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    words, *_ = token_files.code_blocks(np.searchsorted(symbols, ids).reshape(2, -1), given, bits)
    assert 32 * len(words) < 1.01 * len(ids) * -(p * np.log2(p)).sum()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_query(spark, encode):
    from foliosift.llm.queries import QUERIES

    docs = table(spark, FOLDER, "documents", "doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op13_token_files"](spark, FOLDER).collect()))
    assert got == [r[:4] for r in expected(docs, encode)]
