"""Operator 11, alignment of two tokenizers' tokens over the same bytes.

Both tokenizers read the text behind one space: a byte-level BPE (A), and a piece vocabulary
that puts the space there itself (B). Per batch, pandas ``merge_asof`` finds for the start of
every A token the B token that covers it, and the other way round; the key is the document's
place in the batch followed by the byte, so that no match leaves a document. The union of both
directions are the overlaps. Where the start of a token is also the start of the token that
covers it, both sides have just ended together: such bytes cut the document into groups. Every
A token of a group is linked to every B token of it.

``align`` gives tokens, overlaps and groups of every row. ``link_counts`` counts, for every
pair of ids, the documents that hold it linked, and judges every document's links by these
counts. Nothing of that passes through the driver: the documents of a block send the distinct
pairs of the block to the counts, the answers come back to the block, and its documents read
them. A block is bounded by the pairs of its documents and holds at least one document; its size does not
depend on the corpus. A group of very many tokens is reduced to its distinct ids first.

Texts that are null, empty, or whose tokens do not give the bytes back (a literal U+2581, for
example) have no tokens: zeros, an empty string for the groups. Repeated rows count as
documents of their own. Whole texts of any length are read; an empty table gives an empty result.
Columns of the input other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns
from foliosift.llm.remembered import Remembered, byte_signs, kept, ragged, slices, spaced_chunks
from foliosift.session import materialise

#: Where the public vocabularies lie; parameters of every call.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text worked on at once, distinct pairs of documents in a block, and links of a group
#: beyond which its distinct ids are paired instead.
_SLICE = 1 << 21
_BLOCK = 1 << 20
_WIDE = 1 << 16
#: The words of a byte-level BPE, for chunks of common characters; the library cuts all others.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"(?: |\n(?![ \n]))(?:[!-~{_LATIN}]|\n(?![ \n]|\\Z))*").fullmatch
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^ \n0-9{_LATIN}]+| (?!\\S)|\n").findall
#: An id pair as one number: A above, B in the lower bits.
_B_BITS = 24


class Pair:
    """The two tokenizers: ids of chunks, and the bytes of every id."""

    def __init__(self, byte_bpe: str = BYTE_BPE, pieces: str = PIECES):
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(byte_bpe)
        self._sign = byte_signs()
        value = {sign: b for b, sign in self._sign.items()}
        self._a, self._words, self._known = a.model, a.pre_tokenizer, {}
        size = a.get_vocab_size()
        raw_a = []
        for i in range(size):
            token = a.id_to_token(i)
            raw_a.append(bytes(value[c] for c in token) if all(c in value for c in token) else token.encode())
        self._b = b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        if b.normalize("ﬁ Ａ  x ") != "▁ﬁ▁Ａ▁▁x▁" or any("▁" in p.lstrip("▁") for p in map(b.id_to_piece, range(b.get_piece_size()))):
            raise ValueError("only piece vocabularies with an identity normaliser and spaces in front are supported")
        raw_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.get_piece_size())
        ]
        if len(raw_b) >= 1 << _B_BITS:
            raise ValueError("the piece vocabulary is too large")
        self.raw = [pa.array(raw_a, pa.binary()), pa.array(raw_b, pa.binary())]

    def encode_a(self, chunks: list[str]) -> list[list[int]]:
        known, sign, model, out = self._known, self._sign, self._a.tokenize, []
        if len(known) > 150_000:
            known.clear()
        for chunk in chunks:
            ids: list[int] = []
            if _PLAIN(chunk):
                words = _WORDS(chunk)
                if chunk.isascii():
                    shown = [w.replace(" ", "Ġ").replace("\n", "Ċ") for w in words]
                else:
                    shown = [w.encode().decode("latin-1").translate(sign) for w in words]
            else:
                shown = [w for w, _ in self._words.pre_tokenize_str(chunk)]
            for word in shown:
                if (found := known.get(word)) is None:
                    found = [t.id for t in model(word)]
                    if len(word) < 100:
                        known[word] = found
                ids += found
            out.append(ids)
        return out

    def encode_b(self, chunks: list[str]) -> list[list[int]]:
        """The first space of a chunk is the one that the vocabulary puts in front itself."""
        found = self._b.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if c != " " else [self._b.piece_to_id("▁")] for c, ids in zip(chunks, found, strict=True)]


class Aligned:
    """Tokens, overlaps and groups of the texts of one slice."""

    def __init__(self, pair: Pair, memory: Remembered, texts: pa.Array):
        self.n = len(texts)
        filled = pc.fill_null(texts, "")
        chunks, codes, bounds = spaced_chunks(filled)
        sides = memory.gather(memory.places(chunks)[codes], bounds)
        # A chunk of an empty text is the space alone; such texts have no tokens.
        usable = pc.greater(pc.binary_length(filled), 0).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise("", filled, " ")
        for raw, (ids, ends) in zip(pair.raw, sides, strict=True):
            usable &= _gives_back(raw, ids, ends, spaced)
        self.ids, self.ends, self.starts = [], [], []
        for raw, (ids, ends) in zip(pair.raw, sides, strict=True):
            counts = np.where(usable, np.diff(ends), 0)
            if not usable.all():
                ids = ids[ragged(ends[:-1], counts)]
            lengths = pc.binary_length(raw).to_numpy(zero_copy_only=False)[ids].astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(counts)))
            after = np.cumsum(lengths)
            row = np.repeat(np.arange(self.n), counts)
            base = np.concatenate(([0], after))[ends[:-1]]
            self.ids.append(ids)
            self.ends.append(ends)
            self.starts.append(row << 40 | (after - lengths - base[row]))
        self.row = row  # of every B token
        covers = [self._covering(0, 1), self._covering(1, 0)]
        #: Union of both directions; a pair that starts together comes from both.
        self.first = [self.starts[0] == self.starts[1][covers[0]], self.starts[1] == self.starts[0][covers[1]]]
        self.covers = covers
        self.group = [np.cumsum(f) - 1 for f in self.first]
        at = [np.flatnonzero(f) for f in self.first]
        self.group_start = at
        self.size = [np.diff(np.concatenate((x, [len(i)]))) for x, i in zip(at, self.ids, strict=True)]
        self.group_row = self.starts[0][at[0]] >> 40

    def _covering(self, one: int, other: int) -> np.ndarray:
        left = pd.DataFrame({"at": self.starts[one]})
        right = pd.DataFrame({"at": self.starts[other], "token": np.arange(len(self.starts[other]))})
        return pd.merge_asof(left, right, on="at")["token"].to_numpy().astype(np.int64)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """(A token, B token) of every overlap in order, by number in the slice."""
        a = np.concatenate((np.arange(len(self.ids[0])), self.covers[1][~self.first[1]]))
        b = np.concatenate((self.covers[0], np.flatnonzero(~self.first[1])))
        order = np.lexsort((b, a))
        return a[order], b[order]

    def per_row(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.group_row, weights=values, minlength=self.n).astype(np.int64)

    def digests(self, names: pa.Array) -> list[str]:
        """``a1,a2|b1;…`` of every row, hashed; '' without tokens. ``names`` holds the decimals
        of all ids four times, followed by ``,``, ``|``, ``;`` and nothing."""
        kind = len(names) // 4
        total = len(self.ids[0]) + len(self.ids[1])
        item = np.empty(total, np.int64)
        last = [np.append(f[1:], True) if len(f) else f for f in self.first]
        item[np.arange(len(self.ids[0])) + self.group_start[1][self.group[0]]] = self.ids[0] + kind * last[0]
        ends = self.group_start[0] + self.size[0]
        done = np.append(self.row[1:] != self.row[:-1], True) if len(self.row) else np.zeros(0, bool)
        item[np.arange(len(self.ids[1])) + ends[self.group[1]]] = self.ids[1] + kind * (2 * last[1] + done)
        taken = names.take(pa.array(item))
        offsets = np.frombuffer(taken.buffers()[1], np.int32)[: total + 1]
        data = memoryview(taken.buffers()[2]) if total else memoryview(b"")
        borders = offsets[self.ends[0] + self.ends[1]]
        return [
            hashlib.sha256(data[a:b]).hexdigest() if b > a else "" for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)
        ]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id pair, links of it) of the distinct linked pairs of every row, in order."""
        keys, weights = [], []
        wide = self.size[0] * self.size[1] > _WIDE
        narrow = ~wide[self.group[0]]
        group = self.group[0][narrow]
        counts = self.size[1][group]
        key = self.group_row[group] << 48 | self.ids[0][narrow].astype(np.int64) << _B_BITS
        if len(self.ids[0]) and int(self.ids[0].max()) >> (48 - _B_BITS):
            raise ValueError("the byte vocabulary is too large")
        rows = np.repeat(key, counts) | self.ids[1][ragged(self.group_start[1][group], counts)]
        keys.append(rows)
        weights.append(np.ones(len(rows), np.int64))
        for g in np.flatnonzero(wide):
            a, na = np.unique(self.ids[0][self.group_start[0][g] :][: self.size[0][g]], return_counts=True)
            b, nb = np.unique(self.ids[1][self.group_start[1][g] :][: self.size[1][g]], return_counts=True)
            keys.append((self.group_row[g] << 48 | np.repeat(a.astype(np.int64) << _B_BITS, len(b))) | np.tile(b, len(a)))
            weights.append(np.repeat(na, len(b)) * np.tile(nb, len(a)))
        if len(keys) == 1:
            key, weight = np.unique(keys[0], return_counts=True)
        else:
            key, where = np.unique(np.concatenate(keys), return_inverse=True)
            weight = np.bincount(where, weights=np.concatenate(weights).astype(float)).astype(np.int64)
        return key >> 48, key & ((1 << 48) - 1), weight


def _gives_back(raw: pa.Array, ids: np.ndarray, ends: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Which texts the joined bytes of their ids are equal to."""
    joined = raw.take(pa.array(ids))
    offsets = np.frombuffer(joined.buffers()[1], np.int32)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
    data = memoryview(joined.buffers()[2] or b"") if len(ids) else memoryview(b"")
    borders = offsets[ends].astype(np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    wanted = memoryview(texts.buffers()[2] or b"")
    same = np.diff(borders) == np.diff(at)
    if same.all() and data[borders[0] : borders[-1]] == wanted[at[0] : at[-1]]:
        return same
    for k in np.flatnonzero(same):
        same[k] = data[borders[k] : borders[k + 1]] == wanted[at[k] : at[k + 1]]
    return same


class _Worker:
    """What a task needs, made once per process."""

    def __init__(self, byte_bpe: str, pieces: str):
        self.pair = Pair(byte_bpe, pieces)
        self.memory = Remembered([self.pair.encode_a, self.pair.encode_b], 250_000, 1 << 21)
        ids = max(len(raw) for raw in self.pair.raw)
        self.names = pa.array([f"{i}{end}" for end in (",", "|", ";", "") for i in range(ids)])

    @classmethod
    def here(cls, *paths: str) -> _Worker:
        return kept(f"alignment {paths}", lambda: cls(*paths))

    def align(self, texts: pa.Array) -> Aligned:
        return Aligned(self.pair, self.memory, texts)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """(id, a_ids, b_ids, overlaps, groups): the ids of both sides, the overlapping tokens as
    pairs of places in them, and how many tokens of either side each group has."""
    require_columns(docs, id_col, text_col)
    part = "array<struct<a:int,b:int>>"
    ids = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    schema = f"id {ids.schema['id'].dataType.simpleString()}, a_ids array<int>, b_ids array<int>, overlaps {part}, groups {part}"

    def lists(ends: np.ndarray, *values: np.ndarray) -> pa.Array:
        flat = [pa.array(v, pa.int32()) for v in values]
        inner = flat[0] if len(flat) == 1 else pa.StructArray.from_arrays(flat, ["a", "b"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Worker.here(byte_bpe, pieces)
        for rows in slices(batches, 1, _SLICE):
            found = worker.align(rows.column(1))
            a, b = found.overlaps()
            row = np.repeat(np.arange(found.n), np.diff(found.ends[0]))[a]
            borders = np.arange(found.n + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    lists(found.ends[0], found.ids[0]),
                    lists(found.ends[1], found.ids[1]),
                    lists(np.searchsorted(row, borders), a - found.ends[0][row], b - found.ends[1][row]),
                    lists(np.searchsorted(found.group_row, borders), *found.size),
                ],
                names=["id", "a_ids", "b_ids", "overlaps", "groups"],
            )

    return ids.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _blocks(docs: DataFrame, byte_bpe: str, pieces: str, most: int) -> DataFrame:
    """A row per document, whose links name places in its block's list of pairs, and then a row
    per block: that list in order, and how many of the block's documents hold each pair."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = (
        f"block bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "place array<int>, links array<bigint>, pairs array<bigint>, n array<int>"
    )
    names = ["block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "links", "pairs", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Worker.here(byte_bpe, pieces)
        block = TaskContext.get().partitionId() << 32
        held: list = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate([x[2] for x in held]), return_counts=True)
            for columns, ends, own, links in held:
                place = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.searchsorted(pairs, own), pa.int32()))
                rows = len(ends) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, block)),
                        *columns,
                        place,
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(links, pa.int64())),
                        pa.nulls(rows, pa.list_(pa.int64())),
                        pa.nulls(rows, pa.list_(pa.int32())),
                    ],
                    names=names,
                )
            one = [pa.array([block]), *(pa.nulls(1, c.type) for c in held[0][0]), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*one, pa.array([pairs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int32()))], names=names)

        for rows in slices(batches, 1, _SLICE):
            found = worker.align(rows.column(1))
            row, pairs, links = found.links()
            counts = [
                *(np.diff(e) for e in found.ends),
                np.bincount(found.group_row, minlength=found.n),
                found.per_row(found.size[0] * found.size[1]),
            ]
            columns = [rows.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(found.digests(worker.names), pa.string())]
            held.append((columns, np.searchsorted(row, np.arange(found.n + 1)), pairs, links))
            size += len(pairs)
            if size >= most:
                yield from close()
                held, size, block = [], 0, block + 1
                pa.default_memory_pool().release_unused()
        if held:
            yield from close()

    return docs.mapInArrow(run, schema)


def link_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_bpe: str = BYTE_BPE,
    pieces: str = PIECES,
    most: int = _BLOCK,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many
    documents as any pair of its A id), count_sum (documents of their pairs, over all links)
    and groups_sha256."""
    require_columns(docs, id_col, text_col)
    ids = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    stored = materialise(_blocks(ids, byte_bpe, pieces, most), "aligned")
    met = stored.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "n")).alias("place", "x"))
    met = met.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.n").alias("n"))
    totals = materialise(met.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    by_a = totals.withColumn("a", F.shiftright("pair", _B_BITS))
    judged = by_a.join(by_a.groupBy("a").agg(F.max("n").alias("most")), "a").select(
        "pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best")
    )
    answers = met.join(judged, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    rows = stored.where(F.col("pairs").isNull()).drop("pairs", "n")
    kind = ids.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def judge(rows: pa.Table, answers: pa.Table) -> pa.Table:
        place = answers["place"].to_numpy()
        values = np.zeros((2, len(place)), np.int64)
        values[0, place] = answers["best"].to_numpy()
        values[1, place] = answers["total"].to_numpy()
        rows = rows.combine_chunks()
        at = pc.list_flatten(rows["place"]).to_numpy()
        links = pc.list_flatten(rows["links"]).to_numpy()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(rows["place"]).to_numpy())))
        sums = [np.concatenate(([0], np.cumsum(v[at] * links))) for v in values]
        out = rows.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        for name, s in zip(("n_best", "count_sum"), sums, strict=True):
            out = out.append_column(name, pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()))
        return out.append_column("groups_sha256", rows["groups_sha256"])

    done = rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(judge, schema)
    return done.withColumnRenamed("id", id_col)
