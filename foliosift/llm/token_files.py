"""Operator 13, token ids in binary files: static range asymmetric numeral systems.

The texts are put in ascending order of id over all tasks, encoded by a public tokenizer, an end
id behind each, and every task writes one file. A file is a row of sections, each a frequency
table and the blocks that share it; the table is counted over all ids of the section, so a task
holds one section at a time and reads its rows once. A block codes ``BLOCK`` ids over ``LANES``
interleaved 64-bit states that put out 32-bit words, all blocks of a section side by side as
arrays. Blocks stand alone: each names its file, number, ids and documents. Within a block every
``STEP`` ids stand a checkpoint (all states, the place in the words) and a checksum of the ids up
to the next, so each such part is decoded by itself, also side by side. A part must end in the
states of the next checkpoint and give its checksum; the bytes of a record have their own.

A record (all numbers little-endian) is a magic of 4 bytes, its length (64 bits), its body, the
crc32 of the body and a line feed, which the writer of text files adds:

* ``FST1``, table: scale bits, symbols (32 bits each); then ids and frequencies (32 bits).
* ``FSB1``, block: file, number in file, ids, document pieces, checkpoints, words (32 bits each);
  per piece its id (64 bits), ids (64 bits) and flags (8 bits: 1 id is null, 2 continues an
  earlier piece); per checkpoint its place in the words and checksum (32 bits) and its states
  (64 bits); the words.

Files go through Spark's own writer and reader, so any store that Spark reaches will do.

Ids of documents are integers (cast to bigint); null ids come first. Rows of one id stand in the
order of a hash of their texts; equal rows are alike. Null and empty texts have the end id alone.
Texts may have any length; a text longer than a section spans several. An empty table gives no
blocks and no rows. Further columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns
from foliosift.llm.remembered import Remembered, byte_signs, kept, slices

#: Where the public vocabulary lies, and the id behind each document; parameters of every call.
WORD_BPE = "/opt/tokenizers/word_bpe_49k.json"
END_ID = 1
#: Ids of a section, of a block and between checkpoints; states of a block. Fixed by the format
#: are only the lanes and the step.
SECTION = 1 << 21
BLOCK = 1 << 16
STEP = 1 << 14
LANES = 32
_SLICE = 1 << 22
#: Two signs in a row that are neither common letters, digits nor white space.
_SIGNS = r"[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ]{2}"
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
TABLE, CODED = b"FST1", b"FSB1"
_HEAD, _HEAD_SIZE = "<4sQ", 12
_BLOCK_HEAD, _BLOCK_HEAD_SIZE = "<6I", 24


class CorruptFile(ValueError):
    """A file of token ids does not hold what was written."""


class WordEncoder:
    """The tokenizer's ids of distinct chunks (texts between spaces and line ends)."""

    _plain = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
    _words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall

    def __init__(self, path: str = WORD_BPE):
        from tokenizers import Tokenizer

        self._all = Tokenizer.from_file(path)
        self._model, self._sign = self._all.model, byte_signs()
        # Only for vocabularies that cut and fold words as the short way does.
        sample = "It's WE'LL ÀÉß don't x2 10% a--b!? </w> é_è 'tis a.b.. ,c".split(" ")
        self._short = [self._word(w) for w in sample] == [self._all.encode(w, add_special_tokens=False).ids for w in sample]
        self.memory = Remembered([self.encode], 600_000, 1 << 22)

    @classmethod
    def here(cls, path: str) -> WordEncoder:
        return kept(f"words {path}", lambda: cls(path))

    def _word(self, chunk: str) -> list[int]:
        if chunk.isalpha() and chunk.isascii():
            return [t.id for t in self._model.tokenize(chunk.lower())]
        ids: list[int] = []
        for word in self._words(chunk.lower()):
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self._sign)
            ids += [t.id for t in self._model.tokenize(shown)]
        return ids

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Word by word where every character is common and no special token can stand."""
        easy = [self._short and self._plain(c) is not None and "<|" not in c for c in chunks]
        hard = [c for c, e in zip(chunks, easy, strict=True) if not e]
        others = iter([x.ids for x in self._all.encode_batch_fast(hard, add_special_tokens=False)] if hard else [])
        return [self._word(c) if e else next(others) for c, e in zip(chunks, easy, strict=True)]

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (nulls are empty), the end id behind each, and their borders.

        The vocabulary drops white space and cuts between letters, digits and runs of other
        signs, so chunks end at spaces. In texts without two such signs in a row, points and
        commas are words of their own and case means nothing: fewer chunks differ there."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        if self._short:
            even = pc.invert(pc.match_substring_regex(texts, _SIGNS))
            apart = pc.replace_substring(pc.replace_substring(pc.ascii_lower(texts), ".", " . "), ",", " , ")
            texts = pc.if_else(even, apart, texts)
        lists = pc.split_pattern(texts, " ")
        borders = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))))
        chunks = lists.flatten().dictionary_encode()
        places = self.memory.places(chunks.dictionary)[chunks.indices.to_numpy(zero_copy_only=False)]
        ids, ends = self.memory.gather(places, borders)[0]
        counts = np.diff(ends) + 1
        bounds = np.concatenate(([0], np.cumsum(counts)))
        out = np.full(int(bounds[-1]), end_id, np.int32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = ids
        return out, bounds


def frequencies(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Scale bits, distinct ids, and their frequencies, which are at least 1 and sum up to the scale."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = min(28, max(8, int(len(symbols)).bit_length() + 5))
    scale = 1 << bits
    exact = counts * (scale / counts.sum())
    given = np.maximum(1, np.floor(exact)).astype(np.int64)
    over = int(given.sum()) - scale
    if over < 0:  # to those that lost most
        given[np.argsort(given - exact, kind="stable")[:-over]] += 1
    while over > 0:  # from those that have most to spare
        spare = np.argsort(-given, kind="stable")[: max(1, len(given) // 4)]
        take = np.minimum(given[spare] - 1, max(1, -(-over // len(spare))))
        take = np.minimum(take, np.maximum(0, over - np.concatenate(([0], np.cumsum(take)[:-1]))))
        given[spare] -= take
        over -= int(take.sum())
    return bits, symbols, given


def code_blocks(places: np.ndarray, given: np.ndarray, bits: int):
    """Codes blocks of places in the table, one per row of ``places`` (-1 behind the last of a
    block). Gives the words of all blocks, their borders, and for every checkpoint the states
    and the place in its block's words."""
    blocks, steps = places.shape[0], places.shape[1] // LANES
    freq, base = given.astype(np.uint64), (np.cumsum(given) - given).astype(np.uint64)
    lanes = places.reshape(blocks, steps, LANES)
    states = np.full((blocks, LANES), _LOW)
    out = np.zeros((blocks, steps, LANES), np.uint32)
    put = np.zeros((blocks, steps, LANES), bool)
    marks = np.zeros((blocks, -(-steps // (STEP // LANES)), LANES), np.uint64)
    room = np.uint64(63 - bits)
    for step in range(steps - 1, -1, -1):
        own = lanes[:, step]
        real = own >= 0
        f = freq[own]
        full = (states >= (f << room)) & real
        out[:, step] = states  # the lower 32 bits
        put[:, step] = full
        kept = np.where(full, states >> _WORD, states)
        whole = kept // f
        kept = (whole << np.uint64(bits)) + (kept - whole * f) + base[own]
        states = np.where(real, kept, states)
        if step % (STEP // LANES) == 0:
            marks[:, step // (STEP // LANES)] = states
    used = put.reshape(blocks, steps, LANES).sum(axis=2)
    before = np.concatenate((np.zeros((blocks, 1), np.int64), np.cumsum(used, axis=1)), axis=1)
    return out[put], np.concatenate(([0], np.cumsum(before[:, -1]))), marks, before[:, 0 : steps : STEP // LANES]


def decode_parts(words: np.ndarray, at: np.ndarray, states: np.ndarray, counts: np.ndarray, given: np.ndarray, bits: int):
    """Decodes parts side by side: each from its states and place in ``words``, ``counts`` ids of
    it. Gives places in the table (a row per part), the states and the place reached."""
    parts, steps = len(counts), -(-int(counts.max(initial=0)) // LANES)
    freq, base = given.astype(np.uint64), (np.cumsum(given) - given).astype(np.uint64)
    symbol = np.repeat(np.arange(len(given), dtype=np.uint32), given)
    mask = np.uint64((1 << bits) - 1)
    out = np.zeros((parts, steps, LANES), np.uint32)
    states, at = states.copy(), at.astype(np.int64).copy()
    words = np.append(words, np.uint32(0))
    lane = np.arange(LANES)
    for step in range(steps):
        slot = states & mask
        found = symbol[slot]
        out[:, step] = found
        after = freq[found] * (states >> np.uint64(bits)) + slot - base[found]
        need = after < _LOW
        if step * LANES + LANES > counts.min(initial=0):
            real = step * LANES + lane < counts[:, None]
            need &= real
            after = np.where(real, after, states)
        rank = np.cumsum(need, axis=1)
        place = at[:, None] + rank - 1
        refilled = after << _WORD | words[np.where(need, np.minimum(place, len(words) - 1), 0)]
        states = np.where(need, refilled, after)
        at += rank[:, -1]
    return out.reshape(parts, -1), states, at


def _record(magic: bytes, body: bytes) -> bytes:
    return struct.pack(_HEAD, magic, len(body)) + body + struct.pack("<I", zlib.crc32(body))


class SectionWriter:
    """The records of one file, from documents in order."""

    def __init__(self, file: int):
        self.file, self.blocks, self.size = file, 0, 0
        self.ids: list[np.ndarray] = []
        self.pieces: list[tuple[int | None, int, bool]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        start = 0
        while start < len(ids) or not start:
            part = ids[start : start + SECTION - self.size]
            self.ids.append(part)
            self.pieces.append((doc_id, len(part), start > 0))
            self.size += len(part)
            start += len(part)
            if self.size >= SECTION:
                yield from self.close()
            if not len(ids):
                break

    def close(self) -> Iterator[bytes]:
        if not self.pieces:
            return
        ids = np.concatenate(self.ids)
        bits, symbols, given = frequencies(ids) if len(ids) else (8, np.zeros(1, np.int64), np.array([256]))
        yield _record(TABLE, struct.pack("<II", bits, len(symbols)) + symbols.astype("<u4").tobytes() + given.astype("<u4").tobytes())
        place = np.full(-(-len(ids) // BLOCK) * BLOCK, -1, np.int32)
        numbers = np.zeros(int(symbols[-1]) + 1, np.int32)
        numbers[symbols] = np.arange(len(symbols))
        place[: len(ids)] = numbers[ids]
        if len(place) == BLOCK:  # a lone block need not be filled up
            place = place[: -(-len(ids) // LANES) * LANES]
        table = place.reshape(-(-len(ids) // BLOCK), -1)
        words, borders, marks, before = code_blocks(table, given, bits)
        raw = ids.astype("<u4")
        ends = np.cumsum([n for _, n, _ in self.pieces]).tolist()
        piece, left, again = 0, self.pieces[0][1], self.pieces[0][2]
        for k in range(len(table)):
            start, stop = k * BLOCK, min(len(ids), (k + 1) * BLOCK)
            own = bytearray()
            n = 0
            while piece < len(ends):  # pieces that end here, then the one that goes on
                doc_id = self.pieces[piece][0]
                done = ends[piece] <= stop
                here = left if done else stop - (ends[piece] - left)
                if not done and here == 0:
                    break
                own += struct.pack("<qQB", doc_id or 0, here, (doc_id is None) | again << 1)
                n += 1
                if not done:
                    left, again = left - here, True
                    break
                piece += 1
                if piece < len(ends):
                    left, again = self.pieces[piece][1], self.pieces[piece][2]
            body = [b"", bytes(own)]
            parts = range(start, stop, STEP)
            for c, at in enumerate(parts):
                check = zlib.crc32(raw[at : min(stop, at + STEP)])
                body.append(struct.pack("<II", int(before[k, c]), check) + marks[k, c].astype("<u8").tobytes())
            body[0] = struct.pack(_BLOCK_HEAD, self.file, self.blocks, stop - start, n, len(parts), int(borders[k + 1] - borders[k]))
            yield _record(CODED, b"".join(body) + words[borders[k] : borders[k + 1]].astype("<u4").tobytes())
            self.blocks += 1
        self.ids, self.pieces, self.size = [], [], 0


def _records(content: memoryview) -> Iterator[tuple[bytes, memoryview]]:
    at = 0
    while at < len(content):
        if at + _HEAD_SIZE > len(content):
            raise CorruptFile("a record's head is cut off")
        magic, size = struct.unpack_from(_HEAD, content, at)
        body = content[at + _HEAD_SIZE : at + _HEAD_SIZE + size]
        end = at + _HEAD_SIZE + size
        if magic not in (TABLE, CODED) or len(content) < end + 5:
            raise CorruptFile("a record is cut off or is none")
        if zlib.crc32(body) != struct.unpack_from("<I", content, end)[0] or content[end + 4] != 10:
            raise CorruptFile("a record's checksum is wrong")
        yield magic, body
        at = end + 5


def read_sections(content: bytes) -> Iterator[tuple[int, np.ndarray, list[tuple[int | None, int, bool]]]]:
    """(file, ids, pieces of documents) of every section of a file."""
    table, blocks, number = None, [], 0
    for magic, body in _records(memoryview(content)):
        if magic == TABLE:
            if blocks:
                yield _read_blocks(table, blocks)
            bits, n = struct.unpack_from("<II", body)
            both = np.frombuffer(body, "<u4", 2 * n, 8).astype(np.int64)
            table, blocks = (bits, both[:n], both[n:]), []
        else:
            if table is None or struct.unpack_from(_BLOCK_HEAD, body)[1] != number:
                raise CorruptFile("a block is missing")
            number += 1
            blocks.append(body)
    if blocks:
        yield _read_blocks(table, blocks)


def _read_blocks(table, blocks: list[memoryview]):
    bits, symbols, given = table
    pieces, words, at, states, counts, checks, last, base, file = [], [], [], [], [], [], [], 0, 0
    for body in blocks:
        file, _, n, n_pieces, n_parts, n_words = struct.unpack_from(_BLOCK_HEAD, body)
        pos = _BLOCK_HEAD_SIZE
        for doc_id, here, flags in struct.iter_unpack("<qQB", body[pos : pos + 17 * n_pieces]):
            pieces.append((None if flags & 1 else doc_id, here, bool(flags & 2)))
        pos += 17 * n_pieces
        marks = np.frombuffer(body, np.dtype([("at", "<u4"), ("check", "<u4"), ("states", "<u8", LANES)]), n_parts, pos)
        pos += marks.nbytes
        words.append(np.frombuffer(body, "<u4", n_words, pos))
        at.append(base + marks["at"].astype(np.int64))
        states.append(marks["states"].astype(np.uint64))
        counts.append(np.minimum(STEP, n - STEP * np.arange(n_parts)))
        checks.append(marks["check"])
        last.append(np.arange(n_parts) == n_parts - 1)
        base += n_words
    at, states, counts, checks, last = (np.concatenate(x) for x in (at, states, counts, checks, last))
    words = np.concatenate(words)
    if not len(counts):
        return file, np.zeros(0, np.uint32), pieces
    found, ends, reached = decode_parts(words, at, states, counts, given, bits)
    # A part ends where the next begins, the last of a block in the first states of all.
    want = np.where(last[:, None], _LOW, np.roll(states, -1, axis=0))
    if (ends != want).any() or (reached != np.append(at[1:], len(words))).any():
        raise CorruptFile("a checkpoint is not reached")
    ids = symbols.astype("<u4")[found]
    for k, check in enumerate(checks.tolist()):
        if zlib.crc32(ids[k, : counts[k]]) != check:
            raise CorruptFile("a checksum of ids is wrong")
    return file, ids[np.arange(ids.shape[1]) < counts[:, None]], pieces


def write(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = WORD_BPE, end_id: int = END_ID
) -> None:
    """Encodes the texts and writes their ids below ``path``, in ascending order of id."""
    require_columns(docs, id_col, text_col)
    rows = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text"))
    # Ties by text; the number of the row only spreads equal rows.
    order = ["id", "tie", "row"]
    rows = rows.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.here(tokenizer)
        writer = SectionWriter(TaskContext.get().partitionId())
        for rows in slices(batches, 1, _SLICE):
            ids, bounds = encoder.texts(rows.column(1), end_id)
            for k, doc_id in enumerate(rows.column(0).to_pylist()):
                for record in writer.add(doc_id, ids[bounds[k] : bounds[k + 1]]):
                    yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])
        for record in writer.close():
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])

    rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\n"
    ).text(path)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document below ``path``, and its ids; start
    counts the ids of all documents before it, the checksum is that of the ids as unsigned
    32-bit integers."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                heads = [struct.unpack_from(_BLOCK_HEAD, b) for magic, b in _records(memoryview(content.as_buffer())) if magic == CODED]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([heads[0][0]], pa.int32()), pa.array([sum(h[2] for h in heads)], pa.int64())], names=["file", "n"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, at = [], 0  # one row per document; the last may go on in the next section
                for file, ids, pieces in read_sections(content.as_buffer()):
                    start = 0
                    for doc_id, n, again in pieces:
                        own = ids[start : start + n]
                        start += n
                        if again:
                            held[-1][2] += n
                            held[-1][3] = zlib.crc32(own, held[-1][3])
                            if with_ids:
                                held[-1][4].append(own)
                        else:
                            held.append([doc_id, at, n, zlib.crc32(own), [own] if with_ids else None])
                        at += n
                    yield from emit(file, held[:-1])
                    held = held[-1:]
                yield from emit(file, held)

    def emit(file: int, rows: list) -> Iterator[pa.RecordBatch]:
        if rows:
            doc_ids, starts, counts, checks, ids = zip(*rows, strict=True)
            columns = [pa.array([file] * len(rows), pa.int32()), *(pa.array(c, pa.int64()) for c in (doc_ids, starts, counts, checks))]
            if with_ids:
                flat = np.concatenate([x for own in ids for x in own]).astype(np.int32)
                ends = np.concatenate(([0], np.cumsum(counts)))
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["file", "doc_id", "at", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "file int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    # One row per file.
    before = files.mapInArrow(totals, "file int, n bigint").select(
        "file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before")
    )
    return files.mapInArrow(run, schema).join(F.broadcast(before), "file").select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), *names[3:]
    )
