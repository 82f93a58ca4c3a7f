"""Lexicons of any size as tables: literal terms found by one automaton, in one pass per text.

The meaning is that of ``measures.lexicon_hits``: the occurrences of a category's terms, compared
in lower case, anywhere in the text, from left to right without overlap, and at one place the
longest. So a term is found within a word, in text that has no spaces between words, and with
exactly its own spaces.

The terms are broadcast, at most ``max_terms``, and every task builds its automaton once. As a column
(:func:`counter`) a larger lexicon is dealt by hash to as many automata as it needs, side by side.
:func:`attach_lexicon_hits` stores the rows in blocks of a limited length and gives each block only the
terms that can occur in it, so that its work grows with the texts and the terms, not with their product.
Rows need no ids: null and repeated ids count for themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosift.operators.rules import Rule
from foliosift.session import materialise

#: Terms of one automaton, some 100 bytes each in a Python worker.
MAX_TERMS = 500_000

#: Bytes of one block of stored texts, and of what is looked up at a time.
BLOCK, RUN = 16_000_000, 1_000_000

#: Lengths in bytes of the beginnings by which terms are looked up: a term has the largest that it fills.
HEADS = (*range(1, 17), 24, 32, 48, 64, 96, 128, 256, 512)

#: Most bits that tell which beginnings there are.
MOST_HEAD_BITS = 27


def _named(lexicon: DataFrame) -> DataFrame:
    """Terms in lower case, with a category each."""
    named = lexicon.select("category", F.lower("term").alias("term"))
    return named.where(F.col("category").isNotNull() & (F.col("term") != ""))


def _terms(lexicon: DataFrame) -> DataFrame:
    """Distinct terms in lower case, each with its categories."""
    return _named(lexicon).groupBy("term").agg(F.sort_array(F.collect_set("category")).alias("categories"))


def _automaton(rows: list[tuple]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term, categories in rows:
        automaton.add_word(term, (len(term), tuple(categories)))
    automaton.make_automaton()
    return automaton


def _spans(automaton, text: str | None) -> dict[str, dict[int, int]]:
    """Per category, the start of every occurrence and the end of the longest there. The automaton
    gives occurrences by rising ends, so the longest is the last of a start."""
    spans: dict[str, dict[int, int]] = {}
    for last, (length, categories) in automaton.iter(text) if text and len(automaton) else ():
        for name in categories:
            spans.setdefault(name, {})[last + 1 - length] = last + 1
    return spans


def _settled(spans: dict[str, dict[int, int]]) -> tuple[list[str], list[int]]:
    """Occurrences per category that do not overlap: the leftmost, and of those the longest."""
    order = sorted((start := min(ends), -ends[start], name) for name, ends in spans.items())
    hits = []
    for _, _, name in order:
        n, reached, ends = 0, 0, spans[name]
        for start in sorted(ends):
            if start >= reached:
                n, reached = n + 1, ends[start]
        hits.append(n)
    return [name for _, _, name in order], hits


def _own(terms: DataFrame, shard: int, shards: int):
    """The terms of one shard, to every task."""
    own = terms.where(F.pmod(F.xxhash64("term"), F.lit(shards)) == shard)
    return terms.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()])


_HITS = T.StructType([T.StructField("categories", T.ArrayType(T.StringType())), T.StructField("hits", T.ArrayType(T.LongType()))])


def _counter(terms: DataFrame) -> Callable[[Column], Column]:
    """A column function that counts the terms in a lower-case text; no occurrence leaves the task."""
    shared = _own(terms, 0, 1)

    @F.pandas_udf(_HITS)
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared.value)
        for batch in texts:
            yield pd.DataFrame([_settled(_spans(automaton, text)) for text in batch], columns=["categories", "hits"])

    return count


def _finder(terms: DataFrame, shard: int, shards: int) -> Callable[[Column], Column]:
    """A column function that finds the terms of one shard in a lower-case text, as categories,
    starts and ends."""
    shared = _own(terms, shard, shards)

    @F.pandas_udf("struct<categories:array<string>,starts:array<int>,ends:array<int>>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared.value)
        for batch in texts:
            found = []
            for text in batch:
                met = [(name, *span) for name, ends in _spans(automaton, text).items() for span in ends.items()]
                found.append(tuple(map(list, zip(*met, strict=True))) if met else ([], [], []))
            yield pd.DataFrame(found, columns=["categories", "starts", "ends"])

    return find


@F.pandas_udf(_HITS)
def _settle(categories: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for row in zip(categories, starts, ends, strict=True):
        spans: dict[str, dict[int, int]] = {}
        for name, start, end in zip(*row, strict=True) if len(row[0]) else ():
            own = spans.setdefault(name, {})
            own[start] = max(end, own.get(start, 0))
        out.append(_settled(spans))
    return pd.DataFrame(out, columns=["categories", "hits"])


def _hits(found: list[Column]) -> Column:
    parts = [F.concat(*[f[k] for f in found]) for k in ("categories", "starts", "ends")]
    return _as_map(_settle(*parts))


def _as_map(settled: Column) -> Column:
    return F.map_from_arrays(settled["categories"], settled["hits"])


def _shards(terms: DataFrame, max_terms: int) -> int:
    # Shards differ a little in size, so they are meant to be a tenth smaller than allowed.
    n = terms.count()
    return 1 if n <= max_terms else -(-n * 10 // (max_terms * 9))


def counter(lexicon: DataFrame, max_terms: int = MAX_TERMS) -> Callable[[Column], Column]:
    """A function from a text column to the map of categories to hits (null for null; empty
    without any), for ``lexicon`` (category, term)."""
    terms = _terms(lexicon)
    shards = _shards(terms, max_terms)
    if shards == 1:
        count = _counter(terms)
        return lambda text: F.when(text.isNotNull(), _as_map(count(F.lower(text))))
    finders = [_finder(terms, k, shards) for k in range(shards)]

    def hits(text: Column) -> Column:
        lower = F.lower(text)
        return F.when(text.isNotNull(), _hits([find(lower) for find in finders]))

    return hits


def lexicon_rule(name: str, lexicon: DataFrame, max_hits: int = 3, max_terms: int = MAX_TERMS) -> Rule:
    """``rules.lexicon`` for a table: rejects from ``max_hits`` occurrences on of the terms of
    category ``name``. It reads the text as it is at that step of a cascade."""
    hits = counter(lexicon.where(F.col("category") == name), max_terms)
    return Rule(name, lambda c: F.coalesce(hits(c)[name], F.lit(0)) >= max_hits)


def _bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts one after the other, and where each begins and the last ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    own = texts.cast(pa.binary())
    own = own.fill_null(b"") if own.null_count else own
    _, offsets, data = own.buffers()
    begins = np.frombuffer(offsets, np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def _within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of each stretch, one stretch after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _runs(lengths: np.ndarray) -> Iterator[slice]:
    """Slices of some RUN bytes."""
    parts = np.cumsum(lengths) // RUN
    ends = np.append(np.flatnonzero(np.diff(parts)) + 1, len(lengths)).tolist()
    return (slice(a, b) for a, b in zip([0, *ends], ends) if a < b)


def _pairs(data: np.ndarray) -> np.ndarray:
    """Each two neighbours as one number."""
    return data[:-1].astype(np.uint16) << 8 | data[1:]


def _extended(numbers: np.ndarray, data: np.ndarray, places: np.ndarray, start: int, stop: int) -> np.ndarray:
    """The numbers of the windows at ``places``, from ``start`` bytes on to ``stop``."""
    for k in range(start, stop):
        numbers = numbers * np.uint64(0x9E3779B97F4A7C15) + data[places + k] + np.uint64(1)
    return numbers


def _numbers(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    return _extended(np.zeros(len(places), np.uint64), data, places, 0, length)


def _heads(numbers: np.ndarray) -> np.ndarray:
    """Windows' numbers as 32 bits. Beginnings that share them only bring a block a term that it doesn't hold."""
    numbers = (numbers ^ (numbers >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((numbers ^ (numbers >> np.uint64(29))) >> np.uint64(32)).astype(np.uint32)


def _filled(lengths: np.ndarray) -> np.ndarray:
    """The length of the beginning by which a term of each length is looked up."""
    return np.array(HEADS)[np.searchsorted(HEADS, lengths, "right") - 1]


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the number of their beginning and their length."""
    for batch in batches:
        data, begins = _bytes(batch.column("term"))
        lengths, heads = np.diff(begins), np.zeros(len(batch), np.uint32)
        filled = _filled(lengths)
        for length in np.unique(filled).tolist():
            own = np.flatnonzero(filled == length)
            heads[own] = _heads(_numbers(data, begins[own], length))
        columns = [*batch.columns, pa.array(heads.view(np.int32)), pa.array(lengths, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["category", "term", "head", "length"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that terms hold, once per task; and behind them, from 65,536 on, their first bytes."""
    held = np.zeros((1 << 16) + 256, bool)
    for batch in batches:
        data, begins = _bytes(batch.column("term"))
        held[_pairs(data)[_within(begins[:-1], np.diff(begins) - 1)]] = True
        held[(1 << 16) + data[begins[:-1]].astype(np.int64)] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(held), pa.int32())], ["slot"])


def _bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """The slots of rows (slot) as 2**bits bits."""
    slot = F.col("slot").cast("bigint") + 1
    rows = slots.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    found = np.zeros(1 << bits >> 3, np.uint8)
    for bucket, part in rows.collect():
        found[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part, np.uint8)
    return found


class _Wanted(NamedTuple):
    """What is known of all terms together: the pairs of neighbours that they hold, their first bytes, their beginnings
    as 2**bits bits, and the lengths of the beginnings."""

    pairs: np.ndarray
    firsts: np.ndarray
    heads: np.ndarray
    bits: int
    lengths: list[int]

    def has(self, heads: np.ndarray) -> np.ndarray:
        slots = heads >> np.uint32(32 - self.bits)
        return (self.heads[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


class _Pieces:
    """Texts cut between two neighbours that no term holds, so that no term lies across a cut. ``of`` and ``places`` are
    of every piece in its order, as which distinct piece it is and its place; a text has those from its one of ``begins``
    on to the next. The distinct pieces are ``data``, each from its one of ``starts`` on, of its one of ``lengths``."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, wanted: _Wanted):
        data, begins = _bytes(texts)
        cuts = np.ones(max(0, len(data) - 1), bool)
        for k in range(0, len(cuts), RUN):
            cuts[k : k + RUN] = ~wanted.pairs[_pairs(data[k : k + RUN + 1])]
        cuts[begins[(begins > 0) & (begins < len(data))] - 1] = True
        ends = np.append(np.flatnonzero(cuts) + 1, len(data)) if len(data) else np.zeros(0, np.int64)
        offsets = np.append(0, ends).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        self.of, self.places = pieces.indices.to_numpy(zero_copy_only=False), offsets[:-1]
        self.begins = np.searchsorted(self.places, begins)
        self.data, starts = _bytes(pieces.dictionary)
        self.starts, self.lengths = starts[:-1], np.diff(starts)

    def windows(self, wanted: _Wanted, run: slice) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For the lengths of beginnings, all windows so long in some distinct pieces that begin as a term does: the
        length, their numbers, their places, the bytes left in the piece and the distinct piece."""
        starts, size = self.starts[run], self.lengths[run]
        places = np.flatnonzero(wanted.firsts[self.data[starts[0] : starts[-1] + size[-1]]]) + starts[0]
        piece = np.searchsorted(starts, places, "right") - 1
        left, piece = starts[piece] + size[piece] - places, piece + run.start
        numbers, reached = np.zeros(len(places), np.uint64), 0
        for length in wanted.lengths:
            inside = left >= length
            numbers, places, left, piece = (x[inside] for x in (numbers, places, left, piece))
            numbers, reached = _extended(numbers, self.data, places, reached, length), length
            yield length, numbers, places, left, piece


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, at_b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``a`` and ``b`` have the same bytes at each two of the places."""
    same = np.ones(len(at), bool)
    for k in range(length):
        same &= a[at + k] == b[at_b + k]
    return same


def _in_blocks(shared, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the number of their block, and with one row of a block the beginnings of terms that its texts may hold."""

    def block(number: int, rows: list[pa.RecordBatch], texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        wanted, near = _Wanted(*shared.value), [np.zeros(0, np.uint32)]
        pieces = _Pieces(pa.chunked_array(texts), wanted)
        for run in _runs(pieces.lengths):
            for _, numbers, *_ in pieces.windows(wanted, run):
                heads = _heads(numbers)
                near.append(pd.unique(heads[wanted.has(heads)]))
        heads = pd.unique(np.concatenate(near)).view(np.int32)
        for part in rows:
            found = pa.ListArray.from_arrays(pa.array([0, *[len(heads)] * len(part)], pa.int32()), pa.array(heads, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([number] * len(part), pa.int64()), found], [*columns, "_block", "_starts"]
            )
            heads = heads[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            at, lower, kept = 0, batch.column(len(columns)), batch.select(range(len(columns)))
            for k, n in enumerate(np.diff(_bytes(lower)[1]).tolist(), 1):
                size += n
                if size >= BLOCK or k == len(lower):
                    rows.append(kept.slice(at, k - at))
                    texts.append(lower.slice(at, k - at))
                    at = k
                if size >= BLOCK:
                    yield from block(number, rows, texts)
                    number, rows, texts, size = number + 1, [], [], 0
        if rows:
            yield from block(number, rows, texts)

    return run


def _matches(pieces: _Pieces, wanted: _Wanted, terms: pa.ChunkedArray, category: np.ndarray) -> Iterator[np.ndarray]:
    """All occurrences of the terms in some distinct pieces after the other: rows of piece, category, start and end."""
    data, begins = _bytes(terms)
    starts, lengths = begins[:-1], np.diff(begins)
    filled, tables, branches = _filled(lengths), {}, {}
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        numbers = _numbers(data, starts[own], length)
        order = np.argsort(numbers, kind="stable")
        distinct, first, times = np.unique(numbers[order], return_index=True, return_counts=True)
        tables[length] = own[order], pd.Index(distinct), first, times
    for length in np.unique(filled).tolist():
        own = np.flatnonzero(filled == length)
        longer = own[lengths[own] > length]
        branches[length] = pd.Index(np.unique(_numbers(data, starts[longer], length))), np.unique(lengths[own]).tolist()
    for run in _runs(pieces.lengths):
        found = [np.zeros((4, 0), np.int64)]
        for head, numbers, places, left, piece in pieces.windows(wanted, run):
            begun, branch = branches.get(head, (None, []))
            reached = head
            for length in branch:
                if length > reached:
                    inside = left >= length
                    if reached == head:
                        inside &= begun.get_indexer(numbers) >= 0
                    numbers, places, left, piece = (x[inside] for x in (numbers, places, left, piece))
                    numbers, reached = _extended(numbers, pieces.data, places, reached, length), length
                own, distinct, first, times = tables[length]
                at = distinct.get_indexer(numbers)
                window = np.flatnonzero(at >= 0)
                at = at[window]
                term = own[_within(first[at], times[at])]
                window = np.repeat(window, times[at])
                right = _equal(pieces.data, places[window], data, starts[term], length)
                window, term = window[right], term[right]
                found.append(np.array([piece[window], category[term], places[window], places[window] + length]))
        yield np.concatenate(found, 1)


def _settled_in_pieces(found: np.ndarray) -> np.ndarray:
    """Per piece and category, by rising pieces, the hits as of :func:`_settled` and the first place: its start and the end
    of the longest there."""
    piece, category, start, end = found
    order = np.lexsort((end, start, category, piece))
    piece, category, start, end = (x[order] for x in (piece, category, start, end))
    group = np.cumsum((np.diff(piece, prepend=-1) != 0) | (np.diff(category, prepend=-1) != 0))
    longest = (np.diff(group, append=-1) != 0) | (np.diff(start, append=-1) != 0)
    piece, category, start, end, group = (x[longest] for x in (piece, category, start, end, group))
    kept = np.ones(len(group), np.int64)
    over = (np.diff(group) == 0) & (start[1:] < end[:-1])
    if over.any():
        some = np.zeros(group[-1] + 1, bool)
        some[group[1:][over]] = True
        rows, last, reached = np.flatnonzero(some[group]), -1, 0
        for k, own, a, b in zip(rows.tolist(), group[rows].tolist(), start[rows].tolist(), end[rows].tolist(), strict=True):
            if own != last or a >= reached:
                last, reached = own, b
            else:
                kept[k] = 0
    begins = np.flatnonzero(np.diff(group, prepend=-1))
    hits = np.add.reduceat(kept, begins) if len(begins) else kept
    return np.array([piece[begins], category[begins], hits, start[begins], end[begins]])


def _hits_of_texts(pieces: _Pieces, met: np.ndarray, names: list[str]) -> list[list[tuple[str, int]]]:
    """The hits of each text, its categories in the order of :func:`_settled`."""
    of, category, hits, start, end = met
    begins = np.searchsorted(of, np.arange(len(pieces.starts) + 1))
    start, end = start - pieces.starts[of], end - pieces.starts[of]
    out: list[list[tuple[str, int]]] = [[] for _ in pieces.begins[1:]]
    many = np.diff(pieces.begins)
    for run in _runs(many):
        own = slice(pieces.begins[run.start], pieces.begins[run.stop])
        at = pieces.of[own]
        times = begins[at + 1] - begins[at]
        row, place = _within(begins[at], times), np.repeat(pieces.places[own], times)
        text = np.repeat(np.repeat(np.arange(run.start, run.stop), many[run]), times)
        codes, _ = pd.factorize(text * len(names) + category[row])
        first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
        total = np.bincount(codes, weights=hits[row], minlength=len(first)).astype(np.int64).tolist()
        text, row, place = text[first], row[first], place[first]
        for k in np.lexsort((category[row], -(place + end[row]), place + start[row], text)).tolist():
            out[text[k]].append((names[category[row[k]]], total[k]))
    return out


def _in_block(shared, columns: list[str], name: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The rows of a block with their hits, from the terms that its texts may hold."""

    def run(rows: pa.Table, terms: pa.Table) -> pa.Table:
        wanted, texts = _Wanted(*shared.value), rows.column("_lower")
        pieces = _Pieces(texts, wanted)
        of, names = pd.factorize(np.array(terms.column("category").to_pylist(), object), sort=True)
        met = [_settled_in_pieces(x) for x in _matches(pieces, wanted, terms.column("term"), of.astype(np.int64))]
        hits = _hits_of_texts(pieces, np.concatenate([np.zeros((5, 0), np.int64), *met], 1), names.tolist())
        hits = [own if there else None for own, there in zip(hits, texts.is_valid().to_pylist(), strict=True)]
        return rows.select(columns).append_column(name, pa.array(hits, pa.map_(pa.string(), pa.int64())))

    return run


def _attach_by_blocks(df: DataFrame, lexicon: DataFrame, n: int, text_col: str, name: str) -> DataFrame:
    spark, columns = df.sparkSession, df.columns
    found = _named(lexicon).distinct().mapInArrow(_looked_up, "category string, term string, head int, length int")
    terms = materialise(found, "lexicon")
    bits = min(max((16 * n).bit_length(), 15), MOST_HEAD_BITS)
    heads = _bitmap(terms.select(F.shiftrightunsigned("head", 32 - bits).alias("slot")), bits)
    held = np.zeros((1 << 16) + 256, bool)
    held[[r[0] for r in terms.select("term").mapInArrow(_neighbours, "slot int").distinct().collect()]] = True
    lengths = np.array([r[0] for r in terms.select("length").distinct().collect()])
    wanted = _Wanted(held[: 1 << 16], held[1 << 16 :], heads, bits, np.unique(_filled(lengths)).tolist())
    # As a tuple: a broadcast names its classes by their module, which executors need not have.
    shared = spark.sparkContext.broadcast(tuple(wanted))

    kept = [T.StructField(f.name, f.dataType) for f in df.schema]
    blocks = T.StructType([*kept, T.StructField("_block", T.LongType()), T.StructField("_starts", T.ArrayType(T.IntegerType()))])
    dealt = df.select("*", F.lower(text_col).alias("_lower")).mapInArrow(_in_blocks(shared, columns), blocks)
    stored = materialise(dealt, "lexicon")
    near = stored.select(F.col("_block").alias("_of"), F.explode("_starts").alias("head"))
    met = near.join(terms.select("head", "term", "category"), "head").select("_of", "term", "category")
    rows = stored.select(*columns, "_block").repartition("_block").withColumn("_lower", F.lower(text_col))
    out = T.StructType([*kept, T.StructField(name, T.MapType(T.StringType(), T.LongType()))])
    return rows.groupBy("_block").cogroup(met.groupBy("_of")).applyInArrow(_in_block(shared, columns, name), out)


def attach_lexicon_hits(
    df: DataFrame, lexicon: DataFrame, text_col: str = "text", max_terms: int = MAX_TERMS, name: str = "lexicon_hits"
) -> DataFrame:
    """``df`` with the map column ``name`` (category to hits; null for a null text)."""
    terms = _terms(lexicon)
    n, text = terms.count(), F.col(text_col)
    if n <= max_terms:
        return df.withColumn(name, F.when(text.isNotNull(), _as_map(_counter(terms)(F.lower(text)))))
    return _attach_by_blocks(df, lexicon, n, text_col, name)
