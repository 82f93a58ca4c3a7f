"""JSON array files of any size, read in parts by many tasks.

A file is cut at closing braces, the line ends of Spark's text reader here, so its byte ranges
are read in parallel. What a brace means depends on all text before it, but little of that: a
piece changes whether a string is open and how deep the nesting is. For each split (the pieces
of one byte range) one pass sums that up, for both cases of an open string; a running sum over
one row per split then gives the state in which each split begins. With that, a second pass
finds the braces that close an entry of the array and puts the entry together. An entry that
crosses splits is left as fragments, one or two per split, which meet in a grouping by the split
where the entry begins. Only those fragments are shuffled.

A part handed on is the text of a small array: what stands between two entries that are
objects, and the second of them. An entry is bound by the size of a string, 2 GB.

One array may also lie in several files, as Spark writes it by many tasks: in the order of their
names the first opens the array, the last closes it, and none ends within an entry. Then a file
after the first begins at depth 1, and what stands at the end of one goes on in the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SLOTS = 33


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, how often its quotes open or close a string, and the
    change of depth up to and with the brace, for a closed and an open string before it."""
    raw = spark.read.text(path, lineSep="}").select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    bare = raw.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    quotes = F.length("bare") - F.length(F.replace("bare", F.lit('"'), F.lit("")))

    def change(is_open: int) -> Column:
        text = F.concat(F.lit('"' * is_open), "bare")
        plain = F.regexp_replace(text, '"[^"]*+(?:"|$)', "")
        up = F.length(F.regexp_replace(plain, r"[^\[{]+", ""))
        down = F.length(F.regexp_replace(plain, r"[^\]]+", ""))
        return (up - down - F.when((F.col("quotes") + is_open) % 2 == 0, 1).otherwise(0)).cast("int")

    counted = bare.withColumn("quotes", quotes)
    return counted.select("value", "file", "start", "quotes", change(0).alias("closed"), change(1).alias("open"))


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, for a closed and an open string before it: the depth reached, and the depths
    at which a brace closes something."""
    now, flips, depth, met = None, 0, [0, 0], [set(), set()]

    def row() -> pa.RecordBatch:
        columns = [[now[0]], [now[1]], [flips], [depth[0]], [depth[1]], [sorted(met[0])], [sorted(met[1])]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["file", "start", "flips", "depth0", "depth1", "met0", "met1"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        file, start, quotes, closed, opened = (c.to_numpy().astype(np.int64) for c in batch.columns)
        starts = _runs(file, start)
        for a, b in zip(starts, [*starts[1:], len(file)], strict=True):
            key = (int(file[a]), int(start[a]))
            if key != now:
                if now is not None:
                    yield row()
                now, flips, depth, met = key, 0, [0, 0], [set(), set()]
            after = (flips + np.cumsum(quotes[a:b])) & 1
            before = np.concatenate(([flips], after[:-1]))
            for case in (0, 1):
                is_open = before ^ case
                reached = depth[case] + np.cumsum(np.where(is_open == 1, opened[a:b], closed[a:b]))
                met[case].update(np.unique(reached[(after ^ case) == 0]).tolist())
                depth[case] = int(reached[-1])
            flips = int(after[-1])
    if now is not None:
        yield row()


def _file_order(spark: SparkSession, path: str) -> DataFrame:
    """``file, place``: the files below ``path`` in the order of their names; no content is read."""
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_path")
    return files.select(F.xxhash64("file_path").alias("file"), F.row_number().over(Window.orderBy("file_path")).alias("place"))


def _states(pieces: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per split: its number, the state before it, and the split in which the entry
    began that is open there. Fails for a file, or ``files`` together, that are no array as a whole."""
    sums = pieces.select("file", "start", "quotes", "closed", "open").mapInArrow(
        _sum_up,
        "file bigint, start bigint, flips int, depth0 bigint, depth1 bigint, met0 array<bigint>, met1 array<bigint>",
    )
    if files is None:
        sums = sums.withColumns({"array": F.col("file"), "place": F.lit(0)})
    else:
        sums = sums.join(F.broadcast(files), "file").withColumn("array", F.lit(0))
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    array = Window.partitionBy("array").orderBy("place", "start")
    array_before = array.rowsBetween(Window.unboundedPreceding, -1)
    begins_at = F.when(F.col("place") == F.min("place").over(Window.partitionBy("array")), 0).otherwise(1)
    opened = sums.withColumn("is_open", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    opened = opened.withColumns(
        {
            "change": F.when(F.col("is_open") == 0, F.col("depth0")).otherwise(F.col("depth1")),
            "met": F.when(F.col("is_open") == 0, F.col("met0")).otherwise(F.col("met1")),
            "file_last": F.lead("start").over(order).isNull(),
            "last": F.lead("start").over(array).isNull(),
            "begins_at": begins_at,
        }
    ).withColumn("depth", F.col("begins_at") + F.coalesce(F.sum("change").over(before), F.lit(0)))
    # The brace that the reader took for the end of the last piece is not in the file, unless a
    # file that others follow ends with that of an entry.
    ended = F.col("depth") + F.col("change")
    wrong_end = F.when(F.col("last"), ended != -1).otherwise(~ended.isin(0, 1))
    broken = F.col("file_last") & (wrong_end | ((F.col("is_open") + F.col("flips")) % 2 != 0))
    whole = F.when(broken, F.raise_error(F.lit("Invalid JSON: expected one array")).cast("bigint")).otherwise(F.col("depth"))
    closes = F.array_contains("met", 1 - F.col("depth"))
    number = F.row_number().over(Window.orderBy("array", "place", "start")).cast("bigint") - 1  # one row per split
    numbered = opened.select(
        "file", "start", "array", "place", "is_open", whole.alias("depth"), closes.alias("closes"), "file_last", "last", number.alias("split")
    )
    begins = F.max(F.when(F.col("closes"), F.col("split"))).over(array_before)
    first = F.min("split").over(Window.partitionBy("array"))
    return numbered.withColumns({"begin": F.coalesce(begins, first), "first": F.col("split") == first, "begins_file": begins.isNull()})


_PART = "begin bigint, split bigint, entry boolean, opens boolean, ends boolean, text string"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole entries (``entry``) and fragments of those that cross splits."""
    now, held, depth, is_open, seen, facts = None, [], 0, 0, False, None
    rows: list[tuple] = []

    def close(split_ended: bool) -> None:
        begin, first, begins_file, file_last, last = facts
        text = "".join(held)
        held.clear()
        if split_ended and file_last:
            text = text[:-1]
        if not text:
            return
        whole_start = seen or first  # nothing of it stands in an earlier split
        opens = (first and not seen) if whole_start else begins_file
        rows.append((now if whole_start else begin, now, whole_start and not split_ended, opens, split_ended and last, text))

    def out() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        columns = zip(*rows, strict=True)
        names = ["begin", "split", "entry", "opens", "ends", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        split, quotes, closed, opened, entry_open, entry_depth, begin = (batch.column(k).to_numpy().astype(np.int64) for k in range(7))
        first, begins_file, file_last, last = (batch.column(k).to_pylist() for k in (7, 8, 9, 10))
        values = batch.column(11).to_pylist()
        starts = _runs(split)
        for a, b in zip(starts, [*starts[1:], len(split)], strict=True):
            if int(split[a]) != now:
                if now is not None:
                    close(True)
                now, depth, is_open, seen = int(split[a]), int(entry_depth[a]), int(entry_open[a]), False
                facts = (int(begin[a]), first[a], begins_file[a], file_last[a], last[a])
            after = (is_open + np.cumsum(quotes[a:b])) & 1
            before = np.concatenate(([is_open], after[:-1]))
            reached = depth + np.cumsum(np.where(before == 1, opened[a:b], closed[a:b]))
            done = (reached == 1) & (after == 0)
            at = a
            for k in (np.flatnonzero(done) + a).tolist():
                held.extend(v + "}" for v in values[at : k + 1])
                at = k + 1
                close(False)
                seen = True
            held.extend(v + "}" for v in values[at:b])
            depth, is_open = int(reached[-1]), int(after[-1])
        if rows:
            yield out()
            rows.clear()
    if now is not None:
        close(True)
    if rows:
        yield out()


def _as_array(text: Column, opens: Column, ends: Column) -> Column:
    """A part as the text of an array: without the comma before it, with the missing brackets."""
    wrong = F.raise_error(F.lit("Invalid JSON: expected one array")).cast("string")
    rest = F.regexp_extract(text, r"(?s)^\s*,(.*)$", 1)
    closing = text.rlike(r"^\s*\]\s*$")
    return (
        F.when(opens & ends, text)
        .when(opens, F.concat(text, F.lit("]")))
        .when(ends & closing, F.lit("[]"))
        .when((F.trim(rest) == "") | (ends & rest.rlike(r"^\s*\]\s*$")), wrong)
        .when(ends, F.concat(F.lit("["), rest))
        .otherwise(F.concat(F.lit("["), rest, F.lit("]")))
    )


def array_parts(spark: SparkSession, path: str, joined: bool = False) -> tuple[DataFrame, DataFrame]:
    """The array files below ``path``, or the one array that they are together (``joined``), as
    small arrays in ``value``: those of entries within a split, in the order of the file within
    each partition, and those of entries across splits. ``part`` numbers the splits in file
    order; an entry across splits has that where it begins."""
    pieces = _pieces(spark, path)
    states = _states(pieces, _file_order(spark, path) if joined else None)
    met = pieces.join(F.broadcast(states), ["file", "start"]).select(
        "split", "quotes", "closed", "open", "is_open", "depth", "begin", "first", "begins_file", "file_last", "last", "value"
    )
    parts = met.mapInArrow(_assemble, _PART)
    whole = parts.where("entry").select(F.col("split").alias("part"), _as_array(F.col("text"), F.col("opens"), F.col("ends")).alias("value"))
    pieces_of = F.array_sort(F.collect_list(F.struct("split", "text")))
    crossing = (
        parts.where("NOT entry")
        .groupBy("begin")
        .agg(F.array_join(pieces_of["text"], "").alias("text"), F.max("opens").alias("opens"), F.max("ends").alias("ends"))
    )
    across = crossing.select(F.col("begin").alias("part"), _as_array(F.col("text"), F.col("opens"), F.col("ends")).alias("value"))
    return whole, across


def rising(part: Column, crossing: bool) -> Column:
    """A number per row of a part that rises in file order; 0, 1, … in the first split."""
    slot = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _SLOTS) - 1))
    return F.shiftleft(part, _SLOTS) + (F.lit(1 << (_SLOTS - 1)) if crossing else slot)
