"""Positions in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosift.session import materialise

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    within: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Number the rows 1, 2, … in ``order``, restarting for every ``within`` group.

    Rows are range-partitioned and sorted on all keys, so a group of any size spreads
    over many tasks. The sorted rows are fixed on shared storage together with their
    (partition, slot) address; row numbers are then the slot plus the number of rows in earlier
    partitions. With groups, a row's number in its group's run is counted as the sorted rows are
    written, and only the run that a partition begins with can go on from earlier ones: its offset
    comes, as for the whole, from one small row per partition. So rows are moved once.
    Rows with equal keys are ordered by a hash of the whole row, so that a key shared by many
    rows spreads as well and numbers do not depend on the partitioning.
    """
    keys = [F.col(g) for g in within] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed, position = _numbered(df, [*keys, row_hash(df)], within)
    return placed.select(*[_quoted(c) for c in df.columns], position.alias(name))


def _numbered(df: DataFrame, keys: Sequence[Column], within: Sequence[str]) -> tuple[DataFrame, Column]:
    """The stored rows beside what their position is made of."""
    address = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if within:
        ordered = ordered.withColumn("_rank", _run_rank(F.xxhash64(*within)))
    placed = _with_address(materialise(ordered.withColumn("_address", address)))
    if not within:
        # One row per partition of the sorted data: bounded by the partition count.
        return placed.join(F.broadcast(_offsets(placed)), F.col("_part") == F.col("_p")), _position()
    groups = [F.col(g).alias(f"g{i}") for i, g in enumerate(within)]
    in_first = F.col("_slot") == F.col("_rank")
    ends = placed.groupBy("_part").agg(
        F.min_by(F.struct(*groups), "_slot").alias("first"),
        F.max_by(F.struct(*groups), "_slot").alias("last"),
        (F.max_by("_rank", "_slot") + 1).alias("n"),
    )
    # The rows of a group in all partitions that end with it, before each that begins with it.
    asked = ends.select(F.col("first.*"), F.col("_part").alias("_p"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("n"))
    given = ends.select(F.col("last.*"), F.col("_part").alias("_p"), F.lit(1).alias("kind"), "n")
    earlier = (
        Window.partitionBy(*[f"g{i}" for i in range(len(within))]).orderBy("_p", "kind").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    offsets = asked.unionByName(given).select("_p", "kind", before).where("kind = 0").drop("kind")
    position = F.col("_rank") + 1 + F.when(in_first, F.col("_before")).otherwise(0)
    return placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p")), position.cast("bigint")


def _with_address(placed: DataFrame) -> DataFrame:
    return placed.withColumns(
        {
            "_part": F.shiftright("_address", _SLOT_BITS),
            "_slot": F.col("_address").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)),
        }
    )


def _offsets(placed: DataFrame, *more: Column) -> DataFrame:
    """One row per partition: its number, and what to add to its slots."""
    blocks = placed.groupBy("_part").agg(F.min("_slot").alias("_start"), F.count(F.lit(1)).alias("_rows"), *more)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start")
    names = [c for c in blocks.columns if c not in ("_part", "_start")]
    return blocks.select(F.col("_part").alias("_p"), shift.alias("_shift"), "_start", *names)


def _position() -> Column:
    return (F.col("_slot") + F.col("_shift") + 1).cast("bigint")


@F.pandas_udf(T.LongType())
def _run_rank(groups: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The row's place, from 0, in the run of equal values that it stands in. Rows come in the
    order of their partition; only this number's hash of the group travels."""
    last, length = None, 0
    for batch in groups:
        values = batch.to_numpy()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        if len(values) and values[0] == last:
            new[0] = False
        place = np.arange(len(values))
        start = np.maximum.accumulate(np.where(new, place, -length))
        if len(values):
            last, length = values[-1], int(place[-1] - start[-1] + 1)
        yield pd.Series(place - start)


class OrderIndex:
    """The rows of ``df`` in an order, stored once, for any number of pages.

    Besides the sorted rows, one row per partition says where it begins, how many rows it has
    and in which file they are: a page reads the files that hold it and no others.
    """

    def __init__(self, df: DataFrame, order: Sequence[Column]):
        keys = [*order, row_hash(df)]
        self.columns = df.columns
        address = F.monotonically_increasing_id()
        self.rows = materialise(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_address", address), "order")
        placed = _with_address(self.rows.select("_address", F.col("_metadata.file_path").alias("_file")))
        self.directory = materialise(_offsets(placed, F.min("_file").alias("_file")), "directory")

    def between(self, first: int, last: int) -> DataFrame:
        """The rows at positions ``first`` to ``last``, from 1, in order."""
        begin = F.col("_start") + F.col("_shift")
        held = self.directory.where((begin < last) & (begin + F.col("_rows") >= first))
        cut = self._placed(held).where(F.col("_position").between(first, last)).orderBy("_position")
        return cut.select(*[_quoted(c) for c in self.columns])

    def _placed(self, held: DataFrame) -> DataFrame:
        """The rows of the partitions ``held`` with their ``_position``, read from their files only."""
        # At most as many partitions as rows asked for.
        parts = held.select("_p", "_shift", "_file").collect()
        spark = self.rows.sparkSession
        if not parts:
            return self.rows.where("false").withColumn("_position", F.lit(None).cast("bigint"))
        shifts = spark.createDataFrame([(p["_p"], p["_shift"]) for p in parts], "_p bigint, _shift bigint")
        rows = _with_address(spark.read.schema(self.rows.schema).parquet(*[p["_file"] for p in parts]))
        return rows.join(F.broadcast(shifts), F.col("_part") == F.col("_p")).withColumn("_position", _position())

    def page(self, number: int, size: int) -> DataFrame:
        if number < 1 or size < 1:
            raise ValueError("page and size must be positive")
        return self.between((number - 1) * size + 1, number * size)

    def pages(self, numbers: range, size: int, place: str = "place", page: str = "page") -> DataFrame:
        """The rows of all pages in ``numbers``, each with its position and its page's number.

        One pass over the files that hold them, whatever the number of pages; the rows come in the
        order of their files, and ``place`` orders them as :meth:`page` does.
        """
        numbers = numbers if numbers.step > 0 else numbers[::-1]
        if size < 1 or (numbers and numbers[0] < 1):
            raise ValueError("page and size must be positive")
        if not numbers:
            return self.rows.where("false").select(
                *[_quoted(c) for c in self.columns], F.lit(0).cast("bigint").alias(place), F.lit(0).cast("bigint").alias(page)
            )

        def number(position: Column) -> Column:
            return F.floor((position - 1) / F.lit(size)).cast("bigint") + 1

        # Of a partition: the first page asked for that does not end before it begins.
        begin = F.col("_start") + F.col("_shift") + 1
        skipped = F.greatest(F.lit(0), F.ceil((number(begin) - numbers[0]) / F.lit(numbers.step)))
        wanted = F.lit(numbers[0]) + skipped * numbers.step
        end = begin + F.col("_rows") - 1
        held = self.directory.where((wanted <= numbers[-1]) & (wanted <= number(end)))
        rows = self._placed(held).withColumn("_page", number(F.col("_position")))
        asked = F.col("_page").between(numbers[0], numbers[-1]) & ((F.col("_page") - numbers[0]) % numbers.step == 0)
        return rows.where(asked).select(
            *[_quoted(c) for c in self.columns], F.col("_position").alias(place), F.col("_page").alias(page)
        )


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; columns of types that Spark cannot hash go in as JSON."""
    plain = [_quoted(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    others = [F.to_json(F.struct(_quoted(c))) for c, kind in df.dtypes if "map<" in kind or "variant" in kind]
    return F.xxhash64(*plain, *others) if df.columns else F.lit(0).cast("bigint")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def chunk(
    df: DataFrame, size: int, order: Sequence[str | Column], name: str = "chunk"
) -> DataFrame:
    """Number consecutive chunks of ``size`` rows from 0; the last one may be short."""
    if size <= 0:
        raise ValueError(f"chunk_size must be positive, got {size}")
    numbered = with_position(df, order, name="_position")
    number = F.floor((F.col("_position") - 1) / F.lit(size)).cast("bigint")
    return numbered.withColumn(name, number).drop("_position")


def chunk_array(col: Column, size: int) -> Column:
    """Consecutive slices of an array column; an empty array gives no chunk."""
    if size <= 0:
        raise ValueError(f"chunk_size must be positive, got {size}")
    starts = F.sequence(F.lit(1), F.size(col), F.lit(size))
    return F.when(F.size(col) > 0, F.transform(starts, lambda i: F.slice(col, i, size))).otherwise(
        F.slice(F.array(col), 1, 0)
    )
