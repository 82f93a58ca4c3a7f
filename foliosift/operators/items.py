"""Record tables of ``id, name, value``: checks, filters, capacity, paging, summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions.measures import share
from foliosift.operators.numbering import OrderIndex, row_hash, with_position

# A page that ends below this row is a plain top-k; a deeper one is numbered.
TOP_K_ROWS = 10_000


def where_equal(df: DataFrame, key: str | None, value: Any = None, null_mode: str = "match") -> DataFrame:
    """Rows whose ``key`` equals ``value``; no key keeps all rows.

    With a null ``value``, ``match`` keeps the rows where the field is null or the column
    does not exist, ``all`` keeps every row.
    """
    if null_mode not in ("match", "all"):
        raise ValueError(f"unknown null_mode {null_mode!r}")
    if key is None or (value is None and null_mode == "all"):
        return df
    field = F.col(key) if key in df.columns else F.lit(None)
    return df.where(field.eqNullSafe(F.lit(value)))


_OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    "eq": lambda c, v: c == F.lit(v),
    "ne": lambda c, v: c != F.lit(v),
    "gt": lambda c, v: c > F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "gte": lambda c, v: c >= F.lit(v),
    "lte": lambda c, v: c <= F.lit(v),
    "in": lambda c, v: c.isin(*v),
    "contains": lambda c, v: F.contains(c, F.lit(v)),
}


def where_op(df: DataFrame, key: str, op: str, value: Any) -> DataFrame:
    if op not in _OPERATORS:
        raise ValueError(f"operator must be one of {values.FILTER_OPERATORS}, got {op!r}")
    return df.where(_OPERATORS[op](F.col(key), value))


def validate_items(df: DataFrame, strict: bool = False, enabled: bool = True) -> DataFrame:
    """Add ``errors`` and ``is_valid``.

    A required field that is null or not a column is missing. Otherwise the name must not
    be empty; ``strict`` rejects every falsy field, so ``value = 0`` as well.
    """
    if not enabled:
        return df.withColumns(
            {"errors": F.array().cast("array<string>"), "is_valid": F.lit(True)}
        )
    problems = []
    for field in values.ITEM_FIELDS:
        if field not in df.columns:
            problems.append(F.lit(f"{field} is missing"))
            continue
        column = F.col(field)
        text = dict(df.dtypes)[field] == "string"
        falsy = (column == "") if text else (column == 0)
        problems.append(F.when(column.isNull(), F.lit(f"{field} is missing")))
        if strict or field == "name":
            problems.append(F.when(falsy, F.lit(f"{field} is empty")))
    errors = F.array_compact(F.array(*problems))
    return df.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, failed) of a validated table; two narrow filters over the same plan."""
    return df.where("is_valid"), df.where("NOT is_valid")


def split_by_range(df: DataFrame, key: str, last: Any) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including ``last``, and the rest."""
    return df.where(F.col(key) <= last), df.where(F.col(key) > last)


def require_non_empty(df: DataFrame, validate: bool = True) -> DataFrame:
    if validate and df.isEmpty():
        raise ValueError("Data cannot be empty")
    return df


def process(
    df: DataFrame, processor: Callable[[DataFrame], DataFrame], validate: bool = True
) -> DataFrame:
    """Run a user's frame-to-frame step."""
    return require_non_empty(df, validate).transform(processor)


def process_rows(df: DataFrame, processor: Callable, schema: str, validate: bool = True) -> DataFrame:
    """Run a user's Python step over iterators of pandas batches."""
    return require_non_empty(df, validate).mapInPandas(processor, schema)


def double_value(df: DataFrame) -> DataFrame:
    """The sample processor: double ``value`` and set ``processed``."""
    return df.withColumns({"value": F.col("value") * 2, "processed": F.lit(True)})


def enforce_capacity(
    df: DataFrame, max_items: int, order: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Add ``error``: null for the first ``max_items`` rows of each collection."""
    if max_items <= 0:
        raise ValueError(f"max_items must be positive, got {max_items}")
    message = f"Cannot add item: max_items limit ({max_items}) reached"
    numbered = with_position(df, order, within, name="_position")
    over = F.when(F.col("_position") > max_items, F.lit(message))
    return numbered.withColumn("error", over).drop("_position")


def validation_summary(validated: DataFrame) -> DataFrame:
    return validated.agg(
        F.count(F.lit(1)).alias("total_input"),
        F.count_if("is_valid").alias("successful"),
        F.count_if(~F.col("is_valid")).alias("failed"),
    )


def fill_level(df: DataFrame, max_items: int, within: Sequence[str] = ()) -> DataFrame:
    """Size of each collection and how full it is in percent."""
    if max_items <= 0:
        raise ValueError(f"max_items must be positive, got {max_items}")
    size = F.count(F.lit(1))
    return df.groupBy(*within).agg(
        size.alias("items"), F.round(100.0 * size / max_items, 1).alias("used_percent")
    )


def match_rate(df: DataFrame, condition: Column) -> DataFrame:
    """Matching rows, all rows and the rate in percent, 0 for an empty table."""
    matched, total = F.count_if(condition), F.count(F.lit(1))
    return df.agg(
        matched.alias("matched"),
        total.alias("total"),
        F.round(100.0 * share(matched, total), 1).alias("match_rate"),
    )


def sort_spec(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    return df.orderBy(*order_columns(spec))


def order_columns(spec: Sequence[tuple[str, str]]) -> list[Column]:
    for _, direction in spec:
        if direction not in values.SORT_ORDERS:
            raise ValueError(f"order must be one of {values.SORT_ORDERS}, got {direction!r}")
    return [F.col(c).asc() if d == "asc" else F.col(c).desc() for c, d in spec]


def page(df: DataFrame, page: int, size: int, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows, sorted in the given order.

    Rows with equal keys follow a hash of the whole row on every page, so that pages never
    overlap. Early pages are a top-k; a deep page is read from a stored order, so that no task has
    to hold everything before it. Both ways give the same rows. Who wants many pages keeps the
    stored order: :func:`page_index`.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size must be positive")
    first, last = (page - 1) * size, page * size
    if last <= TOP_K_ROWS:
        return df.orderBy(*order_columns(spec), row_hash(df)).offset(first).limit(size)
    return page_index(df, spec).page(page, size)


def page_index(df: DataFrame, spec: Sequence[tuple[str, str]]) -> OrderIndex:
    """``df`` stored once in the given order: any page then reads only the files that hold it."""
    return OrderIndex(df, order_columns(spec))
