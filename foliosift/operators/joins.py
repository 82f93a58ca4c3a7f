"""Pairing tables by key instead of by list position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.functions.annotations import TASKS, annotation, parse_annotation, validate_annotation
from foliosift.operators.numbering import row_hash


def attach_scores(texts: DataFrame, scores: DataFrame, key: str = "doc_id") -> DataFrame:
    return texts.join(scores, key, "inner")


def attach_truth(predictions: DataFrame, truth: DataFrame, key: str = "doc_id") -> DataFrame:
    """Predictions with their true scores; unlabelled rows drop out."""
    return predictions.join(truth, key, "inner")


def alignment_audit(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys found on one side only, with the side they are missing from.

    One aggregate over both key columns; only keys are read and shuffled.
    """
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    both = sides.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return both.where("l + r = 1").select(
        key, F.when(F.col("l") == 1, "right").otherwise("left").alias("missing_from")
    )


def require_aligned(left: DataFrame, right: DataFrame, key: str = "doc_id") -> None:
    """Stop if the two sides do not hold the same keys."""
    if not alignment_audit(left, right, key).isEmpty():
        raise ValueError("texts and scores do not hold the same keys")


def pivot_responses(
    responses: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """``(keys…, task, response)`` rows as one row per key with a column per task.

    Of several answers for one task a valid one wins, then one that can be parsed, then the one with the largest
    ``order``, if there is such a column; then the largest text.
    """
    rank = [F.col(order)] if order else []

    def best(name, task):
        record = parse_annotation(F.col("response"), task)
        merit = (validate_annotation(record, task).alias("valid"), record.isNotNull().alias("parsed"))
        return F.max(F.when(F.col("task") == name, F.struct(*merit, *rank, F.col("response"))))

    wide = responses.groupBy(*keys).agg(*[best(name, task).alias(name) for name, task in TASKS.items()])
    return wide.select(*keys, *[F.col(f"{name}.response").alias(name) for name in TASKS])


def attach_annotations(
    texts: DataFrame, responses: DataFrame, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Add the three checked annotation records; an absent answer gives the placeholder.

    The responses are pivoted first, so the texts take part in one join, not three.
    """
    wide = pivot_responses(responses, keys)
    records = {task.output: annotation(F.col(f"r.{name}"), task) for name, task in TASKS.items()}
    joined = texts.alias("t").join(
        wide.alias("r"), [F.col(f"t.{k}") == F.col(f"r.{k}") for k in keys], "left"
    )
    return joined.select("t.*", *[record.alias(name) for name, record in records.items()])


def original_values(
    rows: DataFrame,
    source: DataFrame,
    key: str = "id",
    value: str = "value",
    position: str | None = None,
    name: str = "original_value",
    salts: int = 32,
) -> DataFrame:
    """For every row, ``value`` of the source row with its key.

    Of several source rows the one with the smallest ``position`` counts, without such a
    column the smallest value. The source is cut to one row per key before the join. Keys that
    hold more than 1/``salts`` of the rows are spread over ``salts`` join keys by a hash of the
    row, which a repeated task computes alike; there are fewer than ``salts`` of them, so only
    those few lookup rows are copied. Null keys find nothing and are spread as well.
    """
    first = source.groupBy(key).agg(F.min_by(value, position or value).alias(name))
    # One read of the rows: the total comes with the counts, as the largest of them.
    counts = rows.where(F.col(key).isNotNull()).rollup(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.col("_n").desc(), F.col(key).asc_nulls_first()).limit(salts + 1).collect()
    total = max((n for k, n in top if k is None), default=0)
    hot = [k for k, n in top if k is not None and n > total / salts]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot | F.col(key).isNull(), F.pmod(row_hash(rows), F.lit(salts))).otherwise(F.lit(0))
    left = rows.withColumn("_salt", salt.cast("bigint"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = first.withColumn("_salt", F.explode(copies.cast("array<bigint>")))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
