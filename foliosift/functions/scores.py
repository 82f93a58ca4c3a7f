"""Scores on the 0 to 4 scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import measures
from foliosift.functions.planning import bound


def clip_score(col: Column, low: float = values.SCORE_MIN, high: float = values.SCORE_MAX) -> Column:
    """Null and NaN give null: ``least`` alone would skip them and grade them ``high``."""
    known = col.isNotNull() & ~F.isnan(col.cast("double"))
    return F.when(known, F.greatest(F.lit(low), F.least(F.lit(high), col)))


def score_class(col: Column) -> Column:
    """Rounded half to even, clipped to the five classes, as int; null for NaN and null."""
    return clip_score(F.bround(col, 0)).cast("int")


def is_educational(col: Column, threshold: float = values.EDUCATIONAL_THRESHOLD) -> Column:
    """NaN is not educational, although Spark orders it above every number."""
    return (col >= F.lit(threshold)) & ~F.isnan(col.cast("double"))


def lexical_score(col: Column) -> Column:
    """A score from column expressions alone: grammar, variety, length, few symbols."""

    def variety(squeezed: Column) -> Column:
        distinct = F.size(F.array_distinct(F.split(squeezed, " ")))
        return measures.share(distinct, measures.word_count(squeezed))

    unit = measures.weighted_sum(
        [
            (0.35, F.least(F.lit(1.0), measures.function_word_share(col) / 0.25)),
            (0.25, bound(measures.squeezed_lower(col), variety)),
            (0.30, F.least(F.lit(1.0), F.length(col) / 2000.0)),
            (0.10, 1.0 - measures.special_share(col)),
        ]
    )
    return F.lit(4.0) * bound(unit, lambda u: clip_score(u, 0.0, 1.0))
