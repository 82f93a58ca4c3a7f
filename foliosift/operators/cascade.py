"""The ordered cascade of transforms and rules, and its counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.functions.measures import share
from foliosift.functions.planning import evaluate_once
from foliosift.operators.rules import Rule

REASON = "reject_reason"


def apply_cascade(
    df: DataFrame, rules: Sequence[Rule], text_col: str = "text", clean_col: str = "text_clean"
) -> DataFrame:
    """Add ``clean_col`` and ``reject_reason`` (null = accepted).

    The reason is the first failing rule in list order. Reasons are a ``coalesce`` of
    ``when``s, so a later rule is evaluated only for rows that passed the earlier
    ones, and a transform only touches rows still in the race (``clean_col`` is null for
    rows rejected before the last transform). No shuffle. Filters on input columns belong
    before the cascade: none is pushed through it.
    """
    clean, reason = F.col(clean_col), F.col(REASON)
    out = df.withColumns({clean_col: F.col(text_col), REASON: F.lit(None).cast("string")})
    for is_transform, group in groupby(rules, lambda rule: rule.transform is not None):
        if is_transform:
            # One projection per transform: a transform may use its input several times,
            # and chained in one expression the copies would multiply.
            out = out.withColumn(clean_col, F.when(reason.isNull(), clean))
            for rule in group:
                out = out.withColumn(clean_col, rule.transform(clean))
        else:
            failed = [F.when(rule.rejects(clean), F.lit(rule.name)) for rule in group]
            out = out.withColumn(REASON, F.coalesce(reason, *failed))
    return out.withColumn(REASON, evaluate_once(reason))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull())


def count_outcomes(df: DataFrame) -> DataFrame:
    """Accepted, rejected and total documents and the pass rate in percent."""
    passed = F.count_if(F.col(REASON).isNull())
    return df.agg(
        passed.alias("accepted"),
        F.count(F.col(REASON)).alias("rejected"),
        F.count(F.lit(1)).alias("total"),
        (100.0 * share(passed, F.count(F.lit(1)))).alias("pass_rate"),
    )


def count_reasons(df: DataFrame) -> DataFrame:
    """Rejected documents per rule."""
    counted = df.groupBy(REASON).agg(F.count(REASON).alias("documents"))
    return counted.where(F.col("documents") > 0)
