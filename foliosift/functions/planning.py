"""Help for the optimizer where its default would repeat expensive work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluate_once(col: Column) -> Column:
    """The same value, computed in exactly one place of the plan.

    Spark pushes a filter on a computed column below the projection by inlining the
    computation, which then runs in the filter and again in the projection; through a
    chain of projections the copies multiply. An expression that counts as
    non-deterministic is left where it is. The condition is always true.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)


def bound(col: Column, use: Callable[[Column], Column]) -> Column:
    """``use(col)`` with ``col`` computed once, however often ``use`` names it: Spark does not
    share a subexpression that stands inside conditions."""
    return F.transform(F.array(col), use)[0]
