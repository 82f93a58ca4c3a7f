"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names are case-blind)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(df: DataFrame, skip: tuple[str, ...] = ()) -> Column:
    """A hash over all columns but ``skip``, also for types that Spark cannot order."""
    rest = [quoted(c) for c in df.columns if c not in skip]
    return F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("bigint")


def crc_bucket(column: str, modulus: int) -> Column:
    """``crc32`` of the value as text, modulo ``modulus``; null for null."""
    return F.crc32(quoted(column).cast("string").cast("binary")) % modulus
