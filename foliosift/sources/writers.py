"""JSON-lines results. All writers overwrite and create missing folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.operators.items import validation_summary
from foliosift.session import materialise

_ESCAPED = {"writeNonAsciiCharacterAsCodePoint": "true"}


def write_texts_jsonl(df: DataFrame, path: str, text_col: str = "text") -> None:
    """One ``{"text": …}`` per line, non-ASCII characters escaped."""
    df.select(F.col(text_col).alias("text")).write.mode("overwrite").options(**_ESCAPED).json(path)


def write_results_jsonl(df: DataFrame, path: str) -> None:
    """Nested records, one per line; null fields are left out."""
    df.write.mode("overwrite").options(**_ESCAPED).json(path)


def write_json(df: DataFrame, path: str, pretty: bool = False, ensure_ascii: bool = False) -> None:
    """Objects one per line, or indented over several lines."""
    options = _ESCAPED if ensure_ascii else {}
    if not pretty:
        df.write.mode("overwrite").options(ignoreNullFields="false", **options).json(path)
        return
    body = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false", **options})
    df.select(body.alias("value")).write.mode("overwrite").text(path)


def write_chunks(df: DataFrame, path: str, chunk_col: str = "chunk") -> None:
    """One folder per chunk number.

    Chunks of consecutive rows already lie together, so the write adds no shuffle.
    """
    df.write.mode("overwrite").partitionBy(chunk_col).json(path)


def write_recovery_report(
    validated: DataFrame, processor: Callable[[DataFrame], DataFrame], path: str
) -> None:
    """``processed/``, ``failed/`` and ``summary/`` below ``path``.

    The validated rows are stored once; the three outputs read them.
    """
    stored = materialise(validated, "validated")
    processor(stored.where("is_valid")).write.mode("overwrite").json(f"{path}/processed")
    failed = stored.where("NOT is_valid").drop("is_valid")
    failed.write.mode("overwrite").json(f"{path}/failed")
    validation_summary(stored).write.mode("overwrite").json(f"{path}/summary")
