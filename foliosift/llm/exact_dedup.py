"""Operator 8, exact dedup by skew-safe combining.

Three combining steps, each grouping by the whole text beside its digest, so that equal
digests alone never merge two documents:

1. locally: the map side of the first aggregate leaves one row per text and input partition;
2. salted: partitions are dealt to ``salts`` groups, so a text that fills a third of the
   input arrives at many tasks, with one row per partition at most;
3. globally: at most ``salts`` winners of a text meet.

Texts are equal when identical (null counts as empty). The row with the largest ``doc_id``
stays; a null id is smaller than any other. Rows with the same id and text are copies of each
other and only one of them stays. An empty table gives an empty result. Other columns are
ignored by ``mark`` and kept by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns, row_key
from foliosift.session import materialise

#: Rows of repeated (id, text) that one generated array may hold.
_RUN = 65_536


def _content(text):
    """Digest plus a second hash and the length: what finds a text's group again."""
    return (
        F.sha2(text, 256).alias("text_sha256"),
        F.xxhash64(text).alias("check_hash"),
        F.length(text).alias("check_length"),
    )


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    require_columns(docs, id_col, text_col)
    base = docs.select(
        quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )
    by_salt = (
        base.select("doc_id", "text", *_content(F.col("text")), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
        .groupBy("text_sha256", "check_hash", "check_length", "salt", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    groups = by_salt.groupBy("text_sha256", "check_hash", "check_length", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # Different texts under one address would need two hashes and the length to collide at
    # once; then the run fails instead of mixing them up.
    address = ("text_sha256", "check_hash", "check_length")
    found = groups.groupBy(*address).agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    ).select(
        *address,
        "keep_id",
        F.when(F.col("texts") == 1, F.col("group_size"))
        .otherwise(F.raise_error(F.lit("different texts share a digest")).cast("bigint"))
        .alias("group_size"),
    )
    rows = base.select("doc_id", *_content(F.col("text"))).groupBy("doc_id", *address).agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that both sides of the join are plain and Spark can split a group of copies.
    joined = rows.join(materialise(found, "exact-groups"), list(address))
    # Repeated (id, text) rows come back one by one, in runs of bounded length.
    first_of_run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {_RUN}"))).alias("run")
    copies = joined.select("*", first_of_run).select(
        "*", F.explode(F.sequence(F.col("run") * _RUN, F.least(F.col("n"), (F.col("run") + 1) * _RUN) - 1)).alias("copy")
    )
    return copies.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows that stay, with all their columns; of rows with equal id and text, the one
    whose other columns have the largest hash."""
    require_columns(docs, id_col, text_col)
    row, salt, rank, digest, text = (fresh_name(docs, n) for n in ("row", "salt", "rank", "digest", "whole"))
    others = [c for c in docs.columns if c != text_col]
    whole = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(
        whole.alias(text),
        F.sha2(whole, 256).alias(digest),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias(salt),
        F.struct(quoted(id_col).alias("id"), row_key(docs, (text_col,)).alias("hash")).alias(rank),
        F.struct(*[quoted(c) for c in others], quoted(text_col).isNull().alias(row)).alias(row),
    )
    for keys in ((digest, salt, text), (digest, text)):
        rows = rows.groupBy(*keys).agg(F.max_by(row, rank).alias(row), F.max(rank).alias(rank))
    kept = F.when(F.col(row)[row], F.lit(None).cast("string")).otherwise(F.col(text))
    return rows.select(*[(kept if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns])
