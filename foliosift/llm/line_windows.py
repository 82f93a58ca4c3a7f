"""Operator 3, line dedup by overlapping three-line windows.

Every run of ``width`` consecutive lines is hashed (two 64-bit hashes). A window that occurs
more than once in the whole corpus keeps its first occurrence, by smallest (doc_id, text
hash, position); all lines covered by later occurrences are removed, overlapping windows
merging into one covered range.

Lines end at ``\\n``. Windows of blank lines only are no passages and are left alone. Texts
with fewer lines than a window stay as they are, null and empty ones too. A null id comes
after every other. Rows with the same id and text are one document here: they stay alike.
Different texts may share an id. Other columns are returned untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, salts: int = 8
) -> DataFrame:
    """``docs`` with cleaned text, plus ``lines`` and ``removed`` (array of 0-based positions)."""
    require_columns(docs, id_col, text_col)
    if width < 1:
        raise ValueError("width must be at least 1")
    text = quoted(text_col)
    address = (quoted(id_col).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"))
    parts = F.split(F.coalesce(text, F.lit("")), "\n")
    shifted = F.arrays_zip(*[F.slice(F.col("parts"), k + 1, F.size("parts")).alias(f"l{k}") for k in range(width)])
    lines = [F.col(f"w.l{k}") for k in range(width)]
    windows = (
        docs.select(*address, parts.alias("parts"))
        .where(F.size("parts") >= width)
        .select("id", "h1", "h2", F.posexplode(shifted).alias("at", "w"))
        .where(lines[-1].isNotNull() & F.concat(*lines).rlike(r"[^\x20\x09-\x0D]"))
        .select("id", "h1", "h2", "at", F.xxhash64(*lines).alias("w1"), F.xxhash64(F.lit(1), *lines).alias("w2"))
    )
    occurrence = F.struct(F.col("id").isNull().alias("n"), "id", "h1", "h2", "at")
    repeated = windows.groupBy("w1", "w2").agg(F.min(occurrence).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A window that half of the corpus shares is dealt to ``salts`` tasks.
    dealt = windows.withColumn("salt", F.pmod(F.xxhash64("id", "h1", "at"), F.lit(salts)).cast("int"))
    met = repeated.select("w1", "w2", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    later = dealt.join(met, ["w1", "w2", "salt"]).where(occurrence != F.col("first"))
    reach = F.explode(F.sequence(F.col("at"), F.col("at") + width - 1))
    covered = (
        later.select("id", "h1", "h2", reach.alias("line"))
        .groupBy("id", "h1", "h2")
        .agg(F.array_sort(F.collect_set("line")).alias("removed"))
    )
    # ``id`` as text beside a null flag: a plain equi-join that also meets null ids.
    key = lambda c: (c.isNull().alias("kn"), F.coalesce(c.cast("string"), F.lit("")).alias("ki"))
    found = covered.select(*key(F.col("id")), "h1", "h2", "removed")
    row, gone, count = fresh_name(docs, "row"), fresh_name(docs, "removed"), fresh_name(docs, "lines")
    packed = docs.select(
        *key(quoted(id_col)), *address[1:], F.struct(*[quoted(c) for c in docs.columns]).alias(row)
    )
    joined = packed.join(found, ["kn", "ki", "h1", "h2"], "left").select(
        row,
        F.split(F.col(row)[text_col], "\n").alias("pieces"),
        F.coalesce(F.col("removed"), F.expr("cast(array() as array<int>)")).alias("gone"),
    )
    inside = F.col(row)[text_col]
    stay = F.array_except(F.sequence(F.lit(1), F.size("pieces")), F.transform("gone", lambda i: i + 1))
    cleaned = F.when(F.size("gone") == 0, inside).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at("pieces", i)), "\n")
    )
    return joined.select(
        *[(cleaned if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns],
        F.when(inside.isNull(), 0).otherwise(F.size("pieces")).alias(count),
        F.col("gone").alias(gone),
    )
