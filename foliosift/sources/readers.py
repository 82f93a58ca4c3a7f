"""Corpora and record files as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosift.functions.json_values import parse_arrays, parse_values
from foliosift.sources import json_arrays


def _texts(objects: DataFrame, id_field: str | None, id_type: str, number: Column | None = None) -> DataFrame:
    """Variant rows to ``doc_id, text``; rows that are no object or lack a text are skipped."""
    kind = F.schema_of_variant("v")
    # A JSON null under "text" is a text entry; a missing key is not.
    has_text = F.try_variant_get("v", "$.text", "variant").isNotNull()
    rows = objects.where(F.startswith(kind, F.lit("OBJECT")) & has_text)
    text = F.try_variant_get("v", "$.text", "string").alias("text")
    if id_field is None:
        number = F.monotonically_increasing_id() if number is None else number
        return rows.select(number.alias("doc_id"), text)
    return rows.select(F.try_variant_get("v", f"$.{id_field}", id_type).alias("doc_id"), text)


def read_json_corpus(
    spark: SparkSession,
    path: str,
    lines: bool = False,
    id_field: str | None = None,
    id_type: str = "bigint",
    joined: bool = False,
) -> DataFrame:
    """``doc_id, text`` from JSON array files, or from JSON lines with ``lines=True``.

    Array files of any size are read in parts by many tasks (see ``json_arrays``). Ids come from
    ``id_field`` (``id_type`` "string" for names such as URNs; what does not fit the type is null,
    and duplicate removal refuses null ids) or are numbers that rise in file order; for one array
    file read in one part those are the list positions. Spark passes over empty files.
    With ``joined`` the files are one array together, in the order of their names.
    """
    if lines:
        objects = parse_values(spark.read.text(path).where(F.trim("value") != ""), "value")
        return _texts(objects, id_field, id_type)
    whole, across = json_arrays.array_parts(spark, path, joined)
    texts = [
        _texts(parse_arrays(parts, "value", "part"), id_field, id_type, json_arrays.rising(F.col("part"), crossing))
        for parts, crossing in ((whole, False), (across, True))
    ]
    return texts[0].unionByName(texts[1])


def require_input(df: DataFrame) -> DataFrame:
    """Stop on an empty corpus; a missing path already stops the read."""
    if df.isEmpty():
        raise ValueError("No texts found in the input")
    return df


def read_json_objects(
    spark: SparkSession,
    path: str,
    strict: bool = True,
    schema: str | None = None,
    lines: bool = False,
) -> DataFrame:
    """One JSON value per file, or per line, as variant column ``value`` or as ``schema``.

    Invalid JSON fails the job; ``strict`` also rejects a top-level value that is no object.
    """
    raw = spark.read.text(path, wholetext=not lines)
    parsed = parse_values(raw, "value", name="value")
    if strict:
        kind = F.schema_of_variant("value")
        wrong = F.raise_error(F.concat(F.lit("Expected JSON object, got "), kind)).cast("variant")
        is_object = F.startswith(kind, F.lit("OBJECT"))
        parsed = parsed.select(F.when(is_object, F.col("value")).otherwise(wrong).alias("value"))
    if schema is None:
        return parsed
    return parsed.select(F.col("value").cast(f"struct<{schema}>").alias("value")).select("value.*")


def read_many(spark: SparkSession, paths: Mapping[str, str], schema: str) -> DataFrame:
    """Union of JSON-lines item folders with their ``category``."""
    frames = [
        spark.read.schema(schema).json(path, mode="FAILFAST").withColumn("category", F.lit(name))
        for name, path in paths.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_table_file(spark: SparkSession, path: str, kind: str, schema: str | None = None) -> DataFrame:
    """The declared simple formats: ``json`` (lines), ``csv`` with header, ``txt``."""
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "json":
        return reader.json(path, mode="FAILFAST")
    if kind == "csv":
        return reader.csv(path, header=True, mode="FAILFAST")
    if kind == "txt":
        return spark.read.text(path)
    raise ValueError(f"unknown file format {kind!r}")


def read_labelled(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """Texts with a true score on the 0 to 4 scale, from a 0/1 label table."""
    truth = labels.select(key, (4.0 * F.col(label)).alias("truth"))
    return documents.join(truth, key, "inner")
