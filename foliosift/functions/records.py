"""Shape and status of record tables."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosift.functions.json_values import parse_values

_DEEPER = "nested deeper than max_depth; raise max_depth"


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def _at(path: tuple[str, ...]) -> Column:
    column = F.col("`" + path[0].replace("`", "``") + "`")
    for name in path[1:]:
        column = column.getField(name)
    return column


def flatten(df: DataFrame, separator: str = ".", prefix: str = "") -> DataFrame:
    """Nested structs as top-level columns with joined names.

    Arrays and scalars are kept whole and structs without fields disappear. Where two
    paths give the same name, the later one supplies the value.
    """
    picked: dict[str, Column] = {}
    for path in _leaves(df.schema):
        name = separator.join(((prefix,) if prefix else ()) + path)
        picked[name] = _at(path)
    return df.select(*[column.alias(name) for name, column in picked.items()])


def flatten_json(
    df: DataFrame,
    column: str,
    *keys: str,
    separator: str = ".",
    prefix: str = "",
    max_depth: int | None = None,
) -> DataFrame:
    """A JSON text column of unknown shape as rows ``(keys…, path, value)``.

    One walk over each text opens its objects, however deep, in the order of their members:
    where two paths have one name, the later one supplies the value. Everything that is no
    object is kept whole; objects without members disappear. With ``max_depth`` a deeper object
    is an error, never a cut. A JSON null is a null value, and a null text is one null leaf.
    """
    leaves = _walk(separator, prefix, max_depth)(F.col(column))
    rows = df.select(*keys, F.explode(leaves).alias("leaf")).select(*keys, "leaf.path", "leaf.node")
    parsed = parse_values(rows, "node", *keys, "path", name="node")
    text = F.when(~F.is_variant_null("node"), F.coalesce(F.try_variant_get("node", "$", "string"), F.to_json("node")))
    return parsed.select(*keys, "path", text.alias("value"))


class _Number(str):
    """A number as it is written."""


def _written(node) -> str:
    """A node as JSON text."""
    if isinstance(node, _Number):
        return node
    if isinstance(node, list):
        return "[" + ",".join(map(_written, node)) + "]"
    if isinstance(node, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_written(v)}" for k, v in node.items()) + "}"
    return json.dumps(node)


def _walk(separator: str, prefix: str, max_depth: int | None):
    """A UDF from JSON texts to their leaves, as paths and JSON texts."""
    leaf = T.StructType([T.StructField("path", T.StringType()), T.StructField("node", T.StringType())])

    def leaves(text: str | None) -> list[tuple[str, str]]:
        if text is None:
            return [(prefix, "null")]
        top = json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_refuse)
        found: dict[str, str] = {}
        stack = [(prefix, top, 0)]
        while stack:
            path, node, depth = stack.pop()
            if not isinstance(node, dict):
                found[path] = _written(node)
                continue
            if max_depth is not None and depth >= max_depth:
                raise ValueError(_DEEPER)
            stack.extend(
                (f"{path}{separator}{name}" if path else name, child, depth + 1) for name, child in reversed(node.items())
            )
        return list(found.items())

    @F.pandas_udf(T.ArrayType(leaf))
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(leaves)

    return walk


def _refuse(name: str):
    raise ValueError(f"Invalid JSON: {name}")


def mark_status(is_valid: Column, processed: Column | None = None) -> tuple[Column, Column]:
    """``status`` and ``processed``: error, success once processed, else pending."""
    done = F.lit(True) if processed is None else processed
    status = (
        F.when(~is_valid, F.lit("error")).when(done, F.lit("success")).otherwise(F.lit("pending"))
    )
    return status.alias("status"), (is_valid & done).alias("processed")
