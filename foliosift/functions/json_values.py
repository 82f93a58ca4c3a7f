"""Parsing JSON text where anything after the value is an error.

``parse_json`` stops at the end of the first value. Parsing ``[text]`` instead and asking for
exactly one element refuses trailing content and several values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift.functions.planning import evaluate_once


def parse_values(df: DataFrame, column: str, *keys: str, name: str = "v") -> DataFrame:
    """``keys…`` and the variant in ``column``; text that is not one JSON value fails the job."""
    wrapped = F.concat(F.lit("["), F.col(column), F.lit("]"))
    parsed = df.select(
        *keys, evaluate_once(F.parse_json(wrapped).cast("array<variant>")).alias("_values")
    )
    wrong = F.raise_error(F.lit("Invalid JSON: expected one value")).cast("variant")
    one = F.when(F.size("_values") == 1, F.element_at("_values", 1)).when(
        F.col("_values").isNotNull(), wrong
    )
    return parsed.select(*keys, one.alias(name))


def parse_arrays(df: DataFrame, column: str, *keys: str, name: str = "v") -> DataFrame:
    """``keys…`` and one row per entry of the JSON arrays in ``column``, entries of any kind.

    Entries are parsed one by one, so only an entry is bound by the size of a variant.
    """
    wrapped = F.concat(F.lit("["), F.col(column), F.lit("]"))
    parsed = F.from_json(wrapped, "array<array<variant>>", {"mode": "FAILFAST"})
    values = df.select(*keys, evaluate_once(parsed).alias("_values"))
    wrong = F.raise_error(F.lit("Invalid JSON: expected one array")).cast("array<variant>")
    one = F.when(F.size("_values") == 1, F.element_at("_values", 1)).otherwise(wrong)
    return values.select(*keys, F.explode(one).alias(name))


def is_json_object(text: Column) -> Column:
    """True for text that is exactly one JSON object."""
    values = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"
    )
    return F.coalesce((F.size(values) == 1) & text.rlike(r"^\s*\{"), F.lit(False))
