"""Operator 2, URL filters by hash prefixes.

Every URL is expanded into (host suffix, path prefix) expressions. The short prefix of an
expression's SHA-256 digest is the join key against the rules, the full digest confirms the
match, and of the confirmed rules the longest decides.

Only the host depths (number of labels) and path lengths that occur among the rules are
expanded; the two lists come from the rules, hold at most a few thousand small numbers (a
URL's length) and lose no match. Hosts and paths are first made distinct, so a host or page
that fills a third of the table is matched once; verdicts return by a salted join.

A null URL or one without ``://`` has an empty host and path and fits no rule. Repeated and
null page ids are judged row by row. Of rules of equal length the one with the longer host
wins, then a block rule. No rule: the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hexadecimal digits of the digest that form the join key.
PREFIX_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _digest(host: Column, path: Column) -> Column:
    # A space ends the host: hosts and paths cannot be cut in two ways.
    return F.sha2(F.concat(host, F.lit(" "), path), 256)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    broadcast_rules: int = 100_000,
    salts: int = 8,
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row.

    ``rules`` has (host, path, verdict). Up to ``broadcast_rules`` rows, counted here, they
    are broadcast; above that they are joined by a shuffle on prefix and salt.
    """
    require_columns(pages, id_col, url_col)
    require_columns(rules, "host", "path", "verdict")
    known = (
        rules.select("host", "path", "verdict")
        .where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .distinct()
        .select(
            F.col("host").alias("rule_host"),
            F.col("path").alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
            _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        )
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )
    facts = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(_labels(F.col("rule_host"))).alias("depths"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    host, path = host_and_path(quoted(url_col))
    parsed = pages.select(quoted(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    if not facts.n:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    numbers = lambda found: F.array(*[F.lit(int(x)) for x in sorted(found)])
    addresses = parsed.select("host", "path").where(F.col("host") != "").distinct()
    expressions = (
        addresses.select("*", F.split("host", r"\.").alias("parts"), F.explode(numbers(facts.depths)).alias("depth"))
        .where(F.col("depth") <= F.size("parts"))
        .select(
            "host",
            "path",
            F.array_join(F.slice("parts", F.size("parts") - F.col("depth") + 1, F.col("depth")), ".").alias("suffix"),
            F.explode(numbers(facts.lengths)).alias("length"),
        )
        .where(F.col("length") <= F.length("path"))
        .select("host", "path", _digest(F.col("suffix"), F.expr("substring(path, 1, length)")).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    if facts.n <= broadcast_rules:
        met = expressions.join(F.broadcast(known), "prefix")
    else:
        spread = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        dealt = expressions.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int"))
        met = dealt.join(spread, ["prefix", "salt"])
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").alias("block"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = met.where(F.col("digest") == F.col("rule_digest")).groupBy("host", "path").agg(F.max(order).alias("best"))
    answers = best.select(
        "host", "path", F.col("best.rule"), F.col("best.verdict").alias("found"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    rows = parsed.withColumn("salt", F.pmod(F.xxhash64("page_id", "host"), F.lit(salts)).cast("int"))
    return rows.join(answers, ["host", "path", "salt"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict")
    )
