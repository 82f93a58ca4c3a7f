"""Operator 6, license scans by canonical digests.

A text is brought to a canonical form: lower case, copyright lines dropped, punctuation and
white space folded to single spaces, equivalent spellings made one. Its SHA-256 digest is
joined with the digests of known licenses brought to the same form.

``scan`` compares whole texts with whole texts. ``notices`` compares every run of whole lines
of a text, so it finds one-line notices and licenses over many lines or paragraphs inside a
longer document, however they are wrapped; not those that begin or end within a line.

Null and empty texts, and texts of nothing but punctuation or copyright lines, have an empty
canonical form and match nothing. Of several licenses with one canonical form the smallest
name is returned. Known licenses are broadcast up to ``broadcast_licenses`` rows, counted
here; above that the digests meet in a join whose hot digests are spread by salt. All rows
are returned, repeated and null ids too. ``notices`` holds the digests of all known licenses
in each task; a run is digested only if its length and first words are those of one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns

#: Spellings that license matching treats as equal (variant, standard form).
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("utilisation", "utilization"),
    ("while", "whilst"),
    ("wilful", "willful"),
    ("noncommercial", "non commercial"),
    ("sublicence", "sublicense"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
)

#: A copyright statement: a line that begins with its sign or "all rights reserved", or with the
#: word copyright and then a sign, a year, a place for one, "by", or no more than a short name.
COPYRIGHT_LINE = (
    r"(?m)^[ \t#*/;-]*(?:(?:\(c\)|©|all rights reserved\b)[^\n]*"
    r"|copyright\b(?:[ \t:,-]*(?:\(c\)|©|by\b|[<\[{(]|(?:18|19|20)[0-9][0-9]\b)[^\n]*"
    r"|[^\n]*\b(?:18|19|20)[0-9][0-9]\b[^\n]*|(?:[ \t]+[^ \t\n]+){0,4}[ \t]*))$"
)
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Lines of a license's body that wrapping lets begin like a copyright line.
BODY_LINE = (
    r"(?m)^([ \t#*/;-]*)(?=copyright(?:ed|s)?[ \t]+(?:holders?|owners?|notices?|licen[cs]es?|laws?|interests?|permission|conditions|statements?"
    r"|disclaimers?|and|or|on the|by the free software foundation, write)\b|copyright, (?:patent|trademark)|\(c\)[ \t]+(?:you must|under)\b)"
)
#: Words that a license begins with when it goes on in the line of the copyright statement.
OPENINGS = (
    "permission is hereby granted|permission to use|redistribution and use|this software is|this is free|this program is|this library is|this work is"
    "|everyone is permitted|licensed under|released under|distributed under|the software is provided|this source code form"
)
STATEMENT = rf"(?m)^([ \t#*/;-]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*?)\b(?={OPENINGS})"
#: So many first words of a run are compared before it is digested.
HEAD = 8


def _without_copyright(text: Column) -> Column:
    """Lower case; a copyright line ends where a license begins in it, and body lines stay."""
    lines = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BODY_LINE, "$1|")
    return F.regexp_replace(F.regexp_replace(lines, STATEMENT, "$1\n"), COPYRIGHT_LINE, "")


def canonical(text: Column) -> Column:
    """Words of the canonical form between single spaces, with one at each end."""
    words = F.regexp_replace(F.concat(F.lit(" "), _without_copyright(text), F.lit(" ")), NOT_WORD, " ")
    for variant, standard in SPELLINGS:
        for _ in range(2):  # neighbours share a space
            words = F.replace(words, F.lit(f" {variant} "), F.lit(f" {standard} "))
    return words


def canonical_lines(text: Column) -> Column:
    """The canonical form with a newline between the words of different lines."""
    words = F.regexp_replace(F.concat(F.lit(" "), _without_copyright(text), F.lit(" ")), r"[^\p{L}\p{N}\n]+", " ")
    words = F.regexp_replace(words, r" ?\n[ \n]*", " \n ")
    for variant, standard in SPELLINGS:
        for _ in range(2):
            words = F.replace(words, F.lit(f" {variant} "), F.lit(f" {standard} "))
        if " " in variant:  # the two words may stand on two lines
            a, b = variant.split(" ")
            first, _, second = standard.partition(" ")
            words = F.replace(words, F.lit(f" {a} \n {b} "), F.lit(f" {first} \n {second} " if second else f" {first} \n "))
    return words


def scan(
    docs: DataFrame,
    licenses: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_licenses: int = 100_000,
    salts: int = 8,
) -> DataFrame:
    """doc_id, canonical_sha256 (null for an empty form), license (null: none)."""
    require_columns(docs, id_col, text_col)
    require_columns(licenses, "name", "text")
    digest = lambda text: F.when(canonical(text) != " ", F.sha2(canonical(text), 256))
    known = (
        licenses.select(digest(F.col("text")).alias("canonical_sha256"), F.col("name").alias("license"))
        .where("canonical_sha256 IS NOT NULL")
        .groupBy("canonical_sha256")
        .agg(F.min("license").alias("license"))
    )
    form = F.col("form")
    rows = docs.select(quoted(id_col).alias("doc_id"), canonical(quoted(text_col)).alias("form")).select(
        "doc_id", F.when(form != " ", F.sha2(form, 256)).alias("canonical_sha256")
    )
    if known.count() <= broadcast_licenses:
        return rows.join(F.broadcast(known), "canonical_sha256", "left").select("doc_id", "canonical_sha256", "license")
    spread = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    return dealt.join(spread, ["canonical_sha256", "salt"], "left").select("doc_id", "canonical_sha256", "license")


def notices(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licenses: the names, each once and in order, of the known licenses that some run
    of whole lines consists of (empty: none). One row per row of ``docs``."""
    require_columns(docs, id_col, text_col)
    require_columns(licenses, "name", "text")
    forms = licenses.select("name", canonical(F.col("text")).alias("form")).where("form <> ' ' AND name IS NOT NULL")
    names: dict[str, str] = {}
    lengths: dict[str, set[tuple[int, tuple[str, ...]]]] = {}
    for name, form in forms.toLocalIterator():
        digest = hashlib.sha256(form.encode()).hexdigest()
        names[digest] = min(name, names.get(digest, name))
        words = form.split(" ")[1:-1]
        lengths.setdefault(words[0], set()).add((len(words), tuple(words[:HEAD])))

    def found(form: str) -> list[str]:
        words: list[str] = []
        starts: list[int] = []
        for line in form.split("\n"):
            own = line.split(" ")[1:-1]
            if own:
                starts.append(len(words))
                words += own
        ends = {*starts[1:], len(words)}
        out = set()
        for start in starts:
            for length, head in lengths.get(words[start], ()):
                if start + length in ends and tuple(words[start : start + len(head)]) == head:
                    run = f" {' '.join(words[start : start + length])} "
                    out.add(names.get(hashlib.sha256(run.encode()).hexdigest()))
        return sorted(out - {None})

    @F.pandas_udf("array<string>")
    def found_in(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for forms in batches:
            yield forms.map(found)

    rows = docs.select(quoted(id_col).alias("doc_id"), canonical_lines(quoted(text_col)).alias("form"))
    return rows.select("doc_id", found_in("form").alias("licenses"))
