"""Filter rules: a name, a column that says "reject", and the default ordered list."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import measures, text
from foliosift.functions.planning import bound


@dataclass(frozen=True)
class Rule:
    """One step of a cascade.

    ``rejects`` maps the current text to a boolean column; ``transform`` replaces the
    current text. Both are column expressions, so a user's own rule is planned together
    with the built-in ones; a ``pandas_udf`` fits in as well.
    """

    name: str
    rejects: Callable[[Column], Column] | None = None
    transform: Callable[[Column], Column] | None = None

    def __post_init__(self):
        if (self.rejects is None) == (self.transform is None):
            raise ValueError(f"rule {self.name!r} needs exactly one of rejects and transform")


def accept_japanese(min_ratio: float = 0.5) -> Rule:
    return Rule(
        "language",
        lambda c: ~(measures.has_kana(c) & (measures.japanese_share(c) >= min_ratio)),
    )


def accept_language(languages: Sequence[str], min_ratio: float = 0.5, min_share: float = 0.02) -> Rule:
    """Keep the named languages; ``ja`` by script from ``min_ratio`` on, the others by function
    words, which must make up ``min_share`` of the words: a single one in a long text decides
    nothing. Running text has a fifth or more."""
    known = [code for code in languages if code != "ja"]

    def rejects(c: Column) -> Column:
        keep = F.lit(False)
        if known:

            def spoken(best: Column) -> Column:
                named = F.coalesce((best["hits"] > 0) & best["lang"].isin(*known), F.lit(False))
                return named & (measures.share(best["hits"], best["words"]) >= min_share)

            keep = bound(measures.language_hits(c), spoken)
        if "ja" in languages:
            keep = (measures.has_kana(c) & (measures.japanese_share(c) >= min_ratio)) | keep
        return ~keep

    return Rule("language", rejects)


def strip_html(exact: bool = False) -> Rule:
    """``exact`` gives the stripped text nodes of an HTML parser, joined by one space."""
    return Rule("strip_html", transform=text.strip_html_parsed if exact else text.strip_html)


def remove_phrases(phrases: Sequence[str] = values.BOILERPLATE_PHRASES) -> Rule:
    return Rule("remove_phrases", transform=lambda c: text.remove_phrases(c, phrases))


def strip_emojis() -> Rule:
    return Rule("strip_emojis", transform=text.strip_emojis)


def map_full_width() -> Rule:
    return Rule("map_full_width", transform=text.map_full_width)


def normalize() -> Rule:
    return Rule("normalize_nfkc", transform=text.normalize_nfkc)


def doc_length(min_length: int = 50, max_length: int = 20000) -> Rule:
    # A missing text counts as too short.
    return Rule(
        "doc_length", lambda c: ~F.coalesce(F.length(c).between(min_length, max_length), F.lit(False))
    )


def short_lines(threshold: float = 0.5, min_length: int = 5) -> Rule:
    return Rule("short_lines", lambda c: measures.short_line_share(c, min_length) > threshold)


def noun_heavy(
    max_ratio: float = 0.8,
    min_words: int = 10,
    noun_share: Callable[[Column], Column] | None = None,
) -> Rule:
    """``noun_share`` may be a tagger's share of nouns, for example a ``pandas_udf``."""
    measure = noun_share or (lambda c: measures.content_word_share(c, min_words))
    return Rule("noun_heavy", lambda c: measure(c) > max_ratio)


def char_repetition(n: int = 10, max_ratio: float = 0.33) -> Rule:
    return Rule("char_repetition", lambda c: measures.char_repetition(c, n) > max_ratio)


def word_repetition(n: int = 3, max_ratio: float = 0.40) -> Rule:
    return Rule("word_repetition", lambda c: measures.word_repetition(c, n) > max_ratio)


def single_char_run(max_run: int = 20) -> Rule:
    return Rule("single_char_run", lambda c: measures.has_single_char_run(c, max_run))


def ending_ellipsis(max_ratio: float = 0.3) -> Rule:
    return Rule("ending_ellipsis", lambda c: measures.ellipsis_line_share(c) > max_ratio)


def lexicon(name: str, terms: Sequence[str] | None = None, max_hits: int = 3) -> Rule:
    """Reject from ``max_hits`` occurrences on; the default terms are the lexicon ``name``."""
    chosen = values.LEXICONS[name] if terms is None else terms
    return Rule(name, lambda c: measures.lexicon_hits(c, chosen) >= max_hits)


def lexicons_from_table(table: DataFrame, max_terms: int = 10_000) -> dict[str, list[str]]:
    """Term lists per category from a ``(category, term)`` table.

    The terms become part of the plan, so a table with more than ``max_terms`` rows is an
    error; ``lexicons.lexicon_rule`` takes tables of any size.
    """
    rows = table.select("category", "term").distinct().limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"lexicon table has more than {max_terms} terms")
    lexicons: dict[str, list[str]] = {}
    for category, term in sorted(tuple(row) for row in rows):
        lexicons.setdefault(category, []).append(term)
    return lexicons


def _slot(col: str) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(1 << 20)).cast("int")


def attach_word_hits(
    df: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16
) -> DataFrame:
    """``df`` with the map column ``lexicon_hits``: occurrences of whole words per category.

    This counts words and not, as the lexicon rules do, any place of the text: for those see
    ``lexicons.attach_lexicon_hits``. ``lexicon`` holds ``(category, term)`` in any number; a term is one or more whole words
    (runs of letters and numbers), compared in lower case. The texts' word n-grams, counted per
    document, meet the terms in a join; each term is copied ``salts`` times, so that a term of
    every document spreads. Of the n-grams only those move that share a hash with a term: the
    hashes, 2**20 at most whatever the lexicon holds, are broadcast. Ids must be unique. A rule reads the column beside the text:
    ``Rule("ads", lambda c: F.coalesce(F.col("lexicon_hits")["ads"], F.lit(0)) >= 3)``.
    """
    terms = lexicon.select("category", F.array_join(measures.plain_words(F.col("term")), " ").alias("term"))
    terms = terms.where("term <> ''").distinct()
    # As many small numbers as terms have different lengths in words.
    sizes = terms.agg(F.collect_set(F.size(F.split("term", " ")))).first()[0]
    if not sizes:
        return df.withColumn("lexicon_hits", F.lit(None).cast("map<string,bigint>"))
    words = df.select(F.col(id_col).alias("id"), measures.plain_words(F.col(text_col)).alias("w"))
    grams = F.flatten(F.array(*[measures.joined_ngrams(F.col("w"), n) for n in sorted(sizes)]))
    hashes = terms.select(_slot("term").alias("slot")).distinct()
    near = words.select("id", F.explode(grams).alias("term")).withColumn("slot", _slot("term"))
    counted = near.join(F.broadcast(hashes), "slot", "left_semi").groupBy("id", "term").agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    copies = terms.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    hits = dealt.join(copies, ["term", "salt"]).groupBy("id", "category").agg(F.sum("n").alias("n"))
    # One entry per category of the lexicon.
    per_doc = hits.groupBy(F.col("id").alias(id_col)).agg(
        F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("lexicon_hits")
    )
    return df.join(per_doc, id_col, "left")


def special_tokens(threshold: float = 0.4) -> Rule:
    return Rule("special_tokens", lambda c: measures.special_share(c) > threshold)


def default_rules(language: Rule | None = None, **changed: Rule) -> list[Rule]:
    """The full ordered list; any rule can be replaced by keyword."""
    steps = [
        language or accept_japanese(),
        strip_html(),
        remove_phrases(),
        strip_emojis(),
        map_full_width(),
        normalize(),
        doc_length(),
        short_lines(),
        noun_heavy(),
        char_repetition(),
        word_repetition(),
        single_char_run(),
        ending_ellipsis(),
        lexicon("ads"),
        lexicon("adult"),
        lexicon("violence"),
        lexicon("discrimination"),
        special_tokens(),
    ]
    unknown = set(changed) - {rule.name for rule in steps}
    if unknown:
        raise ValueError(f"no such rules: {sorted(unknown)}")
    return [changed.get(rule.name, rule) for rule in steps]
