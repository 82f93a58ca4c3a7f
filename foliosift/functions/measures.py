"""Per-document measures behind the filter rules.

All of them are narrow and stay in the JVM. N-grams come from one look-ahead regex
per text (overlapping matches), which is linear in the text and avoids lambdas over
token arrays.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions.planning import bound


# After an empty match Java goes on one UTF-16 unit later, which may be the second half of
# a character outside the basic plane; n-grams must not start there.
_LOW_HALF = r"\x{DC00}-\x{DFFF}"


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 where ``whole`` is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _count(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern))


def _length_of(col: Column, char_class: str) -> Column:
    """Number of characters of a negatable class such as ``[\\p{L}]``."""
    return F.length(F.regexp_replace(col, "[^" + char_class[1:-1] + "]+", ""))


def squeezed_lower(col: Column) -> Column:
    """Lower case, whitespace runs as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(col), r"\s+", " "))


def word_ngrams(squeezed: Column, n: int) -> Column:
    """All overlapping ``n``-grams of a space-separated text, as strings."""
    pattern = rf"(?<!\S)(?=([^\s{_LOW_HALF}]\S*(?: \S+){{{n - 1}}})(?!\S))"
    return F.regexp_extract_all(squeezed, F.lit(pattern), F.lit(1))


def char_ngrams(col: Column, n: int) -> Column:
    """All overlapping ``n``-character substrings, counted in code points."""
    pattern = rf"(?s)(?=([^{_LOW_HALF}].{{{n - 1}}}))"
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(1))


def plain_words(col: Column) -> Column:
    """The runs of letters and numbers, in lower case."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def joined_ngrams(words: Column, n: int) -> Column:
    """All overlapping ``n``-grams of an array of words, as strings."""
    if n == 1:
        return words
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    return F.coalesce(
        F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " ")), F.array().cast("array<string>")
    )


def word_count(squeezed: Column) -> Column:
    """Words of a squeezed text, counted by its single spaces."""
    spaces = F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit("")))
    return F.when(squeezed == "", 0).otherwise(spaces + 1)


def duplicate_share(grams: Column, total: Column) -> Column:
    """``1 - distinct / total``, 0 without n-grams.

    ``total`` comes from lengths, so that the array is built only once: inside nested
    conditions Spark does not share a repeated subexpression.
    """
    distinct = F.size(F.array_distinct(grams)).cast("double")
    return 1.0 - F.coalesce(
        F.try_divide(distinct, F.greatest(total, F.lit(0)).cast("double")), F.lit(1.0)
    )


def japanese_share(col: Column) -> Column:
    """Share of kana and ideographs among the letters."""
    return share(
        _length_of(col, r"[\p{IsHiragana}\p{IsKatakana}\p{IsHan}]"), _length_of(col, r"[\p{L}]")
    )


def has_kana(col: Column) -> Column:
    # Neither script has a character up to U+3040: most text is told by that alone.
    return col.rlike(r"[\x{3041}-\x{10FFFF}&&[\p{IsHiragana}\p{IsKatakana}]]")


def letter_runs(col: Column) -> Column:
    """The runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"\p{L}+"), F.lit(0))


def letter_words(col: Column) -> Column:
    """Number of letter runs."""
    return F.array_size(letter_runs(col))


def _among(runs: Column, words: Sequence[str]) -> Column:
    return F.filter(runs, lambda word: word.isin(*words))


def language_hits(col: Column) -> Column:
    """The language with most function-word hits (``lang``), these (``hits``) and the number of
    letter runs (``words``); ties go to the alphabetically last. The text is searched once."""

    def most(found: Column) -> Column:
        scored = [
            F.struct(F.array_size(_among(found, own)).alias("hits"), F.lit(code).alias("lang"))
            for code, own in sorted(values.FUNCTION_WORDS.items())
        ]
        return F.greatest(*scored)

    def counted(runs: Column) -> Column:
        best = bound(_among(runs, all_function_words()), most)
        return bound(best, lambda b: F.struct(b["hits"], b["lang"], F.array_size(runs).alias("words")))

    return bound(letter_runs(col), counted)


def detect_language(col: Column) -> Column:
    """The language with most function-word hits; ties go to the alphabetically last.
    Null if no function word of any language occurs."""
    return bound(language_hits(col), lambda best: F.when(best["hits"] > 0, best["lang"]))


def language_share(col: Column) -> Column:
    """Share of the words that are function words of the detected language; 0 without any."""
    return bound(language_hits(col), lambda best: share(best["hits"], best["words"]))


def all_function_words() -> list[str]:
    return sorted({w for words in values.FUNCTION_WORDS.values() for w in words})


def function_word_share(col: Column) -> Column:
    return bound(letter_runs(col), _function_word_share)


def _function_word_share(runs: Column) -> Column:
    return share(F.array_size(_among(runs, all_function_words())), F.array_size(runs))


def content_word_share(col: Column, min_words: int = 10) -> Column:
    """Share of words that carry no grammar; texts with few words give 0.

    Text with kana is judged by characters: letters that are not particle kana.
    """
    particles = _length_of(col, f"[{values.JAPANESE_PARTICLE_KANA}]")
    by_characters = 1.0 - share(particles, _length_of(col, r"[\p{L}]"))
    by_words = bound(
        letter_runs(col),
        lambda runs: F.when(F.array_size(runs) >= min_words, 1.0 - _function_word_share(runs)).otherwise(0.0),
    )
    return F.when(has_kana(col), by_characters).otherwise(by_words)


def short_line_share(col: Column, min_length: int = 5) -> Column:
    """Share of lines (blank ones included) shorter than ``min_length`` characters."""
    lines = _count(col, r"\n") + 1
    short = _count(col, rf"(?<![^\n])[^\n]{{0,{min_length - 1}}}(?![^\n])")
    return share(short, lines)


def char_repetition(col: Column, n: int = 10) -> Column:
    return duplicate_share(char_ngrams(col, n), F.length(col) - (n - 1))


def word_repetition(col: Column, n: int = 3) -> Column:
    squeezed = squeezed_lower(col)
    return duplicate_share(word_ngrams(squeezed, n), word_count(squeezed) - (n - 1))


def has_single_char_run(col: Column, max_run: int = 20) -> Column:
    """True where one non-space character stands ``max_run`` times in a row."""
    return col.rlike(rf"(?s)(\S)\1{{{max_run - 1},}}")


def ellipsis_line_share(col: Column) -> Column:
    """Share of non-blank lines that end in an ellipsis."""
    non_blank = _count(col, r"(?<![^\n])[^\S\n]*\S")
    ending = _count(col, r"(?:\.\.\.|…)[^\S\n]*(?![^\n])")
    return share(ending, non_blank)


def lexicon_hits(col: Column, terms: Sequence[str]) -> Column:
    """Occurrences of any of ``terms``, literally and case-insensitively."""
    if not terms:
        return F.lit(0)
    longest_first = sorted((t.lower() for t in terms), key=lambda t: (-len(t), t))
    return _count(F.lower(col), "|".join(re.escape(t) for t in longest_first))


def special_share(col: Column) -> Column:
    """Share of characters that are neither letter, number nor space."""
    special = F.length(F.regexp_replace(col, r"[\p{L}\p{N}\s]+", ""))
    return share(special, F.length(col))


def weighted_sum(terms: Sequence[tuple[float, Column]]) -> Column:
    return reduce(add, [F.lit(weight) * col for weight, col in terms])
