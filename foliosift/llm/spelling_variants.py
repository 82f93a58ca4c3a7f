"""Operator 12, grouping of spelling variants by asymmetric q-chunks.

Two words are near if one code point inserted, deleted or replaced turns one into the other.
The shorter word (of equal ones the smaller) contributes two disjoint chunks, its halves; the
other contributes its positional grams. One edit leaves one of the two chunks whole, and that
chunk stands in the other word at the same place from the start or from the end, so at a shift
of the difference in length, one at most. Only grams at such a place are made, and an
equi-join on (length, place, gram) finds all candidates; the pair is then verified.

Where many words share a half, a chunk alone leaves very many candidates. What stands beside a
kept chunk (the hole) is also within one edit, so it is cut into two chunks by the same rule:
once for every word, and again, as often as needed, for the keys that still hold more than
``MOST`` pairs. Nothing is left out by that. A hole of one code point is the end of it: there
the words of a key differ in that code point alone, so it holds as many as the alphabet.

Results: one row per distinct word. ``form`` is the near word with the largest count (ties:
the smallest in code-point order) if that count is at least ``ratio`` times the word's own.
Counts rise along forms, so following them ends; ``root`` is the last word reached, found by
doubling the steps.

Nulls: rows with a null word or count are left out; repeated words add up their counts. An
empty word is near the words of one code point. Texts may be null, empty or of
any length, and further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns
from foliosift.session import materialise

#: Pairs that one key may hold before its holes are cut again.
MOST = 1 << 20


def runs(docs: DataFrame, letters: str, min_length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): the maximal runs of ``letters`` (a character class) of at least ``min_length``
    code points, one row per occurrence, with A-Z in lower case and all else as it is."""
    require_columns(docs, id_col, text_col)
    found = F.regexp_extract_all(quoted(text_col), F.lit(f"{letters}{{{min_length},}}"), F.lit(0))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return docs.select(quoted(id_col).alias("id"), F.explode(found).alias("run")).select(
        "id", F.translate("run", capitals, capitals.lower()).alias("run")
    )


def _key(word: Column, start: Column, stop: Column, base: Column) -> Column:
    """Base length and hole of the shorter word, and what stands around the hole in this one."""
    hole = F.length(word) - base  # by how much the hole is longer here: 0 or 1
    return F.xxhash64(
        base, start, stop, F.substring(word, F.lit(1), start), F.substring(word, stop + hole + 1, F.length(word))
    )


def _near(a: Column, b: Column, start: Column, stop: Column) -> Column:
    """Equal around the hole, and one edit apart inside it: a short comparison for long words."""
    more = F.length(b) - F.length(a)
    same_front = F.substring(a, F.lit(1), start) == F.substring(b, F.lit(1), start)
    same_back = F.substring(a, stop + 1, F.length(a)) == F.substring(b, stop + more + 1, F.length(b))
    holes = F.levenshtein(F.substring(a, start + 1, stop - start), F.substring(b, start + 1, stop - start + more), 1)
    return same_front & same_back & (holes == 1)


def _cut(rows: DataFrame) -> DataFrame:
    """Every hole as its two halves."""
    middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("start"), middle.alias("stop")), F.struct(middle.alias("start"), F.col("stop"))
    )
    return (
        rows.select("word", "n", "grams", "base", F.explode(halves).alias("hole"))
        .select("word", "n", "grams", "base", "hole.start", "hole.stop")
        .withColumn("key", _key(F.col("word"), F.col("start"), F.col("stop"), F.col("base")))
    )


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words once; ``words`` holds distinct
    words and their counts (word, n)."""
    length = F.length("word")
    whole = [F.lit(0).alias("start"), F.col("base").alias("stop")]
    chunks = words.select("word", "n", F.lit(False).alias("grams"), length.alias("base"))
    grams = words.select(
        "word", "n", F.lit(True).alias("grams"), F.explode(F.array(length, length - 1)).alias("base")
    )
    rows = _cut(_cut(chunks.unionByName(grams.where("base >= 0")).select("*", *whole)))
    found = []
    while True:
        sizes = rows.groupBy("key").agg(
            F.sum(F.when(~F.col("grams"), 1).otherwise(0)).alias("few"),
            F.sum(F.col("grams").cast("int")).alias("many"),
            F.max(F.col("stop") - F.col("start")).alias("width"),
        )
        hot = materialise(sizes.where((F.col("few") * F.col("many") > most) & (F.col("width") > 1)).select("key"), "hot-grams")
        if hot.isEmpty():
            found.append(rows)
            break
        found.append(rows.join(hot, "key", "left_anti"))
        rows = materialise(_cut(rows.join(hot, "key", "left_semi")), "grams")
    pairs = None
    for part in found:
        a = part.where(~F.col("grams")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), "start", "stop")
        b = part.where("grams").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
        # The longer word has the grams; of two as long as each other the larger has.
        role = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        met = a.join(b, "key").where(role & _near(F.col("a"), F.col("b"), F.col("start"), F.col("stop")))
        met = met.select("a", "a_n", "b", "b_n")
        pairs = met if pairs is None else pairs.unionByName(met)
    # An edit at a border, or of a letter beside its like, leaves more than one part whole.
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; every round doubles the steps taken."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = moved.select("word", "root")


def group(words: DataFrame, ratio: float = 10, word_col: str = "word", n_col: str = "n", most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every distinct word of ``words``."""
    require_columns(words, word_col, n_col)
    counted = materialise(
        words.select(quoted(word_col).alias("word"), quoted(n_col).cast("bigint").alias("n"))
        .where("word IS NOT NULL AND n IS NOT NULL")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    pairs = materialise(near_pairs(counted, most), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    enough = -F.col("best.n") >= F.lit(ratio) * F.col("n")
    judged = materialise(
        counted.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
