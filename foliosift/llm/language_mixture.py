"""Operator 4, language identification by multilingual mixture inference.

Texts are read as character trigrams of letters (lower case, everything else one space),
hashed to ``BUCKETS`` buckets. Fitting counts them per language over all given rows.
A document is a mixture of languages: expectation-maximisation finds the proportions that
make its trigrams likeliest; the language set grows from the best single language as long as
the log-likelihood gains more than ``penalty`` times the log of the number of trigrams for
the added one. The language with the largest share in the chosen set is predicted (ties: the
smaller name). Against the chosen mixture stands a background in which all trigrams are alike;
the share of the text that it does not explain better, times the language's share, is the
score. So text of no learned language, or of none, has a score near 0.

``und`` with score 0 if the text is null or has no letter (or no language was learned);
``languages`` and ``shares`` are then empty. Whole texts are read. Extra columns are kept.
The model has one row of ``BUCKETS`` numbers per language and is sent to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns

BUCKETS = 1 << 15
#: A language's trigrams count as seen this often beforehand.
PRIOR = 0.5
RESULT = "lang_pred string, score double, languages array<string>, shares array<double>"


_TABLES: dict[str, np.ndarray] = {}  # made once in each worker


def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for the rest, of the first plane."""
    if "letters" in _TABLES:
        return _TABLES["letters"]
    found = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            found[c] = ord(low) if len(low) == 1 else c
    _TABLES["letters"] = found
    return found


def trigrams(text: str | None) -> np.ndarray:
    """The buckets of a text's trigrams, in order."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters()
    plain = points < len(table)
    letters = table[np.where(plain, points, 0)]
    if not plain.all():
        far = np.flatnonzero(~plain)
        values, which = np.unique(points[far], return_inverse=True)
        letters[far] = np.array([v if chr(v).isalpha() else 0 for v in values.tolist()], np.uint32)[which]
    if not letters.any():
        return np.zeros(0, np.int64)
    padded = np.concatenate((np.zeros(1, np.uint32), letters, np.zeros(1, np.uint32)))
    padded = padded[np.concatenate(([True], (padded[1:] != 0) | (padded[:-1] != 0)))]
    if len(padded) < 3:
        return np.zeros(0, np.int64)
    mixed = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA77) ^ padded[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(17)).astype(np.int64)


class Model:
    """Trigram probabilities of the learned languages, in name order."""

    def __init__(self, names: list[str], probabilities: np.ndarray, penalty: float, rounds: int):
        self.names, self.probabilities, self.penalty, self.rounds = names, probabilities, penalty, rounds
        self.logs = np.log(probabilities)

    def _mixture(self, likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log-likelihood, after ``rounds`` steps from equal shares."""
        shares = np.full(len(likelihood), 1 / len(likelihood))
        total = counts.sum()
        for _ in range(self.rounds):
            mixed = shares @ likelihood
            shares = shares * (likelihood @ (counts / mixed)) / total
        return shares, float(counts @ np.log(shares @ likelihood))

    def infer(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        grams = trigrams(text)
        if not len(grams) or not self.names:
            return "und", 0.0, [], []
        counts = np.bincount(grams, minlength=BUCKETS)
        seen = np.flatnonzero(counts)
        counts = counts[seen].astype(np.float64)
        single = self.logs[:, seen] @ counts
        best = int(single.argmax())
        chosen, shares, value = [best], np.ones(1), float(single[best])
        if len(self.names) > 1:
            likelihood = self.probabilities[:, seen]
            price = self.penalty * np.log(len(grams) + 1)
            # Every addition is judged by its own gain: after so few steps the likelihood of all
            # languages together is no bound for that of a few.
            every, _ = self._mixture(likelihood, counts)
            order = [best] + [int(k) for k in np.argsort(-every, kind="stable") if k != best]
            for size in range(2, len(order) + 1):
                some, reached = self._mixture(likelihood[order[:size]], counts)
                if reached - value <= price:
                    break
                chosen, shares, value = order[:size], some, reached
        ranked = sorted(zip(-shares, (self.names[k] for k in chosen), strict=True))
        known = 1.0 - self._strange(shares @ self.probabilities[np.ix_(chosen, seen)], counts)
        score = float(min(1.0, max(0.0, -ranked[0][0] * known)))
        return ranked[0][1], score, [n for _, n in ranked], [float(-s) for s, _ in ranked]

    def _strange(self, mixed: np.ndarray, counts: np.ndarray) -> float:
        """The share of the trigrams that a background of all trigrams alike explains better than
        the languages do, by the same steps as their own shares."""
        share, flat, total = 0.5, 1.0 / BUCKETS, counts.sum()
        for _ in range(self.rounds):
            background = share * flat
            share = float(counts @ (background / (background + (1 - share) * mixed))) / total
        return share


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", penalty: float = 8.0, rounds: int = 12) -> Model:
    """Trigram counts over all rows with a text and a language."""
    require_columns(rows, text_col, lang_col)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if lang not in found:
                    found[lang] = np.zeros(BUCKETS, np.int64)
                found[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})

    known = rows.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text")).dropna()
    # Languages times buckets: what is collected doesn't grow with the rows.
    counts = known.mapInPandas(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    names = sorted(table["lang"].unique().tolist())
    seen = np.full((len(names), BUCKETS), PRIOR)
    for k, name in enumerate(names):
        own = table[table["lang"] == name]
        seen[k, own["bucket"].to_numpy()] += own["n"].to_numpy()
    return Model(names, seen / seen.sum(axis=1, keepdims=True), penalty, rounds)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score, languages and shares (of names already there: with
    an underscore in front)."""
    require_columns(docs, text_col)

    @F.pandas_udf(RESULT)
    def infer(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.infer(t) for t in texts], columns=["lang_pred", "score", "languages", "shares"])

    # Non-deterministic by declaration only: Spark then never runs it twice for a row.
    found = fresh_name(docs, "found")
    rows = docs.withColumn(found, infer.asNondeterministic()(quoted(text_col)))
    fields = ("lang_pred", "score", "languages", "shares")
    return rows.select(*[quoted(c) for c in docs.columns], *[F.col(found)[f].alias(fresh_name(docs, f)) for f in fields])
