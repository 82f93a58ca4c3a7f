"""Operator 7, quality scores by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: no trusted negatives are used. The
class prior (share of good texts among the unlabelled) is estimated from a first
positive-against-unlabelled model: over the score sets {score > t} that hold at least half of
the positives, the smallest ratio of the unlabelled to the positive share bounds it. A
logistic model then minimises the non-negative unbiased risk

    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])

by Adam; where the second part falls below zero, its gradient is followed the other way.

Features describe the shape of a whole text: frequencies of pairs of character classes,
length, word lengths, shares of distinct words and lines and of repeated words in a row. Null and empty texts have zero
frequencies and lengths and get that point's score. At most ``fit_rows`` positives and as
many unlabelled rows, those with the smallest hash of (id, text), are fitted, a few numbers
a row (rows that repeat an id and text count once); every row is scored. With no positives or no unlabelled rows all scores are 0.5.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.llm.common import fresh_name, quoted, require_columns

#: Character classes: space, line end, lower, upper or title, other letter, digit,
#: sentence mark, other mark or symbol.
_CLASSES = 8
_PAIRS = _CLASSES * _CLASSES
WIDTH = _PAIRS + 8
#: Standardised features end here, so that no odd text outweighs all else.
_FAR = 6.0


def _class(x: str) -> int:
    if x == "\n":
        return 1
    if x.isspace():
        return 0
    if x.islower():
        return 2
    if x.isupper() or x.istitle():
        return 3
    if x.isalpha():
        return 4
    if x.isdigit():
        return 5
    return 6 if x in ".,;:!?'\"-()" else 7


_TABLES: dict[str, np.ndarray] = {}  # made once in each worker


def _table() -> np.ndarray:
    if "classes" not in _TABLES:
        _TABLES["classes"] = np.array([_class(chr(c)) for c in range(1 << 16)] + [7], np.int64)
    return _TABLES["classes"]


def features(text: str | None) -> np.ndarray:
    out = np.zeros(WIDTH)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _table()[np.minimum(points, 1 << 16)]
    pairs = np.bincount(kinds[:-1] * _CLASSES + kinds[1:], minlength=_PAIRS)
    out[:_PAIRS] = np.sqrt(pairs / max(1, len(kinds) - 1))
    words, lines = text.split(), text.split("\n")
    distinct = len(set(words))
    out[_PAIRS:] = (
        np.log1p(len(points)),
        np.log1p(len(words)),
        np.log1p((len(points) - len(words)) / max(1, len(words))),
        np.log1p(len(max(words, key=len, default=""))),
        distinct / max(1, len(words)),
        len(set(lines)) / len(lines),
        np.log1p(distinct),
        sum(map(eq, words, words[1:])) / max(1, len(words)),
    )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """A logistic model over standardised features."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray, prior: float):
        self.centre, self.spread, self.weights, self.prior = centre, spread, weights, prior

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.standard(rows) @ self.weights[:-1] + self.weights[-1])

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.spread, -_FAR, _FAR)


def _minimise(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    weights, mean, square = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(weights)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        weights = weights - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return weights


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The largest share of positives that the scores of both samples allow."""
    cuts = np.quantile(positive, np.linspace(0.02, 0.5, 25))
    slack = 1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled))
    ratios = [((unlabelled >= c).mean() + slack / 2) / max((positive >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratios), 0.01, 0.99))


def learn(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 600, rate: float = 0.03, decay: float = 1e-4) -> Model:
    """A model from feature rows of trusted positives and of unlabelled texts."""
    width = unlabelled.shape[1] if unlabelled.ndim == 2 else WIDTH
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width + 1), 0.5)
    both = np.concatenate((positive, unlabelled))
    centre, spread = both.mean(axis=0), both.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    plain = Model(centre, spread, np.zeros(width + 1), 0.5)
    one = lambda x: np.hstack((plain.standard(x), np.ones((len(x), 1))))
    p, u = one(positive), one(unlabelled)

    def against(w):  # positives against unlabelled, both classes weighing the same
        return ((_sigmoid(p @ w) - 1) @ p) / len(p) + (_sigmoid(u @ w) @ u) / len(u) + 0.01 * w

    first = _minimise(against, width + 1, steps // 2, rate)
    prior = class_prior(p @ first, u @ first)

    def risk(w):
        fp, fu = p @ w, u @ w
        good = prior * ((_sigmoid(fp) - 1) @ p) / len(p)
        bad = (_sigmoid(fu) @ u) / len(u) - prior * (_sigmoid(fp) @ p) / len(p)
        value = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        return (good + bad if value >= 0 else -bad) + decay * w

    return Model(centre, spread, _minimise(risk, width + 1, steps, rate), prior)


def fit(
    docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    fit_rows: int = 20_000, **options,
) -> Model:
    """``positives`` and ``unlabelled`` hold the ids of the rows of ``docs`` to learn from."""
    require_columns(docs, id_col, text_col)

    @F.pandas_udf("array<double>")
    def describe(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    # Ids and hashes choose the rows; texts stay where they are and meet a broadcast of at most
    # two times ``fit_rows`` rows.
    mark = F.xxhash64(quoted(id_col), quoted(text_col)).alias("mark")
    narrow = docs.select(quoted(id_col).alias("id"), mark)

    def sample(ids: DataFrame, trusted: bool) -> DataFrame:
        wanted = ids.select(quoted(id_col).alias("id")).dropna().distinct()
        chosen = narrow.join(wanted, "id", "left_semi").distinct().orderBy("mark", "id").limit(fit_rows)
        return chosen.withColumn("trusted", F.lit(trusted))

    chosen = sample(positives, True).unionByName(sample(unlabelled, False))
    rows = docs.select(quoted(id_col).alias("id"), mark, quoted(text_col).alias("text")).join(F.broadcast(chosen), ["id", "mark"])
    # Rows that repeat an id and text count once, so that no more rows come back than were chosen.
    described = rows.select("trusted", "mark", "id", describe("text").alias("f")).groupBy("trusted", "mark", "id").agg(F.first("f").alias("f"))
    found = described.orderBy("trusted", "mark", "id").toPandas()
    part = lambda kind: found["f"][found["trusted"] == kind].to_list()
    stack = lambda some: np.stack(some) if some else np.zeros((0, WIDTH))
    return learn(stack(part(True)), stack(part(False)), **options)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus score (0 to 1, higher: better)."""
    require_columns(docs, text_col)

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        rows = [features(t) for t in texts]
        return pd.Series(model.scores(np.stack(rows)) if rows else np.zeros(0))

    return docs.withColumn(fresh_name(docs, "score"), judge.asNondeterministic()(quoted(text_col)))
