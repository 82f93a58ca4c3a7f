"""Scorers: a text column in, ``score`` and ``is_educational`` out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.model_cache import ModelCache
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliosift import values
from foliosift.functions import scores
from foliosift.functions.planning import evaluate_once
from foliosift.functions.text import normalize_nfkc, truncate_tokens


def _with_verdict(df: DataFrame, threshold: float) -> DataFrame:
    return df.withColumn("is_educational", scores.is_educational(F.col("score"), threshold))


@dataclass(frozen=True)
class LexicalScorer:
    """Column expressions only."""

    threshold: float = values.EDUCATIONAL_THRESHOLD

    def score(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        return _with_verdict(
            df.withColumn("score", evaluate_once(scores.lexical_score(F.col(text_col)))), self.threshold
        )


@dataclass(frozen=True)
class MlScorer:
    """Four times the class probability of a fitted Spark ML pipeline."""

    model: PipelineModel
    threshold: float = values.EDUCATIONAL_THRESHOLD
    text_col: str = "text"

    @classmethod
    def fit(
        cls,
        labelled: DataFrame,
        text_col: str = "text",
        label_col: str = "quality",
        features: int = 1 << 14,
        **settings,
    ) -> MlScorer:
        stages = [
            RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}]+"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_features"),
            LogisticRegression(
                featuresCol="_features", labelCol=label_col, probabilityCol="_probability",
                rawPredictionCol="_raw", predictionCol="_prediction", maxIter=20, regParam=0.05,
            ),
        ]
        return cls(Pipeline(stages=stages).fit(labelled), text_col=text_col, **settings)

    def score(self, df: DataFrame, text_col: str | None = None) -> DataFrame:
        if text_col not in (None, self.text_col):
            raise ValueError(f"the model was fitted on column {self.text_col!r}")
        scored = self.model.transform(df).select(
            *df.columns, (4.0 * vector_to_array("_probability")[1]).alias("score")
        )
        return _with_verdict(scored, self.threshold)


@dataclass(frozen=True)
class BatchScorer:
    """A user model over batches of texts of like length.

    ``make_predict`` runs once per Python worker, loads the model and returns a function from
    a numpy array of texts to a numpy array of scores. Texts are normalised and cut to
    ``max_tokens`` first. The rows of an Arrow batch, a bounded buffer, are sorted by their number
    of tokens before they are cut into batches, so that a batch is padded to texts of its own
    length; the scores go back to their rows. A model that cannot be loaded fails the job.
    """

    make_predict: Callable
    threshold: float = values.EDUCATIONAL_THRESHOLD
    batch_size: int = 512
    max_tokens: int | None = 512

    def __post_init__(self):
        if not callable(self.make_predict):
            raise ValueError("BatchScorer needs a make_predict function")

    def score(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        predict = _by_length(self.make_predict, self.batch_size)
        text = normalize_nfkc(F.col(text_col))
        if self.max_tokens is not None:
            text = truncate_tokens(text, self.max_tokens)
        return _with_verdict(df.withColumn("score", evaluate_once(predict(text))), self.threshold)


def _by_length(make_predict: Callable, batch_size: int):
    """The model as a UDF that sorts each Arrow batch by token count."""
    key = uuid.uuid4()

    @F.pandas_udf(T.DoubleType())
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Kept by the worker for its later tasks.
        model = ModelCache.get(key)
        if model is None:
            model = make_predict()
            ModelCache.add(key, model)
        for batch in texts:
            values = batch.to_numpy(dtype=object)
            order = np.argsort([0 if t is None else t.count(" ") for t in values], kind="stable")
            scores = np.empty(len(values))
            for start in range(0, len(values), batch_size):
                rows = order[start : start + batch_size]
                found = np.asarray(model(values[rows]), dtype=float).reshape(-1)
                if len(found) != len(rows):
                    raise ValueError(f"the model gave {len(found)} scores for {len(rows)} texts")
                scores[rows] = found
            yield pd.Series(scores)

    return predict


def score_texts(df: DataFrame, scorer, text_col: str = "text") -> DataFrame:
    """Add ``score`` and ``is_educational``; without a scorer the plan is not built."""
    if scorer is None or not hasattr(scorer, "score"):
        raise ValueError("score_texts needs a scorer backend")
    return scorer.score(df, text_col)
