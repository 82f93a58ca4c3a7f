"""From raw documents to encoded, mixed training text in five stages.

Every stage takes (spark, docs, folder) and works on all that its predecessor kept. Stage
tables go to the shared folder (``spark.checkpoint.dir``), so a lost executor costs a read.
Null and repeated ids, empty texts and further columns are handled as the operators' own
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliosift.llm import exact_dedup, language_mixture, near_dup_forest, sentencepiece_nbest, source_mix
from foliosift.llm.common import crc_bucket
from foliosift.session import materialise, table

#: A document stays if this share of it is in its main language.
MIN_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without letters go, as do those in which no language reaches ``MIN_SHARE``."""
    model = language_mixture.fit(docs.where((crc_bucket("doc_id", 3) != 1) & F.col("lang").isNotNull()))
    found = language_mixture.identify(docs, model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SHARE)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near_dup_forest.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The sources in their target shares; a document may be repeated or cut to whole blocks."""
    mixed = source_mix.take(docs)
    if "n_chars" not in docs.columns:
        return mixed
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Piece ids of the best segmentation, its score, the next best and the exact round trip."""
    vocabulary = sentencepiece_nbest.Vocabulary.load()
    # Only what the result holds: a further column of the same name as a new one would take its place.
    texts = docs.select("doc_id", "lang", "source", "text")
    found = sentencepiece_nbest.decode(sentencepiece_nbest.encode(texts, vocabulary), vocabulary)
    return found.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        "score",
        F.transform("alternatives", lambda a: a["score"]).alias("next_scores"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: Mixture inference and the piece lattice are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
