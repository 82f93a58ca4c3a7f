"""The whole run: clean, deduplicate, score, annotate, write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.operators.annotate import assemble_result
from foliosift.operators.cascade import REASON, apply_cascade, count_outcomes, count_reasons
from foliosift.operators.dedup import mark_duplicates, text_key
from foliosift.operators.rules import Rule
from foliosift.operators.scoring import score_texts
from foliosift.session import materialise, spread, stage_scope
from foliosift.sources.readers import require_input
from foliosift.sources.writers import write_results_jsonl, write_texts_jsonl


@dataclass(frozen=True)
class CurationResult:
    """Frames over files already written: texts, final records, counts."""

    texts: DataFrame
    results: DataFrame
    outcomes: DataFrame
    reasons: DataFrame


def clean(
    corpus: DataFrame, rules: Sequence[Rule], id_col: str = "doc_id", partitions: int | None = None
) -> DataFrame:
    """``doc_id, text, reject_reason`` after the cascade and duplicate removal.

    The cascade is the expensive part and three branches read its result, so it is written
    once, with the key of every text next to it: finding exact copies then reads keys
    only. Rejected rows keep their id and reason but no text.
    """
    cascaded = apply_cascade(spread(corpus.select(id_col, "text"), id_col, partitions), rules)
    staged = cascaded.select(
        id_col, F.when(F.col(REASON).isNull(), F.col("text_clean")).alias("text"), REASON
    )
    staged = materialise(staged.withColumn("text_key", text_key(F.col("text"))), "cleaned")
    return mark_duplicates(staged, id_col, "text", key_col="text_key").drop("text_key")


def curate(
    corpus: DataFrame,
    rules: Sequence[Rule],
    scorer,
    annotator,
    output_path: str,
    id_col: str = "doc_id",
    partitions: int | None = None,
) -> CurationResult:
    """Run everything and write ``marked/``, ``filtered_texts/`` and ``final_texts/``.

    Where no text survives, nothing is scored or annotated and the two outputs are empty.
    ``partitions`` spreads a small input over so many tasks first. The stage table between
    cascade and duplicate removal is removed at the end of the run.
    """
    spark = corpus.sparkSession
    if scorer is None or annotator is None:
        raise ValueError("curate needs a scorer and an annotator")
    marked_path = f"{output_path}/marked"
    with stage_scope(spark):
        clean(require_input(corpus), rules, id_col, partitions).write.mode("overwrite").parquet(marked_path)
    marked = spark.read.parquet(marked_path)
    texts = marked.where(F.col(REASON).isNull()).select(id_col, "text")
    write_texts_jsonl(texts, f"{output_path}/filtered_texts")
    final = assemble_result(annotator.annotate(score_texts(texts, scorer)))
    schema = final.schema
    results_path = f"{output_path}/final_texts"
    survives = not texts.isEmpty()
    write_results_jsonl(final if survives else spark.createDataFrame([], schema), results_path)
    return CurationResult(
        texts=texts,
        results=spark.read.schema(schema).json(results_path),
        outcomes=count_outcomes(marked),
        reasons=count_reasons(marked),
    )
