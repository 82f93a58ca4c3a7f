"""Scores against labels, and the distribution of scores.

Every report starts from counts that Spark combines before a shuffle of at most one
row per class pair and partition; what follows works on those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions.measures import share
from foliosift.functions.scores import clip_score, is_educational, score_class
from foliosift.functions.text import preview
from foliosift.session import materialise


def corpus_size(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.length(text_col).cast("bigint")), F.lit(0)).alias("characters"),
    )


def educational_ratio(scored: DataFrame) -> DataFrame:
    positive, total = F.count_if("is_educational"), F.count(F.lit(1))
    return scored.agg(
        positive.alias("educational"),
        total.alias("total"),
        (100.0 * share(positive, total)).alias("percent"),
    )


def score_histogram(
    scored: DataFrame, score_col: str = "score", bins: int = 10, width: int = 20
) -> DataFrame:
    """Equal bins over 0 to 4 with edges, counts and bar lengths; the last bin is closed.

    The counts are one row of conditional counts turned into rows, so empty bins appear
    without a join.
    """
    step = (values.SCORE_MAX - values.SCORE_MIN) / bins
    edges = [values.SCORE_MIN + step * i for i in range(bins + 1)]
    clipped = scored.select(clip_score(F.col(score_col)).alias("s"))
    below = [F.count_if(F.col("s") < edge).alias(f"b{i}") for i, edge in enumerate(edges[1:-1], 1)]
    counted = clipped.agg(*below, F.count("s").alias(f"b{bins}"))
    rows = [
        F.struct(
            F.lit(i + 1).alias("bin"),
            F.lit(edges[i]).alias("bin_start"),
            F.lit(edges[i + 1]).alias("bin_end"),
            (F.col(f"b{i + 1}") - (F.col(f"b{i}") if i else F.lit(0))).alias("documents"),
        )
        for i in range(bins)
    ]
    table = F.array(*rows)
    top = F.array_max(F.transform(table, lambda r: r["documents"]))
    per_star = top / F.lit(float(width))
    return (
        counted.select(table.alias("t"), per_star.alias("per_star"))
        .select("per_star", F.inline("t"))
        .select(
            "bin", "bin_start", "bin_end", "documents",
            F.floor(share(F.col("documents"), F.col("per_star"))).cast("int").alias("stars"),
        )
    )


def class_pairs(
    df: DataFrame, actual: Column, predicted: Column, labels: Sequence[int]
) -> DataFrame:
    """One row per pair of labels with its count, zeros included."""
    seen = df.select(actual.alias("a"), predicted.alias("p"))
    cells = [(a, p) for a in labels for p in labels]
    counted = seen.agg(
        *[
            F.count_if((F.col("a") == a) & (F.col("p") == p)).alias(f"c{i}")
            for i, (a, p) in enumerate(cells)
        ]
    )
    rows = [
        F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n")
        )
        for i, (a, p) in enumerate(cells)
    ]
    return counted.select(F.inline(F.array(*rows)))


def graded_pairs(df: DataFrame, score: str = "score", truth: str = "truth") -> DataFrame:
    """Class pairs 0 to 4, both sides rounded and clipped."""
    return class_pairs(df, score_class(F.col(truth)), score_class(F.col(score)), values.SCORE_CLASSES)


def binary_pairs(
    df: DataFrame,
    score: str = "score",
    truth: str = "truth",
    threshold: float = values.EDUCATIONAL_THRESHOLD,
) -> DataFrame:
    """Class pairs 0/1, both sides cut at the threshold."""
    actual = is_educational(F.col(truth), threshold).cast("int")
    predicted = is_educational(F.col(score), threshold).cast("int")
    return class_pairs(df, actual, predicted, (0, 1))


def confusion_matrix(pairs: DataFrame, labels: Sequence[int]) -> DataFrame:
    """One row per actual label, one ``pred_<label>`` column per predicted label."""
    return pairs.groupBy("actual").agg(
        *[F.sum(F.when(F.col("predicted") == p, F.col("n")).otherwise(0)).alias(f"pred_{p}") for p in labels]
    )


def classification_report(pairs: DataFrame, labels: Sequence[int]) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages.

    All sums are one row, from which the report's rows are laid out: the scores behind
    ``pairs`` are computed once.
    """
    n, metrics = F.col("n"), ("precision", "recall", "f1")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    actual, predicted = F.col("actual"), F.col("predicted")
    sums = pairs.agg(
        *[total((actual == x) & (predicted == x)).alias(f"hits_{x}") for x in labels],
        *[total(actual == x).alias(f"support_{x}") for x in labels],
        *[total(predicted == x).alias(f"predicted_{x}") for x in labels],
    )
    every = F.array(*[_label_row(x) for x in labels])
    table = sums.select(
        F.transform(
            every,
            lambda r: r.withField(
                "f1", share(2 * r["precision"] * r["recall"], r["precision"] + r["recall"])
            ),
        ).alias("classes")
    )

    def over_classes(term) -> Column:
        return F.aggregate("classes", F.lit(0.0), lambda acc, r: acc + term(r))

    support = F.aggregate("classes", F.lit(0).cast("bigint"), lambda acc, r: acc + r["support"])
    hits = F.aggregate("classes", F.lit(0).cast("bigint"), lambda acc, r: acc + r["hits"])
    size = F.lit(float(len(labels)))
    accuracy = share(hits, support)
    weighted = [
        share(over_classes(lambda r, m=m: r[m] * r["support"]), support).alias(m) for m in metrics
    ]
    summaries = F.array(
        F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(m) for m in metrics], support.alias("support")),
        F.struct(
            F.lit("macro avg").alias("label"),
            *[(over_classes(lambda r, m=m: r[m]) / size).alias(m) for m in metrics],
            support.alias("support"),
        ),
        F.struct(F.lit("weighted avg").alias("label"), *weighted, support.alias("support")),
    )
    classes = F.transform(
        "classes", lambda r: F.struct(r["label"].alias("label"), *[r[m].alias(m) for m in metrics], r["support"].alias("support"))
    )
    return table.select(F.inline(F.concat(classes, summaries)))


def _label_row(label: int) -> Column:
    hits, support = F.col(f"hits_{label}"), F.col(f"support_{label}")
    return F.struct(
        F.lit(str(label)).alias("label"),
        hits.alias("hits"),
        support.alias("support"),
        share(hits, F.col(f"predicted_{label}")).alias("precision"),
        share(hits, support).alias("recall"),
    )


def key_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 of the positive class and accuracy, four decimals."""
    a, p, n = F.col("actual"), F.col("predicted"), F.col("n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    sums = pairs.agg(
        total((a == 1) & (p == 1)).alias("tp"),
        total(p == 1).alias("pp"),
        total(a == 1).alias("ap"),
        total(a == p).alias("ok"),
        F.sum(n).alias("n"),
    )
    one_row = sums.select(
        share(F.col("tp"), F.col("pp")).alias("Precision"),
        share(F.col("tp"), F.col("ap")).alias("Recall"),
        share(2 * F.col("tp"), F.col("pp") + F.col("ap")).alias("F1-score"),
        share(F.col("ok"), F.col("n")).alias("Accuracy"),
    )
    long = one_row.unpivot([], ["Precision", "Recall", "F1-score", "Accuracy"], "metric", "value")
    return long.withColumn("value", F.round("value", 4))


def loss_and_accuracy(df: DataFrame, loss: Column, predicted: Column, label: Column) -> DataFrame:
    return df.agg(
        F.avg(loss).alias("mean_loss"),
        (100.0 * F.avg((predicted == label).cast("int"))).alias("accuracy"),
    )


def extreme_examples(
    scored: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text", length: int = 200
) -> DataFrame:
    """The ``n`` highest and ``n`` lowest scores with a preview of the text.

    Rows without a usable score (null or NaN) take no part, as in classes and bins. Ids must be
    unique. Scores are computed once and stored with the ids and the previews; two top-k over
    the narrow columns name at most ``2 * n`` rows, and only these look up their previews.
    """
    usable = scored.where(F.col("score").isNotNull() & ~F.isnan("score"))
    narrow = materialise(
        usable.select(
            id_col, "score", clip_score(F.col("score")).alias("clipped_score"), "is_educational",
            preview(F.col(text_col), length).alias("preview"),
        ),
        "scores",
    )
    shown, narrow = narrow.select(id_col, "preview"), narrow.drop("preview")
    high = narrow.orderBy(F.col("score").desc(), F.col(id_col)).limit(n)
    low = narrow.orderBy(F.col("score").asc(), F.col(id_col).desc()).limit(n)
    picked = high.withColumn("side", F.lit("high")).unionByName(low.withColumn("side", F.lit("low")))
    found = shown.join(F.broadcast(picked), id_col)  # 2 * n rows
    is_high = F.col("side") == "high"
    return found.select(id_col, "score", "clipped_score", "is_educational", "preview", "side").orderBy(
        "side",
        F.when(is_high, -F.col("score")).otherwise(F.col("score")),
        F.when(is_high, F.col(id_col)),
        F.col(id_col).desc(),
    )


def count_unscored(df: DataFrame, score: str = "score", truth: str = "truth") -> DataFrame:
    """One row: all rows and those that no confusion matrix can hold (no score or no truth)."""
    missing = score_class(F.col(score)).isNull() | score_class(F.col(truth)).isNull()
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("unscored"))
