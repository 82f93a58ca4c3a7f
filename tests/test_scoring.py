import json

import pytest
from pyspark.sql import functions as F

from foliosift.functions import annotations as A
from foliosift.functions import scores
from foliosift.operators import annotate, evaluate, joins, scoring
from foliosift.values import SCORE_CLASSES


def keyword_model():
    """A model factory; nested, so that it travels to the workers by value."""

    def make():
        import numpy as np

        def predict(texts):
            return np.array([(len(t) % 100) / 100.0 + (3.0 if "learn" in t else 0.0) for t in texts])

        return predict

    return make


def test_batch_scorer_gives_one_score_per_text(texts):
    df = texts(["learn ａ", "short", "", "learn b" * 20])
    scored = scoring.score_texts(df, scoring.BatchScorer(keyword_model(), batch_size=2)).orderBy("doc_id").collect()
    assert [round(r.score, 2) for r in scored] == [3.07, 0.05, 0.0, 3.4]
    assert [r.is_educational for r in scored] == [True, False, False, True]
    assert scoring.score_texts(texts([]), scoring.BatchScorer(keyword_model())).count() == 0


def test_missing_backend_is_an_error_when_the_plan_is_built(texts):
    with pytest.raises(ValueError):
        scoring.score_texts(texts(["a"]), None)
    with pytest.raises(ValueError):
        scoring.BatchScorer(None)
    with pytest.raises(ValueError):
        annotate.CallableAnnotator(None)


def test_ml_scorer_learns_a_word(texts):
    rows = ["good book about science"] * 10 + ["spam spam offer"] * 10
    df = texts(rows).withColumn("quality", (F.col("doc_id") < 10).cast("int"))
    scorer = scoring.MlScorer.fit(df, features=256)
    got = scoring.score_texts(df, scorer).groupBy("quality").agg(F.avg("score").alias("s")).collect()
    by = {r.quality: r.s for r in got}
    assert by[1] > 2.5 > by[0]


# --- Evaluation: 30 rows, truth 3.5 / 1.5 / 0.5 -----------------------------------------------


@pytest.fixture
def scored(spark):
    pairs = [(3.5, 3.2), (1.5, 2.6), (0.5, 0.4)] * 10
    return spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(pairs)], "doc_id bigint, truth double, score double")


def test_confusion_and_reports(scored):
    graded = evaluate.graded_pairs(scored)
    matrix = {r.actual: [r[f"pred_{c}"] for c in SCORE_CLASSES] for r in evaluate.confusion_matrix(graded, SCORE_CLASSES).collect()}
    # 3.5 and 0.5 round to even: 4 and 0; 1.5 to 2.
    assert matrix == {0: [10, 0, 0, 0, 0], 1: [0] * 5, 2: [0, 0, 0, 10, 0], 3: [0] * 5, 4: [0, 0, 0, 10, 0]}
    report = {r.label: r for r in evaluate.classification_report(graded, SCORE_CLASSES).collect()}
    assert report["0"].f1 == 1.0 and report["3"].precision == 0.0 and report["1"].support == 0
    assert report["accuracy"].precision == pytest.approx(1 / 3)
    assert report["macro avg"].recall == pytest.approx(0.2)
    assert report["weighted avg"].recall == pytest.approx(1 / 3)
    metrics = dict(tuple(r) for r in evaluate.key_metrics(evaluate.binary_pairs(scored)).collect())
    assert metrics == {"Precision": 0.5, "Recall": 1.0, "F1-score": 0.6667, "Accuracy": 0.6667}


def test_histogram_edges_and_stars(spark):
    rows = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.4, 1.2, 4.0, 9.0, 3.6]], "score double")
    bins = evaluate.score_histogram(rows).orderBy("bin").collect()
    # 3 * 0.4 is a little more than 1.2, so 1.2 falls below that edge.
    assert [r.documents for r in bins] == [2, 1, 1, 0, 0, 0, 0, 0, 0, 3]
    assert [r.stars for r in bins] == [13, 6, 6, 0, 0, 0, 0, 0, 0, 20]
    empty = evaluate.score_histogram(rows.where("score > 100")).collect()
    assert sum(r.documents + r.stars for r in empty) == 0


def test_extremes_and_sizes(scored):
    df = scored.withColumn("text", F.lit("abc")).withColumn("is_educational", F.col("score") >= 2.5)
    got = evaluate.extreme_examples(df).collect()
    assert [(r.side, r.doc_id) for r in got] == [("high", 0), ("high", 3), ("high", 6), ("low", 29), ("low", 26), ("low", 23)]
    odd = df.withColumn("score", F.when(F.col("doc_id") == 0, float("nan")).when(F.col("doc_id") == 29, None).otherwise(F.col("score")))
    assert [r.doc_id for r in evaluate.extreme_examples(odd).collect()] == [3, 6, 9, 26, 23, 20]
    assert evaluate.corpus_size(df).first().characters == 90
    assert evaluate.educational_ratio(df).first().educational == 20


# --- Annotations -------------------------------------------------------------------------------


def check(spark, task, responses):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i int, r string")
    return [r.x for r in df.orderBy("i").select(A.annotation(F.col("r"), task).alias("x")).collect()]


def test_annotation_records(spark):
    good = {"intent": "a", "knowledge": "b", "difficulty": "easy"}
    got = check(spark, A.DIFFICULTY, [
        json.dumps(good), json.dumps(good | {"difficulty": "odd"}), json.dumps(good)[:-3], "", None,
        "[1]", json.dumps({"intent": "a", "difficulty": "easy"}), json.dumps(good)[:-1], json.dumps(good) + " extra",
        json.dumps(good) + json.dumps(good), "null",
    ])
    assert got[0].asDict() == good | {"error": None}
    assert all(r.error == "Failed to get difficulty" and r.intent is None for r in got[1:])


def test_tags_must_all_be_known(spark):
    got = check(spark, A.CLASSIFICATION, [
        '{"primary_tag": "Math", "other_tags": []}',
        '{"primary_tag": "Math", "other_tags": ["Editing", "Chat"]}',
        '{"primary_tag": "Math", "other_tags": [null]}',
        '{"primary_tag": "Math"}',
    ])
    assert [r.error is None for r in got] == [True, False, False, False]


def test_prompt_keeps_braces(texts):
    prompt = texts(["use {input} and {x}"]).select(A.build_prompt(F.col("text"), A.QUALITY)).first()[0]
    assert "use {input} and {x}" in prompt


def test_callable_annotator_retries_and_never_ends_the_run(texts):
    def client():
        calls = {}

        def call(prompt, schema, **options):
            assert options["top_k"] == 64
            calls[prompt] = calls.get(prompt, 0) + 1
            if "never" in prompt or ("second" in prompt and calls[prompt] < 2):
                raise RuntimeError
            if "quality" in schema["properties"]:
                return json.dumps({"explanation": "x", "quality": "good"})
            return "not json"

        return call

    annotated = annotate.CallableAnnotator(client, attempts=2).annotate(texts(["never", "second", "ok"]))
    got = annotated.orderBy("doc_id").collect()
    assert [r.quality_rating.quality for r in got] == [None, "good", "good"]
    assert [r.classification.error for r in got] == ["Failed to get classification"] * 3


def test_alignment(texts):
    left, right = texts(["a", "b", "c"]), texts(["a", "b"]).withColumn("doc_id", F.col("doc_id") + 1)
    got = {tuple(r) for r in joins.alignment_audit(left, right).collect()}
    assert got == {(0, "right")}
    with pytest.raises(ValueError):
        joins.require_aligned(left, right)
    joins.require_aligned(left, left)


def test_lookup_with_a_hot_key(spark):
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"), F.lit(0).alias("n"))
    source = spark.createDataFrame([(1, 10, 0), (1, 99, 1), (2, 20, 2)], "id bigint, value int, pos int")
    got = joins.original_values(rows, source, position="pos")
    assert got.count() == 300
    assert got.where("id = 1").agg(F.min("original_value"), F.max("original_value"), F.count("*")).first()[:] == (10, 10, 101)
    assert got.where("id = 2").first().original_value == 20


def test_lookup_spreads_null_keys_and_copes_with_no_rows(spark):
    source = spark.createDataFrame([(1, 10)], "id bigint, value int")
    rows = spark.range(200).select(F.when(F.col("id") == 0, 1).cast("bigint").alias("id"), F.col("id").alias("n"))
    got = joins.original_values(rows, source)
    assert got.count() == 200 and got.where("original_value = 10").count() == 1
    assert joins.original_values(rows.where("n < 0"), source).count() == 0


def test_best_of_several_answers(spark):
    good, wrong = '{"explanation": "a", "quality": "good"}', '{"explanation": "z", "quality": "none"}'
    rows = [(1, "quality", good, 1), (1, "quality", wrong, 2), (1, "quality", "~", 3), (2, "quality", good, 1), (2, "quality", good.replace('"a"', '"b"'), 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, task string, response string, at int")
    got = {r.doc_id: r.quality for r in joins.pivot_responses(df, ["doc_id"], order="at").collect()}
    assert got[1] == good and got[2] == rows[4][2]


def test_rows_without_score_or_truth_are_counted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None), (float("nan"), 1.0)], "score double, truth double")
    assert tuple(evaluate.count_unscored(df).first()) == (4, 3)


def test_no_score_is_in_no_class_and_no_bin(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (9.0,), (-1.0,)], "score double")
    graded = [tuple(r) for r in df.select(scores.clip_score(F.col("score")), scores.score_class(F.col("score"))).collect()]
    assert graded == [(None, None), (None, None), (4.0, 4), (0.0, 0)]
    assert evaluate.score_histogram(df).agg(F.sum("documents")).first()[0] == 2
