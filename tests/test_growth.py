"""What would grow faster than its input: repeated searches of a text, jobs per wave, moved n-grams."""

import json
import re

import pytest
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import measures, scores
from foliosift.operators import annotate, evaluate, lexicons, rules


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def searches(df):
    return len(re.findall(r"regexp_(?:extract_all|replace)\(", plan(df)))


def test_emoji_class_is_searched_by_halves(spark):
    assert all(len(re.findall(r"\\x\{[0-9A-F]+\}(?:-\\x\{[0-9A-F]+\})?", c)) <= 4 for c in re.findall(r"\[[^\[\]&]*\]", values._BASE))
    points = set()
    for one in values.EMOJI_POINTS:
        ends = one.split("-")
        points |= set(range(int(ends[0], 16), int(ends[-1], 16) + 1))
    all_points = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343")
    text = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    assert {r.id for r in all_points.where(text.rlike(values._BASE)).collect()} == points
    kana = all_points.where(text.rlike(r"[\p{IsHiragana}\p{IsKatakana}]") != measures.has_kana(text))
    assert kana.isEmpty()


def test_a_text_is_searched_once_for_its_language(texts):
    df = texts(["the cat of the house", "le chat et la maison et", "und", "", None, "q z " * 90 + "the"])
    judged = df.select("doc_id", measures.detect_language(F.col("text")).alias("lang"), rules.accept_language(["en"]).rejects(F.col("text")).alias("no"))
    assert searches(judged.select("lang")) == searches(judged.select("no")) == 1
    got = [(r.lang, r.no) for r in judged.orderBy("doc_id").collect()]
    assert got == [("en", False), ("fr", True), ("de", True), (None, True), (None, True), ("en", True)]


def test_a_text_is_scored_once(texts):
    df = texts(["the cat of the house " * 9, "", None])
    # Letters, squeezed blanks and symbols, each once.
    assert searches(df.select(scores.lexical_score(F.col("text")).alias("s"))) == 3
    assert searches(df.select(measures.function_word_share(F.col("text")).alias("s"))) == 1


def test_extremes_are_not_scored_again(texts):
    df = texts([f"the cat of house {i}" for i in range(20)]).withColumn("score", scores.lexical_score(F.col("text")))
    found = evaluate.extreme_examples(df.withColumn("is_educational", F.col("score") > 2.5))
    assert searches(found) == 0 and found.count() == 6


def test_jobs_do_not_grow_with_waves(spark, texts, tmp_path, monkeypatch):
    jobs, ask = [], annotate.StoredAnnotator._ask
    monkeypatch.setattr(annotate.StoredAnnotator, "_ask", lambda self, df: jobs.append(1) or ask(self, df))
    client = annotate.CallableAnnotator(lambda: lambda prompt, schema, **options: json.dumps({"intent": "x"}))
    stored = annotate.StoredAnnotator(client, str(tmp_path / "store"), wave=2)
    assert stored.annotate(texts([f"text {i}" for i in range(30)])).count() == 30
    assert len(jobs) == 16 and spark.read.parquet(str(tmp_path / "store")).count() == 90


def test_only_ngrams_like_a_term_move(spark, texts):
    df = texts(["a big dog", "dog dog cat", None, ""])
    lexicon = spark.createDataFrame([("one", "dog"), ("two", "big dog"), ("two", "")], "category string, term string")
    found = rules.attach_word_hits(df, lexicon)
    assert "LeftSemi" in plan(found)
    assert {r.doc_id: r.lexicon_hits for r in found.collect()} == {0: {"one": 1, "two": 1}, 1: {"one": 2}, 2: None, 3: None}


@pytest.mark.parametrize("max_terms", [100, 2])
def test_occurrences_of_one_automaton_stay_in_their_task(spark, texts, max_terms):
    df = texts(["abcab ab", "cab", "", None])
    lexicon = spark.createDataFrame([("x", "ab"), ("x", "abc"), ("x", "ca"), ("y", "b"), ("y", "cab")], "category string, term string")
    found = lexicons.attach_lexicon_hits(df, lexicon, max_terms=max_terms)
    assert ("starts" in plan(found)) == (max_terms == 2)
    assert {r.doc_id: r.lexicon_hits for r in found.collect()} == {0: {"x": 3, "y": 3}, 1: {"x": 1, "y": 1}, 2: {}, 3: None}
