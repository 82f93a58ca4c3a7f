import json

import pytest
from pyspark.sql import functions as F

from foliosift.operators import annotate, rules, scoring
from foliosift.plans.curation import curate

TEXT = (
    "{}の市場では、朝早くから新鮮な野菜や魚が並びます。地元の人だけでなく、遠くから来る料理人も多く、"
    "店主との会話を楽しみながら品物を選んでいきます。昼前にはほとんどの店が片付けを始めます。"
)


def test_whole_run_on_japanese_texts(spark, texts, tmp_path):
    rows = [TEXT.format("北町"), TEXT.format("北町"), "English text only, so it is out.", "短い", "<p>" + TEXT.format("南の港町と西の山村") + "</p>"]
    records = [(0, "quality", json.dumps({"explanation": "ok", "quality": "good"})), (0, "difficulty", "{broken")]
    responses = spark.createDataFrame(records, "doc_id bigint, task string, response string")
    out = str(tmp_path / "out")
    result = curate(
        texts(rows), rules.default_rules(), scoring.LexicalScorer(), annotate.TableAnnotator(responses), out
    )
    assert {r.doc_id for r in result.texts.collect()} == {0, 4}
    reasons = {tuple(r) for r in result.reasons.collect()}
    assert reasons == {("exact_duplicate", 1), ("language", 1), ("doc_length", 1)}
    assert result.outcomes.first().accepted == 2
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/final_texts").collect()]
    first = next(x for x in lines if "北町" in x["text"])
    assert list(first) == ["text", "is_educational", "score", "difficulty_rating", "quality_rating", "classification"]
    assert first["quality_rating"] == {"explanation": "ok", "quality": "good"}
    assert first["difficulty_rating"] == {"error": "Failed to get difficulty"}
    assert first["classification"] == {"error": "Failed to get classification"}
    assert spark.read.json(f"{out}/filtered_texts").columns == ["text"]
    assert spark.read.json(f"{out}/filtered_texts").count() == 2


def test_run_needs_input_and_backends(texts, tmp_path):
    with pytest.raises(ValueError, match="No texts"):
        curate(texts([]), rules.default_rules(), scoring.LexicalScorer(), object(), str(tmp_path / "a"))
    with pytest.raises(ValueError, match="needs a scorer"):
        curate(texts(["a"]).where(F.lit(True)), [], None, object(), str(tmp_path / "b"))


def test_nothing_survives(texts, tmp_path, monkeypatch):
    import os

    class Never:
        def annotate(self, df, text_col="text"):
            boom = F.udf(lambda _: 1 / 0)
            records = [F.struct(F.lit("x").alias("error")).alias(n) for n in ("difficulty_rating", "quality_rating", "classification")]
            return df.where(boom("text") != "").select("*", *records)

    shared = os.path.join(str(tmp_path), "shared")
    monkeypatch.setattr("foliosift.session.shared_dir", lambda _: shared)
    result = curate(texts(["too short"]), rules.default_rules(), scoring.LexicalScorer(), Never(), str(tmp_path / "out"))
    assert result.results.count() == 0 and result.outcomes.first().rejected == 1
    assert [n for n in os.listdir(shared) if n.startswith("cleaned")] == []
