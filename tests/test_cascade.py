import pytest
from pyspark.sql import functions as F

from foliosift.operators import cascade, rules
from foliosift.operators.rules import Rule

LONG = (
    "市の中央図書館は、毎週土曜日の午後に小さな読書会を開いています。参加者は一冊の本を選び、"
    "感じたことを自由に話し合います。初めての人でも気軽に加われる雰囲気が魅力です。"
)


def reasons(df):
    return [r[0] for r in df.orderBy("doc_id").select(cascade.REASON).collect()]


def test_sample_rows_have_the_intended_outcome(texts):
    rows = [
        LONG,
        LONG.replace("小さな", "　小さな　１２　"),
        "This text is written in English only and is long enough to pass the length rule.",
        f"<p>{LONG}</p>",
        "この記事では" + LONG + "最後までご覧いただきありがとうございます",
        LONG + "😀🎉",
        "髙島屋へ行きました。" + LONG,
        "短い",
        "あ" * 60,
        "重複 " * 60 + "です",
        None,
    ]
    judged = cascade.apply_cascade(texts(rows), rules.default_rules()).orderBy("doc_id")
    got = judged.collect()
    assert [r.reject_reason for r in got[:7]] == [None, None, "language", None, None, None, None]
    assert got[7].reject_reason == "doc_length"
    assert got[8].reject_reason is not None and got[9].reject_reason is not None
    assert got[10].reject_reason == "doc_length" or got[10].reject_reason == "language"
    assert got[3].text_clean == LONG and got[4].text_clean == LONG and got[5].text_clean == LONG
    assert "12" in got[1].text_clean and "　" not in got[1].text_clean
    assert got[6].text_clean.startswith("髙島屋")
    assert got[2].text_clean is None


@pytest.mark.parametrize(
    "rule, bad, good",
    [
        (rules.doc_length(5, 8), "abcd", "abcde"),
        (rules.doc_length(5, 8), "abcdefghi", "abcdefgh"),
        (rules.short_lines(), "a\nb\nlong enough", "a\nlong enough"),
        (rules.char_repetition(), "abcdefghij" * 5, "abcdefghijklmnopqrstuvwxyz"),
        (rules.word_repetition(), "one two three " * 5, "one two three four five six"),
        (rules.single_char_run(), "x" * 20, "x" * 19),
        (rules.ending_ellipsis(), "first...\nsecond", "first.\nsecond\nthird\nlast..."),
        (rules.lexicon("ads"), "buy now " * 3, "buy now " * 2),
        (rules.lexicon("adult", ["zz"], 1), "a ZZ", "a z z"),
        (rules.special_tokens(), "!!!!!abc", "!!abcdef"),
        (rules.noun_heavy(), "alpha beta gamma delta eps zeta eta theta iota kappa", "the cat is in the house and the dog was in the garden"),
    ],
)
def test_single_rules(texts, rule, bad, good):
    judged = cascade.apply_cascade(texts([bad, good]), [rule])
    assert reasons(judged) == [rule.name, None]


def test_first_failing_rule_in_list_order_wins(texts):
    df = texts(["xxxx"])
    a, b = Rule("a", lambda c: F.length(c) > 3), Rule("b", lambda c: c.startswith("x"))
    assert reasons(cascade.apply_cascade(df, [a, b])) == ["a"]
    assert reasons(cascade.apply_cascade(df, [b, a])) == ["b"]


def test_rule_needs_one_action():
    with pytest.raises(ValueError):
        Rule("none")
    with pytest.raises(ValueError):
        rules.default_rules(nonsense=rules.doc_length())


def test_lexicons_from_table(spark):
    table = spark.createDataFrame([("ads", "buy"), ("ads", "buy"), ("adult", "x")], "category string, term string")
    assert rules.lexicons_from_table(table) == {"ads": ["buy"], "adult": ["x"]}
    with pytest.raises(ValueError):
        rules.lexicons_from_table(table, max_terms=1)


def test_pluggable_parts(texts):
    shares = rules.noun_heavy(0.5, noun_share=lambda c: F.length(c) / 10.0)
    judged = cascade.apply_cascade(texts(["<b>caf&eacute;</b>", "<i>a longer one"]), [rules.strip_html(exact=True), shares])
    got = judged.orderBy("doc_id").collect()
    assert [(r.text_clean, r.reject_reason) for r in got] == [("café", None), ("a longer one", "noun_heavy")]


def test_counts(texts):
    judged = cascade.apply_cascade(texts(["abcdef", "a", "b", "!!!!!!"]), [rules.doc_length(5, 9), rules.special_tokens()])
    assert cascade.count_outcomes(judged).first().asDict() == {
        "accepted": 1, "rejected": 3, "total": 4, "pass_rate": 25.0
    }
    assert {tuple(r) for r in cascade.count_reasons(judged).collect()} == {("doc_length", 2), ("special_tokens", 1)}
    assert [r.text for r in cascade.accepted(judged).collect()] == ["abcdef"]


def test_empty_corpus(texts):
    judged = cascade.apply_cascade(texts([]), rules.default_rules())
    assert judged.count() == 0
    assert cascade.count_outcomes(judged).first().pass_rate == 0.0


def test_the_cascade_does_not_shuffle_and_runs_each_rule_once(texts):
    judged = cascade.apply_cascade(texts(["a"]), rules.default_rules())
    plan = cascade.accepted(judged)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("array_distinct") == 2


def test_rules_run_on_a_stream(spark, texts, tmp_path):
    texts([LONG, "短い"]).coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id bigint, text string").json(str(tmp_path / "in"))
    marked = stream.select("doc_id", rules.doc_length().rejects(F.col("text")).alias("bad"))
    query = marked.writeStream.format("memory").queryName("marked").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {tuple(r) for r in spark.table("marked").collect()} == {(0, False), (1, True)}


def test_words_of_a_table_as_a_rule(texts, spark):
    lexicon = spark.createDataFrame([("ads", "Buy Now"), ("ads", "sale"), ("ads", "sale"), ("mild", "now"), ("mild", " ")], "category string, term string")
    df = rules.attach_word_hits(texts(["Buy now! SALE, resale.", "nothing", None, "now"]), lexicon)
    got = {r.doc_id: r.lexicon_hits for r in df.collect()}
    assert got == {0: {"ads": 2, "mild": 1}, 1: None, 2: None, 3: {"mild": 1}}
    ads = Rule("ads", lambda c: F.coalesce(F.col("lexicon_hits")["ads"], F.lit(0)) >= 2)
    assert reasons(cascade.apply_cascade(df, [ads])) == ["ads", None, None, None]
    assert rules.attach_word_hits(texts(["a"]), lexicon.where("false")).first().lexicon_hits is None
