import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import measures as M
from foliosift.functions import scores, text

JA = "図書館では、毎週土曜日に子ども向けの読み聞かせ会が開かれています。参加は無料で、予約もいりません。"


def column(df, col):
    return [r[0] for r in df.orderBy("doc_id").select(col.alias("x")).collect()]


def test_strip_html_on_markup_and_plain_text(texts):
    df = texts(["<p>見出し</p><div>本文 &amp; 注</div>", "a  <b>b</b>\n<!-- x -->c", "no  markup", "<script>x<y</script>z", None])
    got = column(df, text.strip_html(F.col("text")))
    assert got == ["見出し 本文 & 注", "a b \n c", "no markup", "z", None]


def test_strip_html_parsed_decodes_everything(texts):
    df = texts(["<title>T</title><p>caf&eacute; &#8364;</p><style>p{}</style><i>x", None])
    assert column(df, text.strip_html_parsed(F.col("text"))) == ["T café € x", None]


def test_remove_phrases_is_sequential_in_list_order(texts):
    long_phrase = "最後までご覧いただきありがとうございます"
    df = texts([f"この記事では本を紹介。{long_phrase}。ご覧いただき、ありがとうございました。"])
    expected = f"この記事では本を紹介。{long_phrase}。ご覧いただき、ありがとうございました。"
    for phrase in values.BOILERPLATE_PHRASES:
        expected = expected.replace(phrase, "")
    assert column(df, text.remove_phrases(F.col("text"))) == [expected]


def test_strip_emojis_keeps_digits_and_letters(texts):
    assert column(texts(["1#😀a🎉✨ 🚀💯é"]), text.strip_emojis(F.col("text"))) == ["1#a é"]


def test_stable_blocks_are_unchanged_by_nfkc():
    for group in text.NFKC_STABLE_RANGES:
        for low, high in group:
            for code in range(low, high + 1):
                char = chr(code)
                assert unicodedata.normalize("NFKC", char) == char
                assert unicodedata.combining(char) == 0
                # Does not merge with a preceding letter.
                for before in ("a", "か", "가", "К"):
                    assert unicodedata.normalize("NFKC", before + char) == before + char


def test_normalize_nfkc_equals_unicodedata(texts):
    rng = random.Random(7)
    pool = "abcＡＢＣ１２３　ﾊﾟｶﾞ㍻①ﬁéé゛がが髙﨑ｶ﹅Ⅷ½ K " + "".join(chr(c) for c in range(0x80, 0x250))
    rows = ["".join(rng.choice(pool) for _ in range(30)) for _ in range(200)] + ["plain", JA, "", None]
    df = texts(rows).withColumn("text", text.map_full_width(F.col("text")))
    expected = [None if r is None else unicodedata.normalize("NFKC", r) for r in rows]
    assert column(df, text.normalize_nfkc(F.col("text"))) == expected


def test_truncate_and_preview(texts):
    df = texts(["  a b\n c d ", "one", ""])
    assert column(df, text.truncate_tokens(F.col("text"), 3)) == ["a b c", "one", ""]
    assert column(df, text.preview(F.col("text"), 2)) == ["  ...", "on...", "..."]


# --- Measures against plain Python -------------------------------------------------------


def py_duplicates(grams):
    return 1 - len(set(grams)) / len(grams) if grams else 0.0


def test_repetition_measures_equal_brute_force(texts):
    rng = random.Random(3)
    rows = ["".join(rng.choice("ab \n𠮷") for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    df = texts(rows)
    chars = [py_duplicates([r[i : i + 3] for i in range(len(r) - 2)]) for r in rows]
    words = []
    for r in rows:
        w = r.lower().split()
        words.append(py_duplicates([tuple(w[i : i + 2]) for i in range(len(w) - 1)]))
    assert column(df, M.char_repetition(F.col("text"), 3)) == pytest.approx(chars)
    assert column(df, M.word_repetition(F.col("text"), 2)) == pytest.approx(words)


def test_line_measures_equal_brute_force(texts):
    rng = random.Random(5)
    parts = ["", " ", "ab", "abcde", "long line here", "end...", "so…", "x ... ", "\t", "𠮷", "abcd𠮷𠮷", "𠮷 …"]
    rows = ["\n".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(150)]
    short, ending = [], []
    for r in rows:
        lines = r.split("\n")
        short.append(sum(len(x) < 5 for x in lines) / len(lines))
        full = [x for x in lines if x.strip()]
        hits = sum(x.rstrip().endswith(("...", "…")) for x in full)
        ending.append(hits / len(full) if full else 0.0)
    df = texts(rows)
    assert column(df, M.short_line_share(F.col("text"), 5)) == pytest.approx(short)
    assert column(df, M.ellipsis_line_share(F.col("text"))) == pytest.approx(ending)


def test_language_and_script(texts):
    df = texts(["the cat and the dog", "der Hund und die Katze ist", "el perro y los gatos con", "le chat et les chiens", "xyz"])
    assert column(df, M.detect_language(F.col("text"))) == ["en", "de", "es", "fr", None]
    df = texts([JA, "English only", "漢字漢字"])
    assert [round(x, 1) for x in column(df, M.japanese_share(F.col("text")))] == [1.0, 0.0, 1.0]
    assert column(df, M.has_kana(F.col("text"))) == [True, False, False]


def test_noun_lists_stand_out(texts):
    nouns = "東京都 大阪府 名古屋市 福岡県 札幌市 仙台市 広島県 京都府"
    share = column(texts([JA, nouns + "の", "one two"]), M.content_word_share(F.col("text")))
    assert share[0] < 0.8 < share[1] and share[2] == 0.0


def test_runs_lexicon_and_symbols(texts):
    df = texts(["a" * 40, "ああああ", "aaa   aaa" + " " * 30, "Click HERE, click here. buy now!"])
    assert column(df, M.has_single_char_run(F.col("text"))) == [True, False, False, False]
    assert column(df, M.lexicon_hits(F.col("text"), ["click here", "buy now"])) == [0, 0, 0, 3]
    assert column(texts(["a!?#", "", "ab 1"]), M.special_share(F.col("text"))) == [0.75, 0.0, 0.0]


@settings(max_examples=8, deadline=None)
@given(raw=st.lists(st.floats(-3, 7, allow_nan=False), min_size=1, max_size=20))
def test_scores_clip_and_round_half_even(spark, raw):
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(raw)], "i int, s double")
    got = rows.orderBy("i").select(
        scores.clip_score(F.col("s")), scores.score_class(F.col("s")), scores.is_educational(F.col("s"))
    ).collect()
    for value, (clipped, grade, good) in zip(raw, got):
        assert clipped == min(max(value, 0.0), 4.0)
        assert grade == int(min(max(round(value), 0), 4))
        assert good == (value >= 2.5)


def test_markup_keeps_bodies_and_prose(spark):
    rows = [
        ("<header>Site</header><article>The body.</article><script>x</script><p>end</p>", "Site The body. end"),
        ("<p>if a < b and then c > d holds</p>", "if a < b and then c > d holds"),
        ("<style>a{}</style >one<head><title>t</title></head>two", "one t two"),
    ]
    df = spark.createDataFrame(rows, "html string, expected string")
    for r in df.select(text.strip_html(F.col("html")).alias("got"), "expected").collect():
        assert r.got == r.expected


def test_no_function_word_is_no_language(spark):
    df = spark.createDataFrame([("日本",), ("qqq zzz",)], "text string")
    assert {r[0] for r in df.select(M.detect_language(F.col("text"))).collect()} == {None}


def test_markup_scan_is_linear(spark):
    import time

    rows = [("a <3 " * 80_000,), ("<!-- " * 80_000,), ("<script> " * 45_000,), ("&a " * 130_000,)]
    df = spark.createDataFrame(rows, "html string").repartition(4)
    lengths = F.sum(F.length(text.strip_html(F.col("html"))))
    df.limit(0).select(lengths).collect()
    start = time.perf_counter()
    df.select(lengths).collect()
    assert time.perf_counter() - start < 8  # four texts of 400,000 characters, planning included


def test_character_references(texts):
    rows = ["caf&eacute; &#8217;&#x27; &amp;lt; R&D &nosuch; a&nbsp;b &#0; &#xD800; &hearts;"]
    assert column(texts(rows), text.strip_html(F.col("text"))) == ["café ’' &lt; R&D &nosuch; a b &#0; &#xD800; ♥"]


def test_emoji_of_all_kinds_go_and_indic_joiners_stay(texts):
    rows = ["क्‍ष|👨‍👩‍👧|⭐|1️⃣|⌚|▶️|🏴\U000e0067\U000e007f|㊗️|⬛"]
    assert column(texts(rows), text.strip_emojis(F.col("text"))) == ["क्‍ष|||1|||||"]
