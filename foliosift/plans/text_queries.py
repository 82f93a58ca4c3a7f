"""Queries of the text functions and the filter rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions import measures, text
from foliosift.operators import cascade, lexicons, rules
from foliosift.plans import check_sql as q
from foliosift.plans.registry import query
from foliosift.session import input_partitions, materialise, spread, table

# Parameters for the driver's Latin-script tables (no Japanese text in them).
PHRASES = ("Licensed under the", "Released under the MIT License.", "Apache License", "License")
LANGUAGES = ("en", "fr")


def documents(spark, sf):
    return spread(table(spark, sf, "documents", "doc_id", "text"), "doc_id", input_partitions(spark))


def pages(spark, sf):
    return spread(table(spark, sf, "pages", "page_id", "html"), "page_id", input_partitions(spark))


def driver_rules():
    """The full cascade with thresholds that bite on the driver tables."""
    return rules.default_rules(
        # flt1_accept_share checks the least share; here one function word is enough.
        language=rules.accept_language(LANGUAGES, min_share=0.0),
        remove_phrases=rules.remove_phrases(PHRASES),
        noun_heavy=rules.noun_heavy(0.9),
        single_char_run=rules.single_char_run(4),
        discrimination=rules.lexicon("discrimination", max_hits=2),
        special_tokens=rules.special_tokens(0.3),
    )


# --- Text functions ----------------------------------------------------------------


@query("prj1_strip_html", f"SELECT page_id, {q.strip_html('html')} AS text_clean FROM pages")
def _(spark, sf):
    return pages(spark, sf).select("page_id", text.strip_html(F.col("html")).alias("text_clean"))


# Site furniture, prose with comparison signs, and references, put before every page.
_HARD = (
    "<header>Site</header><head><title>Name</title></head><article>if a < b and c > d hold</article>"
    "<script>if (a<b) {}</script><STYLE type='x'>p{}</STYLE><!-- <p>note</p> -->"
    "caf&eacute; &#8217;&#x27; &amp;lt; R&D &nosuch; 1 <3<p>"
)
_HARD_TEXT = "Site Name if a < b and c > d hold café ’' &lt; R&D &nosuch; 1 <3"


@query("prj1_strip_html_hard", f"SELECT page_id, {q.quote(_HARD_TEXT)} AS start, {q.strip_html('html')} AS rest FROM pages")
def _(spark, sf):
    clean = text.strip_html(F.concat(F.lit(_HARD), "html"))
    return pages(spark, sf).select(
        "page_id", F.left(clean, F.lit(len(_HARD_TEXT))).alias("start"),
        F.trim(F.substring(clean, len(_HARD_TEXT) + 1, 1 << 30)).alias("rest"),
    )


# One of each state of a tokenizer, before every page.
_STATES = (
    """<a title="a > b">link</a> <a title='<b>' href=x>two</a><!-- <script> --> <a title=don't>one</a>"""
    """<SCRIPT src='>'>x</sCript\n><div <p>three</div><!-->four<!-- <p> --!><title>a <i> b</title></>"""
    "<![CDATA[x]]>&copy 2020 &check; &notin; &notit; &#8364 &#128; &ampamp; 1 <3, a < b<p>"
)
_STATES_TEXT = "link two one three four a <i> b © 2020 ✓ ∉ ¬it; € € &amp; 1 <3, a < b"


@query("prj1_strip_html_states", f"SELECT page_id, {q.quote(_STATES_TEXT)} AS start, {q.strip_html('html')} AS rest FROM pages")
def _(spark, sf):
    clean = text.strip_html(F.concat(F.lit(_STATES), "html"))
    return pages(spark, sf).select(
        "page_id", F.left(clean, F.lit(len(_STATES_TEXT))).alias("start"),
        F.trim(F.substring(clean, len(_STATES_TEXT) + 1, 1 << 30)).alias("rest"),
    )


def _nodes_sql(t):
    """Text between tags, each piece trimmed, joined by one space."""
    for name in ("script", "style"):
        t = rf"regexp_replace({t}, '(?is)<{name}\b[^<>]*>(?:.*?</{name}\s*>|.*)', chr(1), 'g')"
    t = rf"regexp_replace({t}, '(?s)<!--.*?-->|<[/!?]?[A-Za-z][^<>]*>', chr(1), 'g')"
    for entity, char in q.ENTITIES:
        t = f"replace({t}, {q.quote(entity)}, {q.quote(char)})"
    pieces = rf"list_transform(string_split({t}, chr(1)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))"
    return f"array_to_string(list_filter({pieces}, lambda x: x <> ''), ' ')"


@query("prj1_strip_html_parser", f"SELECT page_id, {_nodes_sql('html')} AS text_clean FROM pages")
def _(spark, sf):
    return pages(spark, sf).select(
        "page_id", text.strip_html_parsed(F.col("html")).alias("text_clean")
    )


def _phrases_sql(t):
    for phrase in PHRASES:
        t = f"replace({t}, {q.quote(phrase)}, '')"
    return t


@query("prj2_remove_phrases", f"SELECT doc_id, {_phrases_sql('text')} AS text_clean FROM documents")
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id", text.remove_phrases(F.col("text"), PHRASES).alias("text_clean")
    )


@query("prj3_strip_emojis", "SELECT doc_id, text AS text_clean FROM documents")
def _(spark, sf):
    # The tables hold no emoji: every sentence end gets some of each kind (joined, keycap, flag
    # of tags, clock, star, arrow), and stripping restores the text.
    some = "😀👨\u200d👩\u200d👧.🎉✨\ufe0f⭐⌚⏩▶\ufe0f⬛㊗\ufe0f🏴\U000e0067\U000e0062\U000e007f\ufe0f\u20e3"
    with_emoji = F.replace(F.col("text"), F.lit("."), F.lit(some))
    return documents(spark, sf).select("doc_id", text.strip_emojis(with_emoji).alias("text_clean"))


# One of every class of sequence, and symbols that are no emoji.
_EMOJI_ALL = "™‼▪↔ℹ◻©🏽👍🏽👩\u200d🚀👨\u200d👩\u200d👧\u200d👦🏳\ufe0f\u200d🌈🇯🇵1\ufe0f\u20e3#\u20e3❤\ufe0f☂🏴\U000e0067\U000e0062\U000e0073\U000e0063\U000e0074\U000e007f⏩🀄🫠"
_NO_EMOJI = "✓➀1#*•→★♔〜㊀🄰क्\u200dष"


@query("prj3_strip_emoji_sequences", f"SELECT doc_id, replace(text, '.', {q.quote('<' + _NO_EMOJI + '>')}) AS text_clean FROM documents")
def _(spark, sf):
    mixed = "<" + _EMOJI_ALL + _NO_EMOJI + _EMOJI_ALL + ">"
    with_emoji = F.replace(F.col("text"), F.lit("."), F.lit(mixed))
    return documents(spark, sf).select("doc_id", text.strip_emojis(with_emoji, keycaps=True).alias("text_clean"))


@query("prj4_normalize_nfkc", "SELECT doc_id, text AS text_clean FROM documents")
def _(spark, sf):
    # The tables are NFKC-stable: letters become full-width or ligatures and come back.
    wide = F.translate(F.replace(F.col("text"), F.lit("fi"), F.lit("ﬁ")), "aeiou", "ａｅｉｏｕ")
    wide = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(wide)
    widened = documents(spark, sf).select("doc_id", wide.alias("text"))
    mapped = widened.select("doc_id", text.map_full_width(F.col("text")).alias("text"))
    return mapped.select("doc_id", text.normalize_nfkc(F.col("text")).alias("text_clean"))


@query(
    "prj5_truncate_tokens",
    r"""SELECT doc_id, array_to_string(string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')[1:512], ' ')
        AS head FROM documents""",
)
def _(spark, sf):
    return documents(spark, sf).select("doc_id", text.truncate_tokens(F.col("text"), 512).alias("head"))


@query("prj6_preview", "SELECT doc_id, left(text, 100) || '...' AS preview FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", text.preview(F.col("text"), 100).alias("preview")
    )


# --- Filter rules --------------------------------------------------------------------


def _measured(name, measure, sql, rejects, sql_rejects):
    """A query with the rounded measure and the verdict of one rule."""

    @query(
        name,
        f"SELECT doc_id, round(({sql})::DOUBLE, 6) AS measure, {sql_rejects} AS rejected FROM "
        f"(SELECT *, {q.letter_tokens('text')} AS tk, {q.squeezed('text')} AS sq FROM documents)",
    )
    def _(spark, sf):
        measured = documents(spark, sf).select(
            "doc_id", measure(F.col("text")).cast("double").alias("m")
        )
        return measured.select(
            "doc_id", F.round("m", 6).alias("measure"), rejects(F.col("m")).alias("rejected")
        )


@query(
    "flt1_accept_language",
    f"""SELECT doc_id, {q.language('tk')} AS detected, coalesce({q.language('tk')} NOT IN {q.in_list(LANGUAGES)}, TRUE) AS rejected
        FROM (SELECT doc_id, {q.letter_tokens('text')} AS tk FROM documents)""",
)
def _(spark, sf):
    detected = documents(spark, sf).select(
        "doc_id", measures.detect_language(F.col("text")).alias("detected")
    )
    return detected.select("doc_id", "detected", F.coalesce(~F.col("detected").isin(*LANGUAGES), F.lit(True)).alias("rejected"))


@query(
    "flt1_accept_share",
    f"""WITH filled AS (SELECT doc_id, text || repeat(' z', (doc_id % 4 * length(text))::INTEGER) AS text FROM documents),
        tk AS (SELECT doc_id, {q.letter_tokens('text')} AS tk FROM filled),
        hits AS (SELECT doc_id, {q.language('tk')} AS detected, len(tk) AS n, {q.most_function_words('tk')} AS most FROM tk)
        SELECT doc_id, coalesce(detected NOT IN {q.in_list(LANGUAGES)}, TRUE) OR most < 0.02 * n AS rejected FROM hits""",
)
def _(spark, sf):
    # No, one, two and three words without meaning for every character of the text.
    filler = F.repeat(F.lit(" z"), (F.col("doc_id") % 4 * F.length("text")).cast("int"))
    filled = documents(spark, sf).select("doc_id", F.concat("text", filler).alias("text"))
    return filled.select("doc_id", rules.accept_language(LANGUAGES).rejects(F.col("text")).alias("rejected"))


@query(
    "flt1_accept_japanese",
    rf"""WITH mixed AS (SELECT doc_id, text || repeat('これは日本語の文です。', (length(text) * (doc_id % 3) // 10)::INTEGER) AS text
                         FROM documents)
         SELECT doc_id,
                round({q.ratio(rf"length(regexp_replace(text, '[^\p{{Hiragana}}\p{{Katakana}}\p{{Han}}]', '', 'g'))",
                               r"length(regexp_replace(text, '[^\p{L}]', '', 'g'))")}, 6) AS measure,
                NOT (regexp_matches(text, '[\p{{Hiragana}}\p{{Katakana}}]')
                     AND {q.ratio(rf"length(regexp_replace(text, '[^\p{{Hiragana}}\p{{Katakana}}\p{{Han}}]', '', 'g'))",
                                  r"length(regexp_replace(text, '[^\p{L}]', '', 'g'))")} >= 0.5) AS rejected
         FROM mixed""",
)
def _(spark, sf):
    # Japanese sentences in proportion to the document, none in every third one.
    times = (F.length("text") * (F.col("doc_id") % 3) / 10).cast("int")
    mixed = documents(spark, sf).select(
        "doc_id", F.concat("text", F.repeat(F.lit("これは日本語の文です。"), times)).alias("text")
    )
    return mixed.select(
        "doc_id",
        F.round(measures.japanese_share(F.col("text")), 6).alias("measure"),
        rules.accept_japanese(0.5).rejects(F.col("text")).alias("rejected"),
    )


_measured(
    "flt2_doc_length", F.length, "length(text)",
    lambda m: ~m.between(50, 20000), "length(text) NOT BETWEEN 50 AND 20000",
)
_measured(
    "flt3_short_lines", lambda c: measures.short_line_share(c, 40), q.short_lines("text", 40),
    lambda m: m > 0.5, f"{q.short_lines('text', 40)} > 0.5",
)
_measured(
    "flt4_noun_heavy", measures.content_word_share, q.content_share("tk"),
    lambda m: m > 0.9, f"{q.content_share('tk')} > 0.9",
)
_measured(
    "flt5_char_repetition", measures.char_repetition, q.duplicates(q.char_grams("text")),
    lambda m: m > 0.33, f"{q.duplicates(q.char_grams('text'))} > 0.33",
)
_measured(
    "flt6_word_repetition", measures.word_repetition, q.duplicates(q.word_grams("sq", 3)),
    lambda m: m > 0.40, f"{q.duplicates(q.word_grams('sq', 3))} > 0.40",
)


@query(
    "flt7_single_char_run",
    f"""SELECT doc_id, run >= 20 AS run_20, run >= 3 AS run_3
        FROM (SELECT doc_id, {q.longest_run('text')} AS run FROM documents)""",
)
def _(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        measures.has_single_char_run(F.col("text"), 20).alias("run_20"),
        measures.has_single_char_run(F.col("text"), 3).alias("run_3"),
    )


@query(
    "flt8_ending_ellipsis",
    f"""SELECT doc_id, round(m, 6) AS measure, m > 0.3 AS rejected
        FROM (SELECT doc_id, {q.ellipsis_lines("replace(text, 'e.', 'e...')")} AS m FROM documents)""",
)
def _(spark, sf):
    # No line of the tables ends in an ellipsis: sentences that end in "e." get one.
    measured = documents(spark, sf).select(
        "doc_id",
        measures.ellipsis_line_share(F.replace(F.col("text"), F.lit("e."), F.lit("e..."))).alias("m"),
    )
    return measured.select("doc_id", F.round("m", 6).alias("measure"), (F.col("m") > 0.3).alias("rejected"))


def _lexicon_query(number, name, terms, max_hits):
    hits = q.lexicon("text", terms)
    _measured(
        f"flt{number}_{name}", lambda c: measures.lexicon_hits(c, terms), hits,
        lambda m: m >= max_hits, f"{hits} >= {max_hits}",
    )


# The tables are invented prose: terms that occur in it stand in for the placeholder lists.
_lexicon_query(9, "ads", (*values.LEXICONS["ads"], "license", "example.com"), 1)
_lexicon_query(10, "adult", (*values.LEXICONS["adult"], "pathetic", "disgusting"), 2)
_lexicon_query(11, "violence", (*values.LEXICONS["violence"], "loser", "clown"), 2)


# A lexicon as a table: every word pair of the first five words of a benchmark text.
@query(
    "flt9_lexicon_table",
    r"""WITH head AS (SELECT [x FOR x IN regexp_extract_all(lower(text), '[\p{L}\p{N}]+')] AS w FROM benchmark),
        terms AS (SELECT DISTINCT 'pair' AS category, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS term FROM head WHERE len(w) >= 3
                  UNION SELECT DISTINCT 'word', w[1] FROM head WHERE len(w) >= 3),
        words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
        grams AS (SELECT doc_id, unnest(w) AS term FROM words
                  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words)
        SELECT doc_id, count(*) FILTER (category = 'pair')::BIGINT AS pairs, count(*) FILTER (category = 'word')::BIGINT AS words
        FROM documents LEFT JOIN (grams JOIN terms USING (term)) USING (doc_id) GROUP BY doc_id""",
)
def _(spark, sf):
    head = table(spark, sf, "benchmark", "text").select(measures.plain_words(F.col("text")).alias("w")).where("size(w) >= 3")
    lexicon = head.select(F.inline(F.array(
        F.struct(F.lit("word").alias("category"), F.col("w")[0].alias("term")),
        F.struct(F.lit("pair").alias("category"), F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("term")),
        F.struct(F.lit("pair").alias("category"), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]).alias("term")),
    )))
    hits = F.col("lexicon_hits")
    return rules.attach_word_hits(documents(spark, sf), lexicon).select(
        "doc_id", *[F.coalesce(hits[name], F.lit(0)).alias(f"{name}s") for name in ("pair", "word")]
    )


# Terms of a script without spaces, one within another, in text put behind every document.
JAPANESE_TERMS = (("広告", "ads"), ("広告をクリック", "ads"), ("クリック", "ads"), ("今すぐ購入", "ads"), ("購入", "shop"), ("購入する", "shop"))
JAPANESE_TEXT = "これは広告です。広告をクリックして今すぐ購入する。クリック   クリック"


@query(
    "flt9_lexicon_japanese",
    f"""WITH doc AS (SELECT doc_id, lower(text || '{JAPANESE_TEXT}' || text) AS t FROM documents)
        SELECT doc_id, len(regexp_extract_all(t, '広告をクリック|今すぐ購入|クリック|広告'))::BIGINT AS ads,
               len(regexp_extract_all(t, '購入する|購入'))::BIGINT AS shop,
               len(regexp_extract_all(t, 'click here now|click here|now'))::BIGINT AS more FROM doc""",
)
def _(spark, sf):
    rows = [*JAPANESE_TERMS, ("Click here now", "more"), ("click here", "more"), ("NOW", "more")]
    hits = lexicons.counter(spark.createDataFrame(rows, "term string, category string"))
    found = documents(spark, sf).select("doc_id", hits(F.concat("text", F.lit(JAPANESE_TEXT), "text")).alias("h"))
    return found.select("doc_id", *[F.coalesce(F.col("h")[c], F.lit(0)).alias(c) for c in ("ads", "shop", "more")])


# Every word of the documents of up to 12 letters is a term, behind a space. At one space the
# longest term counts, so that per category the spaces count before which any term stands.
@query(
    "flt9_lexicon_large",
    """WITH word AS (SELECT doc_id, unnest(string_split(lower(text), ' ')[2:]) AS w FROM documents),
       term AS (SELECT DISTINCT w AS term, 'c' || length(w) % 3 AS category FROM word WHERE length(w) BETWEEN 1 AND 12),
       place AS (SELECT doc_id, row_number() OVER () AS p, w FROM word),
       met AS (SELECT DISTINCT doc_id, p, category FROM place JOIN (SELECT p, unnest(range(1, 13)) AS n FROM place) USING (p)
               JOIN term ON term = substr(w, 1, n) AND length(w) >= n),
       counted AS (SELECT doc_id, category, count(*) AS n FROM met GROUP BY ALL)
       SELECT doc_id, coalesce(sum(n) FILTER (category = 'c0'), 0)::BIGINT AS c0, coalesce(sum(n) FILTER (category = 'c1'), 0)::BIGINT AS c1,
              coalesce(sum(n) FILTER (category = 'c2'), 0)::BIGINT AS c2
       FROM documents LEFT JOIN counted USING (doc_id) GROUP BY doc_id""",
)
def _(spark, sf):
    docs = documents(spark, sf)
    words = docs.select(F.explode(F.slice(F.split(F.lower("text"), " "), 2, 1 << 30)).alias("w")).where(
        F.length("w").between(1, 12)
    )
    # Stored, since the lexicon is read more than once.
    words = materialise(words.distinct(), "terms")
    terms = words.select(F.concat(F.lit("c"), (F.length("w") % 3).cast("string")).alias("category"), F.concat(F.lit(" "), "w").alias("term"))
    found = lexicons.attach_lexicon_hits(docs, terms)
    return found.select("doc_id", *[F.coalesce(F.col("lexicon_hits")[c], F.lit(0)).alias(c) for c in ("c0", "c1", "c2")])


@query(
    "flt12_discrimination",
    f"""SELECT toxic, ({q.lexicon('text', values.LEXICONS['discrimination'])} >= 2)::INTEGER AS rejected,
               count(*)::BIGINT AS documents
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
)
def _(spark, sf):
    # Every document is judged; toxic is null where there is no label.
    judged = documents(spark, sf).join(table(spark, sf, "labels", "doc_id", "toxic"), "doc_id", "left").select(
        "toxic",
        (measures.lexicon_hits(F.col("text"), values.LEXICONS["discrimination"]) >= 2).cast("int").alias("rejected"),
    )
    return judged.groupBy("toxic", "rejected").agg(F.count(F.lit(1)).alias("documents"))


_measured(
    "flt13_special_tokens", measures.special_share, q.special("text"),
    lambda m: m > 0.3, f"{q.special('text')} > 0.3",
)

# --- Cascade -----------------------------------------------------------------------


def cascade_ctes() -> str:
    """CTEs ending in ``judged(doc_id, text_clean, reject_reason)``."""
    lexicons = "".join(
        f"WHEN {q.lexicon('c', values.LEXICONS[name])} >= {hits} THEN '{name}' "
        for name, hits in (("ads", 3), ("adult", 3), ("violence", 3), ("discrimination", 2))
    )
    return rf"""
    raw AS (SELECT doc_id, text, coalesce({q.language('tk')} IN {q.in_list(LANGUAGES)}, FALSE) AS known
            FROM (SELECT doc_id, text, {q.letter_tokens('text')} AS tk FROM documents)),
    cleaned AS (SELECT doc_id, CASE WHEN known THEN
                  regexp_replace({_phrases_sql(q.strip_html('text'))}, '{values.EMOJI}', '', 'g') END AS c
                FROM raw),
    parts AS (SELECT *, {q.letter_tokens('c')} AS tk, {q.squeezed('c')} AS sq FROM cleaned),
    judged AS (SELECT doc_id, c AS text_clean, CASE
        WHEN c IS NULL THEN 'language'
        WHEN length(c) NOT BETWEEN 50 AND 20000 THEN 'doc_length'
        WHEN {q.short_lines('c')} > 0.5 THEN 'short_lines'
        WHEN {q.content_share('tk')} > 0.9 THEN 'noun_heavy'
        WHEN {q.duplicates(q.char_grams('c'))} > 0.33 THEN 'char_repetition'
        WHEN {q.duplicates(q.word_grams('sq', 3))} > 0.40 THEN 'word_repetition'
        WHEN {q.longest_run('c')} >= 4 THEN 'single_char_run'
        WHEN {q.ellipsis_lines('c')} > 0.3 THEN 'ending_ellipsis'
        {lexicons}
        WHEN {q.special('c')} > 0.3 THEN 'special_tokens' END AS reject_reason
        FROM parts)"""


def judged(spark, sf):
    return cascade.apply_cascade(documents(spark, sf), driver_rules())


@query(
    "flt14_apply_cascade",
    f"WITH {cascade_ctes()} SELECT doc_id, md5(text_clean) AS text_md5, reject_reason FROM judged",
)
def _(spark, sf):
    return judged(spark, sf).select("doc_id", F.md5("text_clean").alias("text_md5"), "reject_reason")


# The cheap head of the list, shared by the counting queries.
_SHORT = f"""SELECT doc_id, CASE WHEN length(text) NOT BETWEEN 50 AND 20000 THEN 'doc_length'
        WHEN {q.short_lines('text')} > 0.5 THEN 'short_lines'
        WHEN {q.special('text')} > 0.3 THEN 'special_tokens' END AS reject_reason FROM documents"""


def _short(spark, sf):
    return cascade.apply_cascade(
        table(spark, sf, "documents", "doc_id", "text"),
        [rules.doc_length(), rules.short_lines(), rules.special_tokens(0.3)],
    )


@query(
    "agg1_count_outcomes",
    f"""SELECT count(*) FILTER (reject_reason IS NULL)::BIGINT AS accepted, count(reject_reason)::BIGINT AS rejected,
               count(*)::BIGINT AS total FROM ({_SHORT})""",
)
def _(spark, sf):
    return cascade.count_outcomes(_short(spark, sf)).drop("pass_rate")


@query(
    "agg2_pass_rate",
    f"""SELECT round(100.0 * count(*) FILTER (reject_reason IS NULL) / count(*)::DOUBLE, 6)::DOUBLE AS pass_rate
        FROM ({_SHORT})""",
)
def _(spark, sf):
    return cascade.count_outcomes(_short(spark, sf)).select(F.round("pass_rate", 6).alias("pass_rate"))


@query(
    "agg3_count_reasons",
    f"""SELECT reject_reason, count(*)::BIGINT AS documents FROM ({_SHORT})
        WHERE reject_reason IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return cascade.count_reasons(_short(spark, sf))


@query(
    "agg3_count_reasons_full_list",
    f"""WITH {cascade_ctes()} SELECT reject_reason, count(*)::BIGINT AS documents FROM judged
        WHERE reject_reason IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    return cascade.count_reasons(judged(spark, sf))


@query(
    "udf1_custom_rule",
    r"""SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^0-9]', '', 'g')) > 20 THEN 'many_digits' END AS reject_reason,
               replace(text, chr(10), ' ') AS text_clean FROM documents""",
)
def _(spark, sf):
    custom = [
        rules.Rule("one_line", transform=lambda c: F.replace(c, F.lit("\n"), F.lit(" "))),
        rules.Rule("many_digits", lambda c: F.length(F.regexp_replace(c, "[^0-9]+", "")) > 20),
    ]
    return cascade.apply_cascade(table(spark, sf, "documents", "doc_id", "text"), custom).select(
        "doc_id", "reject_reason", "text_clean"
    )
