"""DuckDB expressions for the text measures, written independently of the Spark ones."""

from __future__ import annotations

from foliosift import values
from foliosift.functions.measures import all_function_words


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


def ratio(part: str, whole: str) -> str:
    return f"coalesce(({part})::DOUBLE / nullif(({whole})::DOUBLE, 0), 0)"


def squeezed(t: str) -> str:
    return rf"trim(regexp_replace(lower({t}), '\s+', ' ', 'g'))"


def letter_tokens(t: str) -> str:
    return (
        rf"list_filter(string_split_regex(lower({t}), '[^\p{{L}}]+'), lambda tok: tok <> '')"
    )


def members(tokens: str, words) -> str:
    return f"len(list_filter({tokens}, lambda tok: tok IN {in_list(words)}))"


def language(tokens: str) -> str:
    """Argmax over the languages, ties to the last name; null without any hit."""
    scored = ", ".join(
        f"{{'n': {members(tokens, words)}, 'lang': {quote(code)}}}"
        for code, words in sorted(values.FUNCTION_WORDS.items())
    )
    return f"CASE WHEN list_max([{scored}]).n > 0 THEN list_max([{scored}]).lang END"


def most_function_words(tokens: str) -> str:
    return f"greatest({', '.join(members(tokens, words) for words in values.FUNCTION_WORDS.values())})"


def content_share(tokens: str, min_words: int = 10) -> str:
    hits = members(tokens, all_function_words())
    return f"CASE WHEN len({tokens}) >= {min_words} THEN 1 - {ratio(hits, f'len({tokens})')} ELSE 0 END"


def function_share(tokens: str) -> str:
    return ratio(members(tokens, all_function_words()), f"len({tokens})")


def short_lines(t: str, min_length: int = 5) -> str:
    lines = f"string_split({t}, chr(10))"
    return ratio(f"len(list_filter({lines}, lambda x: length(x) < {min_length}))", f"len({lines})")


def char_grams(t: str, n: int = 10) -> str:
    """All n-grams: non-overlapping cuts from each of the n offsets."""
    return (
        f"flatten(list_transform(range(0, {n}), "
        f"lambda o: regexp_extract_all(substring({t}, o + 1), '(?s).{{{n}}}')))"
    )


def word_grams(sq: str, n: int) -> str:
    w = f"string_split({sq}, ' ')"
    zipped = ", ".join([w] + [f"{w}[{i}:]" for i in range(2, n + 1)])
    parts = ", ' ', ".join(f"z[{i}]" for i in range(1, n + 1))
    return f"list_transform(list_zip({zipped}, true), lambda z: concat({parts}))"


def duplicates(grams: str) -> str:
    return f"CASE WHEN len({grams}) > 0 THEN 1 - len(list_distinct({grams}))::DOUBLE / len({grams}) ELSE 0 END"


def longest_run(t: str) -> str:
    """Length of the longest run of one non-space character, by walking the characters."""
    chars = f"string_split({t}, '')"
    return (
        f"list_reduce(list_transform({chars}, lambda c: {{'c': c, 'run': CASE WHEN regexp_matches(c, '\\S') THEN 1 ELSE 0 END, 'best': CASE WHEN regexp_matches(c, '\\S') THEN 1 ELSE 0 END}}), "
        "lambda a, b: {'c': b.c, "
        "'run': CASE WHEN b.run = 0 THEN 0 WHEN a.c = b.c THEN a.run + 1 ELSE 1 END, "
        "'best': greatest(a.best, CASE WHEN b.run = 0 THEN 0 WHEN a.c = b.c THEN a.run + 1 ELSE 1 END)}).best"
    )


def ellipsis_lines(t: str) -> str:
    lines = rf"list_filter(string_split({t}, chr(10)), lambda x: regexp_matches(x, '\S'))"
    ending = rf"len(list_filter({lines}, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$')))"
    return ratio(ending, f"len({lines})")


def lexicon(t: str, terms) -> str:
    pattern = "|".join(sorted((x.lower() for x in terms), key=lambda x: (-len(x), x)))
    return f"len(regexp_extract_all(lower({t}), {quote(pattern)}))"


def special(t: str) -> str:
    return ratio(rf"length(regexp_replace({t}, '[\p{{L}}\p{{N}}\s]', '', 'g'))", f"length({t})")


# Those of the test tables; the ampersand comes last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def strip_html(t: str) -> str:
    sql = t
    for name in values.DROPPED_ELEMENTS:
        sql = rf"regexp_replace({sql}, '(?is)<{name}\b[^<>]*>(?:.*?</{name}\s*>|.*)', ' ', 'g')"
    sql = rf"regexp_replace({sql}, '(?s)<!--(?:.*?-->|.*)|<[/!?]?[A-Za-z][^<>]*>', ' ', 'g')"
    for entity, char in ENTITIES:
        sql = f"replace({sql}, {quote(entity)}, {quote(char)})"
    return rf"trim(regexp_replace({sql}, '[ \t]+', ' ', 'g'))"


def score_cte(source: str = "documents", t: str = "text", keys: str = "doc_id") -> str:
    """CTEs ending in ``scored(keys, text, score)``."""
    return rf"""
    toks AS (SELECT {keys}, {t}, {letter_tokens(t)} AS tk, string_split({squeezed(t)}, ' ') AS w FROM {source}),
    scored AS (SELECT {keys}, {t}, 4 * least(1.0, greatest(0.0,
        0.35 * least(1.0, {function_share('tk')} / 0.25)
        + 0.25 * len(list_distinct(w))::DOUBLE / len(w)
        + 0.30 * least(1.0, length({t}) / 2000.0)
        + 0.10 * (1 - {special(t)}))) AS score FROM toks)"""


def clip(s: str) -> str:
    return f"greatest(0.0, least(4.0, {s}))"


def grade(s: str) -> str:
    return f"{clip(f'round_even({s}, 0)')}::INTEGER"


def minhash_ctes(source: str, doc: str = "doc_id", t: str = "text") -> str:
    """CTEs ``firsts, gram, sig, bands`` over a table of ``(doc_id, text)``."""
    n = values.SHINGLE_WORDS
    minima = ", ".join(
        f"min(({a} * x + {b}) % {values.MINHASH_PRIME}) AS m{i}"
        for i, (a, b) in enumerate(values.MINHASH_COEFFICIENTS)
    )
    rows = len(values.MINHASH_COEFFICIENTS) // values.MINHASH_BANDS
    bands = " UNION ALL ".join(
        f"SELECT {doc}, {b} AS band, concat_ws('-', "
        + ", ".join(f"m{b * rows + r}" for r in range(rows))
        + ") AS key FROM sig"
        for b in range(values.MINHASH_BANDS)
    )
    return rf"""
    firsts AS (SELECT min({doc}) AS {doc} FROM {source} GROUP BY md5({t})),
    sq AS (SELECT {doc}, {squeezed(t)} AS s FROM {source} SEMI JOIN firsts USING ({doc})),
    grams AS (SELECT {doc}, s, {word_grams('s', n)} AS g FROM sq),
    shingle AS (SELECT {doc}, unnest(CASE WHEN len(g) > 0 THEN g ELSE [s] END) AS v FROM grams),
    hashed AS (SELECT {doc}, ('0x' || substring(md5(v), 1, 7))::BIGINT AS x FROM shingle),
    sig AS MATERIALIZED (SELECT {doc}, {minima} FROM hashed GROUP BY {doc}),
    bands AS ({bands}),
    ranked AS (SELECT {doc}, band, key, min({doc}) OVER (PARTITION BY band, key) AS first_id FROM bands),
    near AS (SELECT DISTINCT {doc} FROM ranked WHERE first_id < {doc})"""
