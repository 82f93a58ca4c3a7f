"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and
extra columns whose names clash with its own."""

import hashlib
import os
import textwrap

import pytest
from pyspark.sql import functions as F

from foliosift.llm import (
    exact_dedup,
    language_mixture,
    license_digest,
    line_windows,
    near_dup_forest,
    prefix_forest,
    pu_quality,
    sentencepiece_nbest,
    source_mix,
    url_filter,
)

CLASHING = "row, rank, salt, digest, whole, node, order, k1, k2, ids, score, found, part, key, removed, lines, size, target, text_sha256, decoded, lang_pred"
LONG = " ".join(f"word{i % 977} lies{i}" for i in range(60_000))
ROWS = [
    (None, None, None, None),
    (None, None, None, None),
    (1, "", "en", "a"),
    (2, None, "en", None),
    (3, "one two three four five six\nseven eight\nnine", None, "a"),
    (3, "one two three four five six\nseven eight\nnine", None, "a"),
    (3, "another text under the same id, of some words", "en", "b"),
    (5, "one two three four five six\nseven eight\nnine", "en", "b"),
    (6, LONG, "en", "b"),
    (7, "   \n \t", "de", "c"),
    (8, "12 34 -- 56", "de", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    for k, name in enumerate(CLASHING.split(", ")):
        rows = rows.withColumn(name, F.lit(k))
    return rows.withColumn("a.b", F.create_map(F.lit("x"), F.lit(1)))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where(F.lit(False))


def test_exact(odd, none):
    rows = exact_dedup.mark(odd).collect()
    assert len(rows) == len(ROWS)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text_sha256, []).append(r)
    for i, text, *_ in ROWS:
        group = by_text[hashlib.sha256((text or "").encode()).hexdigest()]
        assert sum(r.kept for r in group) == 1
        assert all(r.group_size == len(group) for r in group)
        largest = max((r.doc_id for r in group if r.doc_id is not None), default=None)
        assert all(r.keep_id == largest for r in group)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8]
    assert exact_dedup.mark(none).count() == exact_dedup.drop_copies(none).count() == 0


def test_line_windows(spark, odd, none):
    found = line_windows.remove_repeats(odd)
    assert found.columns == [*odd.columns, "_lines", "_removed"]
    rows = {(r.doc_id, r.text): r for r in found.select("doc_id", "text", "_lines", "_removed").collect()}
    assert rows[(5, "")]._removed == [0, 1, 2]  # id 3 has the first occurrence, twice the same row
    assert rows[(3, ROWS[4][1])]._removed == []
    assert rows[(None, None)]._lines == 0 and (2, None) in rows and (6, LONG) in rows
    assert line_windows.remove_repeats(none).count() == 0
    over = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny\na\nb\nc"), (4, "a\nb\nc\nd")]
    got = line_windows.remove_repeats(spark.createDataFrame(over, "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == {1: "a\nb\nc\nd", 2: "x\ny", 4: ""}


def test_url_filter(spark):
    urls = [
        (1, None), (None, "no scheme"), (2, "HTTP://WWW.Example.ORG/en/13?q#f"), (2, "http://example.org/es/x"),
        (3, "http://notexample.org/es/"), (4, "http://a.com"), (4, "http://a.com"), (5, "http://Ä.com/de/" + "x" * 50_000), (6, "://org/"),
    ]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    from foliosift.llm.queries import URL_RULES

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    expected = sorted(
        [
            (1, "", "", None, "allow"), (None, "", "", None, "allow"),
            (2, "www.example.org", "/en/13", "example.org/en/1", "block"), (2, "example.org", "/es/x", "example.org/es/", "block"),
            (3, "notexample.org", "/es/", "org/", "allow"), (4, "a.com", "", None, "allow"), (4, "a.com", "", None, "allow"),
            (5, "Ä.com", "/de/" + "x" * 50_000, "com/de/", "block"), (6, "org", "/", "org/", "allow"),
        ],
        key=repr,
    )
    for limit in (100, 0):  # broadcast and shuffled rules
        assert sorted(map(tuple, url_filter.judge(pages, rules, broadcast_rules=limit).collect()), key=repr) == expected
    assert url_filter.judge(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(urls)
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_language(odd, none):
    model = language_mixture.fit(odd.where("lang IS NOT NULL"))
    assert model.names == ["en"]  # the German rows have no letters
    found = language_mixture.identify(odd, model)
    assert found.columns == [*odd.columns, "_lang_pred", "_score", "languages", "shares"]
    for r in found.collect():
        has = any(c.isalpha() for c in r.text or "")
        assert (r._lang_pred in model.names) == has and 0 <= r._score <= 1
        assert abs(sum(r.shares) - has) < 1e-9
    empty = language_mixture.fit(none)
    assert empty.names == [] and language_mixture.identify(none, empty).count() == 0
    assert language_mixture.identify(odd, empty).where("_lang_pred <> 'und'").count() == 0


def test_near(odd, none):
    rows = near_dup_forest.classes(odd).collect()
    assert len(rows) == len(ROWS)
    by = {(r.doc_id, r.class_id, r.class_size, r.n_links, r.n_linked_texts) for r in rows}
    assert (5, 3, 3, 2, 0) in by and (6, 6, 1, 0, 0) in by and (None, None, 1, 0, 0) in by and (7, 7, 1, 0, 0) in by
    kept = near_dup_forest.keep_one(odd)
    assert kept.columns == odd.columns
    # Texts without words all stay; of the equal sets the smallest id, once.
    assert sorted((r.doc_id or -1 for r in kept.select("doc_id").collect())) == [-1, -1, 1, 2, 3, 3, 6, 7, 8]
    assert near_dup_forest.classes(none).count() == near_dup_forest.keep_one(none).count() == 0


def test_license(spark, odd, none):
    known = spark.createDataFrame([("A", "One two THREE four, five six; seven eight nine!"), (None, None)], "name string, text string")
    for limit in (10, 0):
        found = license_digest.scan(odd, known, broadcast_licenses=limit).collect()
        assert len(found) == len(ROWS)
        assert sorted(r.doc_id for r in found if r.license == "A") == [3, 3, 5]
        assert all(r.canonical_sha256 is None for r in found if r.doc_id in (None, 1, 2, 7))
    assert license_digest.scan(none, known).count() == 0
    same = spark.createDataFrame(
        [(1, "Copyright (c) 2001 Somebody\n\nThis Licence may be used."), (2, "© me\nTHIS LICENSE, may be used")], "doc_id bigint, text string"
    )
    assert same.select(license_digest.canonical(F.col("text"))).distinct().count() == 1


def test_license_files(spark):
    """Files as they come: title, copyright line, other widths, all on one line."""
    from foliosift.llm.known_licenses import TITLES, known

    bodies = {}
    for name, text in known():
        bodies.setdefault(name, text)
    line = "Copyright (c) 2020-2024, Jane Doe <jane@example.org>. All rights reserved."
    files = [(name, f"{title}\n\n{line}\n\n{bodies[name]}") for name, titles in TITLES.items() for title in titles if title not in ("BSD License",)]
    for name in (*TITLES, "Apache-2.0", "MPL-2.0"):
        files += [(name, f"{line}\n" + textwrap.fill(" ".join(bodies[name].split()), width)) for width in (45, 60, 72, 79, 100)] if name in TITLES else [(name, bodies[name])]
    apache = bodies["Apache-2.0"].split("APPENDIX:")[0]
    files += [("Apache-2.0", textwrap.fill(" ".join(apache.split()), width)) for width in (60, 72, 100)]
    files += [(name, f"{line} " + " ".join(bodies[name].split())) for name in TITLES]
    files += [(name, bodies[name]) for name in ("GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "CC0-1.0")]
    files += [("GPL-3", bodies["GPL-3"].replace("https://", "http://")), (None, line), (None, "MIT License")]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(files)], "doc_id bigint, text string")
    table = spark.createDataFrame(known(), "name string, text string")
    found = {r.doc_id: r.license for r in license_digest.scan(docs, table).collect()}
    assert [(files[i], found[i]) for i in found if found[i] != files[i][0]] == []


def test_license_notices(spark, odd, none):
    known = spark.createDataFrame(
        [("A", "One two THREE four, five six; seven eight nine!"), ("B", "seven eight"), ("C", "of ten percent is due"), (None, None)],
        "name string, text string",
    )
    found = license_digest.notices(odd, known).collect()
    assert len(found) == len(ROWS)
    assert sorted((r.doc_id, *r.licenses) for r in found if r.licenses) == [(3, "A", "B"), (3, "A", "B"), (5, "A", "B")]
    assert license_digest.notices(none, known).count() == 0
    texts = spark.createDataFrame(
        [
            (1, "Some code\n\n# One two\n#\n# Copyright (c) 2001 me\n# three, four five\n# six seven eight nine\nrest"),
            (2, "not one two three four five six seven eight nine"),
            (3, "of ten per\n * cent is due"),
            (4, "Seven,\r\nEIGHT\r\nof ten\nper cent\nis due"),
        ],
        "doc_id bigint, text string",
    )
    assert {r.doc_id: r.licenses for r in license_digest.notices(texts, known).collect()} == {1: ["A"], 2: [], 3: ["C"], 4: ["B", "C"]}


def test_license_notices_of_the_tables(spark):
    """Of the 262 documents that hold a notice as a line of a longer text, each is found."""
    from foliosift.llm.known_licenses import LICENSES

    path = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables not present")
    docs = spark.read.parquet(path).select("doc_id", "text")
    lines = {text: name for name, text in LICENSES if name.endswith("notice")}
    wanted = {r.doc_id: sorted({lines[x] for x in r.text.split("\n") if x in lines}) for r in docs.where("text IS NOT NULL").collect()}
    known = spark.createDataFrame(LICENSES, "name string, text string")
    found = {r.doc_id: r.licenses for r in license_digest.notices(docs, known).collect()}
    assert found == wanted and sum(map(bool, wanted.values())) == 262


def test_quality(odd, none):
    ids = odd.select("doc_id").where("doc_id > 2")
    model = pu_quality.fit(odd, ids, odd.select("doc_id"))
    found = pu_quality.score(odd, model)
    assert found.columns == [*odd.columns, "_score"]
    assert all(0 <= r._score <= 1 for r in found.collect()) and found.count() == len(ROWS)
    copies = odd.crossJoin(odd.sparkSession.range(50)).drop("id")
    again = pu_quality.fit(copies, ids, odd.select("doc_id"))  # copies of a row count once
    assert (again.weights == model.weights).all()
    blank = pu_quality.fit(none, none.select("doc_id"), none.select("doc_id"))
    assert {r._score for r in pu_quality.score(odd, blank).collect()} == {0.5}
    assert pu_quality.score(none, blank).count() == 0


def test_mix(odd, none):
    rows = source_mix.mix(odd, shard_words=64).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert source_mix.mix(none).count() == 0
    taken = source_mix.take(odd)
    assert taken.columns == odd.columns
    words = sum(len((r.text or "").split()) for r in taken.select("text").collect())
    assert words == sum(r.taken for r in source_mix.mix(odd).collect())
    assert source_mix.take(none).count() == 0


def test_sentencepiece(odd, none):
    vocabulary = sentencepiece_nbest.Vocabulary.load()
    found = sentencepiece_nbest.decode(sentencepiece_nbest.encode(odd, vocabulary), vocabulary, "_ids")
    rows = found.collect()
    assert len(rows) == len(ROWS) and found.columns[: len(odd.columns)] == odd.columns
    for r in rows:
        assert r._decoded == r.text and (r._ids is None) == (r.text is None)
    assert sentencepiece_nbest.encode(none, vocabulary).count() == 0


def test_forest(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.9, 0.1]), (2, [0.9, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
               (7, [None, 1.0]), (None, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (8, [])]
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").withColumn("v", F.lit(1)).withColumn("dim", F.lit(1))
    found = prefix_forest.nearest(rows, F.col("vec_id") % 100 == 0, k=2)
    assert [(r.query_id, r.rank, r.vec_id) for r in found.collect()] == [(0, 1, 1), (0, 2, 2)]
    many = rows.where("vec_id = 1").crossJoin(spark.range(40)).select("vec_id", "embedding").unionByName(rows.select("vec_id", "embedding"))
    found = prefix_forest.nearest(many, F.col("vec_id") % 100 == 0, k=3).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 1), (0, 3, 1)]
    assert prefix_forest.nearest(rows.limit(0), F.lit(True)).count() == 0


def test_blank_windows_stay(texts):
    """Lines of white space are left alone, whatever white space they hold."""
    blank = "a\n\t\r\n\r\n \x0b\x0c\nb"
    rows = line_windows.remove_repeats(texts([blank, blank.replace("a", "c").replace("b", "d")])).collect()
    assert all(r.removed == [] for r in rows)


def test_copyright_lines(texts):
    """Prose that only begins like a copyright statement is part of the text."""
    kept = ["Copyrighted works are discussed in this line, all of it prose", "Copyright law is a matter of long and careful study everywhere"]
    dropped = ["Copyright (c) 2020 A B", "Copyright 1999-2004 The Authors of this long and winding work", "© me", "Copyright Acme Inc.", "(c) 2001 x", "All rights reserved.", "Copyright [yyyy] [name of copyright owner]", "copyright by a b c d e f g"]
    forms = [r[0] for r in texts([f"{line}\nrest" for line in [*kept, *dropped]]).orderBy("doc_id").select(license_digest.canonical(F.col("text"))).collect()]
    assert all(f.startswith(" copyright") for f in forms[:2])
    assert forms[2:] == [" rest "] * len(dropped)
    doubled = texts(["licence licence licence organisation organisation"]).select(license_digest.canonical(F.col("text"))).first()[0]
    assert doubled == " license license license organization organization "


def test_taken_rows_do_not_depend_on_partitions(spark):
    """Rows of one id and text that differ in another column."""
    rows = [(1, "some words of one text " * 20, f"l{i}", "a") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = [sorted(map(tuple, source_mix.take(docs.repartition(n)).collect())) for n in (6, 3)]
    assert got[0] == got[1]
