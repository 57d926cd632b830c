"""Nulls, empty and repeated rows, ties, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewmill.llm import (
    decontaminate, language_id, line_dedup, mixing, prefix_forest, repeated_spans, resampling, secret_scan, simhash, toxicity, url_filter,
)
from reviewmill.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97}" for i in range(6000))
ROWS = [
    (1, "one two three four five six seven", "en", "b", 33), (1, "one two three four five six seven", "en", "b", 33),
    (2, None, None, None, None), (3, "", "en", "a", 0), (None, "alpha beta gamma delta epsilon zeta", "en", None, 5),
    (None, None, None, None, None), (4, LONG, "de", "a", len(LONG)), (5, LONG, "de", "a", len(LONG)), (6, " \n\t ", "fr", "c", 4),
    (7, "İstanbul secret: abcdefghijkl 0123456789abcdef", "tr", "c", 40),
]
EXTRA = ["score", "rank", "n_lines", "toxic_score", "taken_words", "key", "row", "fingerprint", "words", "_row", "__row", "Places", "__places", "leak",
         "__leak", "__text", "text of the row", "weight", "features", "n_words", "at", "part", "before", "h", "h2", "id", "place", "first"]


@pytest.fixture
def docs(spark):
    table = prepare(spark).createDataFrame(ROWS, SCHEMA)
    return table.select("*", *[F.lit("x").alias(c) for c in EXTRA])


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 0), (3, 1), (4, 0), (5, None), (None, 1), (99, 1), (7, 1), (6, 0)], "doc_id long, toxic int")


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(1, "Three four FIVE six seven"), (2, "three four five six seven"), (3, None), (4, "short"), (5, "")], "item_id long, text string")


def learn():
    return F.col("doc_id").isNotNull()


RUNS = {
    "simhash": lambda d, x, i: simhash.near_duplicates(d), "secrets": lambda d, x, i: secret_scan.scan(d),
    "toxicity": lambda d, x, i: toxicity.score(d, x), "mixing": lambda d, x, i: mixing.mix(d),
    "language": lambda d, x, i: language_id.identify(d, learn()), "lines": lambda d, x, i: line_dedup.dedup(d),
    "spans": lambda d, x, i: repeated_spans.remove_repeats(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_every_row_is_answered_once(docs, labels, items, name):
    found = RUNS[name](docs, labels, items)
    assert sorted(map(str, (r[0] for r in found.select("doc_id").collect()))) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(docs, labels, items, name):
    assert RUNS[name](docs.limit(0), labels, items).count() == 0


def test_leaks(docs, items):
    found = sorted(tuple(r) for r in decontaminate.contaminated(docs, items).select("doc_id", "item_id", "similarity").collect())
    assert found == [(1, 1, 1.0), (1, 1, 1.0), (1, 2, 1.0), (1, 2, 1.0)]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items).count() == len(ROWS) - 2


def test_clashing_columns_are_carried(docs, items):
    """Values of columns whose names the operators use are those of the input."""
    for kept in (simhash.one_of_each(docs), line_dedup.dedup(docs), decontaminate.clean(docs, items), resampling.resampled(docs, items, least_words=0, percent=100)):
        for row in kept.collect():
            assert all(row[c] == "x" for c in EXTRA if c != "n_lines")


def test_resampling(docs, items):
    scored = resampling.weighed(docs, items)
    assert scored.count() == len(ROWS)
    found = resampling.drawn(scored, percent=50, least_words=5).select("row.doc_id", "n_features", "weight", "rank").collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2]
    assert all(r.n_features == 0 and r.weight == 0 for r in found if r.doc_id in (2, 3, 6))
    assert resampling.drawn(resampling.weighed(docs.limit(0), items)).count() == 0
    assert resampling.resampled(docs, items.limit(0), percent=100, least_words=1).count() == len([r for r in ROWS if r[1] and r[1].strip()])


def test_repeated_rows_and_identifiers(docs):
    marks = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert marks[4].component_id == marks[5].component_id == 4
    assert marks[2].component_id == marks[3].component_id == marks[6].component_id == 2 and marks[3].fingerprint == "0" * 16
    kept = simhash.one_of_each(docs)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "7", "None"] and kept.columns == docs.columns
    spans = {r.doc_id: r for r in repeated_spans.remove_repeats(docs).collect()}
    assert spans[4].n_removed == len(LONG) and bytes(spans[4].kept) == b"" and spans[2].n_bytes == 0


def test_pipeline_stages_keep_columns(spark, docs, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, str(tmp_path))
        own = [c for c in docs.columns if c != "taken_words"] + ["taken_words", "taken_copies"] if name == "mixing" else docs.columns
        assert kept.columns == own
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        assert 0 < kept.count() <= len(ROWS)


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, []), (10, [1.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]), (100, [3.0, 0.0])]
    table = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    found = [tuple(r) for r in prefix_forest.search(table).orderBy("query_id", "rank").collect()]
    assert found[:4] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, 2.0), (0, 4, 3, 5 ** 0.5)]
    assert [f[:3] for f in found[4:]] == [(100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 3)]
    assert prefix_forest.search(table.limit(0)).count() == 0


def test_urls(spark):
    link, move = '<LINK href="%s" REL=canonical>', "<meta content='0; URL=%s' http-equiv=\"refresh\">"
    rows = [
        (1, "https://Sub.Example.com/de/1?x#y", ""), (2, "http://a.net/1", link % "https://sub.example.com/de/1?x"), (3, "http://b.net/1", move % "//a.net/1"),
        (4, "http://c.org/ok", link % "http://b.net/1"), (5, "http://d.net/2", link % "http://c.org/ok"), (6, "http://e.net/x", None), (7, None, "<p>"),
        (8, "no-host", link % "http://a.net/1"), (9, "http://x.example.org/en/1", ""), (10, "http://org", ""), (9, "http://x.example.org/en/1", ""), (11, "http://f.net/a/b", link % "c"),
    ]
    table = prepare(spark).createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit("?"))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table).collect()}
    assert found[1] == ("sub.example.com", "/de/1", "com/de/", "block")
    assert [found[i][3] for i in (2, 3, 4, 5, 6)] == ["block", "block", "allow", "block", "allow"]
    assert found[4][2] == "org/" and found[7] == ("", "", None, "allow") and found[8] == ("", "", None, "allow")
    assert found[9] == ("x.example.org", "/en/1", "example.org/en/1", "block") and found[10] == ("org", "", None, "allow") and found[11][3] == "allow"
    assert url_filter.judge(table).count() == len(rows) and url_filter.judge(table.limit(0)).count() == 0


def test_secret_spans():
    assert secret_scan.spans(None) == [] and secret_scan.spans("API_KEY = 'short' password=abcdefghijklm") == [(18, 40, "assign")]
    body = "a1B2" * 7 + "zZ"
    token = f"ghp_{body}{secret_scan.checksum62(body)}"
    assert secret_scan.spans(f"İ {token} x") == [(2, 42, "github")] and secret_scan.spans(token[:-1] + ("0" if token[-1] != "0" else "1")) == []
    assert secret_scan.spans("AKIA" + "A" * 14 + " AKIAshort 0123456789abcdef0") == [(0, 18, "access"), (29, 46, "hex")]


def test_language_of_texts_without_letters(docs):
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs, learn()).collect() if r.doc_id}
    assert found[2] == found[3] == found[6] == "und" and found[4] == "de"
    assert {r.lang_pred for r in language_id.identify(docs, F.lit(False)).collect()} == {"und"}


def test_toxicity_without_labels(docs, labels):
    assert {r.predicted for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}
