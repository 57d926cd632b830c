"""Cases that an earlier version left out."""

import duckdb
from pyspark.sql import functions as F

from check_oracles import compare
from reviewmill.llm import decontaminate, line_dedup, repeated_spans, url_filter
from reviewmill.llm.common import prepare
from reviewmill.llm.queries import ORACLES, QUERIES


def test_equal_short_lines_are_removed(spark):
    texts = ["All rights reserved.\na b c d", "x\n\nAll  rights reserved.\na b c e", "这是一个没有空格的很长的句子\nx", "这是一个没有空格的很长的句子\n \nnew"]
    table = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup(table).collect()}
    assert found == {0: (texts[0], 0), 1: ("x\n\na b c e", 1), 2: ("这是一个没有空格的很长的句子", 1), 3: (" \nnew", 1)}


def test_repetitive_items_are_found_at_every_place(spark):
    fill = [f"w{i}" for i in range(100)]
    texts = [(at, " ".join(fill[:20 + at] + ["no"] * 8 + fill[20 + at:])) for at in range(4)]
    table = prepare(spark).createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(["no"] * 8))], "item_id long, text string")
    found = decontaminate.contaminated(table, items).collect()
    assert sorted((r.doc_id, r.similarity, r.start) for r in found) == [(at, 1.0, 20 + at) for at in range(4)]


def test_relative_links_are_resolved(spark):
    cases = [
        ("http://h.com/a/b/c?q=1", "../x", "http://h.com/a/x"), ("http://h.com/a/b/c", "./x?y=../z", "http://h.com/a/b/x?y=../z"),
        ("http://h.com/a/b/c?q=1#f", "?page=2", "http://h.com/a/b/c?page=2"), ("http://h.com/a/b/c?q=1", "#top", "http://h.com/a/b/c?q=1"),
        ("http://h.com/a", "../../x", "http://h.com/x"), ("http://h.com", "x", "http://h.com/x"), ("http://h.com/a/b/", "..", "http://h.com/a/"),
        ("http://h.com/a/b/c", ".", "http://h.com/a/b/"), ("http://h.com/a", "/p/./q/../r", "http://h.com/p/r"), ("http://h.com/a", "/p/.q/..r", "http://h.com/p/.q/..r"),
        ("http://h.com/a/b", "c", "http://h.com/a/c"), ("http://h.com/a", "//i.com/x", "http://i.com/x"), ("http://h.com/a", "http://i.com/x", "http://i.com/x"),
    ]
    table = spark.createDataFrame(cases, "base string, link string, expected string")
    found = table.select("base", "link", url_filter.resolved(F.col("base"), F.col("link")), "expected").collect()
    assert [r[2] for r in found] == [r.expected for r in found]
    link = '<link rel="canonical" href="%s">'
    pages = [(1, "http://a.com/de/x", ""), (2, "http://a.com/fr2/y/z", link % "../../de/x"), (3, "http://a.com/p?page=2", link % "http://a.com/de/x"),
             (4, "http://a.com/p?page=3", link % "?page=2"), (5, "http://a.com/q/r", link % "./s")]
    verdicts = url_filter.judge(prepare(spark).createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.verdict for r in verdicts} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def test_url_twin_follows_planted_chains(spark, tmp_path):
    """The SQL twin against the operator where links do carry decisions: relative links, chains, cycles, allowed pages between."""
    link, move = '<link rel="canonical" href="%s">', '<META content="0; url=%s" HTTP-EQUIV=refresh>'
    chains = [
        ("http://a.com/de/x", ""), ("http://a.com/p/y/z", link % "../../de/x"), ("http://a.com/p/q/r", link % "../y/./z"), ("http://a.com/s?page=2", move % "http://a.com/p/q/r"),
        ("http://a.com/s?page=3#f", link % "?page=2"), ("http://a.com/s?page=4", link % "#top"), ("http://b.org/ok", link % "//a.com/s?page=3"), ("http://c.net", move % "http://b.org/ok"),
        ("http://c.net/k", link % "http://c.net"), ("http://d.net/1", link % "2"), ("http://d.net/2", link % "3"), ("http://d.net/3", link % "1"), ("http://d.net/a/..", link % ".."),
        ("http://d.net/a//b/c", link % "../../x"), ("http://d.net/a//x", link % "/./de/../q"), ("http://e.com/v", link % "../../../de/w"), ("http://e.com/t", link % "http://sub.e.com/de/u"),
        ("http://f.com/", link % "de/."), ("http://g.com/fr/1", link % "/de/1"), ("http://h.net/1", link % "http://g.com/fr/1"), (None, link % "http://a.com/de/x"), ("nohost", link % "http://a.com/de/x"),
    ]
    table = prepare(spark).createDataFrame([(i, u, h) for i, (u, h) in enumerate(chains * 2)], "page_id long, url string, html string")
    table.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), "op10_url_filter", QUERIES["op10_url_filter"], ORACLES["op10_url_filter"]) == ""
    verdicts = {r.url: r.verdict for r in url_filter.judge(table).join(table.select("page_id", "url"), "page_id").collect()}
    assert [verdicts[u] for u in ("http://a.com/p/y/z", "http://a.com/s?page=3#f", "http://b.org/ok", "http://c.net/k", "http://h.net/1")] == ["block", "block", "allow", "block", "block"]
    assert verdicts["http://d.net/1"] == "allow" and verdicts["http://e.com/v"] == "block" and verdicts["http://g.com/fr/1"] == "allow"


def test_a_passage_in_all_texts_does_not_meet_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(repeated_spans, "BUCKET_BYTES", 0)
    monkeypatch.setattr(repeated_spans, "HOT", 100_000, raising=False)
    passage = "-".join(str(n * n) for n in range(120, 320))
    within = range(128, 128 + len(passage) - 399)
    edge = [F.sha2(n.cast("string"), 512) for n in (F.col("id"), -F.col("id") - 1)]
    rows = prepare(spark).range(0, 1000, 1, 8).select(F.col("id").alias("row"), F.concat(edge[0], F.lit(passage), edge[1]).alias("text"))
    for name, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        starts = repeated_spans.repeated_starts(rows).withColumn("part", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    places = starts[starts.low.isin(within) & starts.high.isin(within)].groupby(["low", "high"]).agg(rows=("row", "nunique"), parts=("part", "nunique"))
    assert (places.rows == 1000).all() and (places.parts > 1).all()
    # Single windows and runs of windows make up the passage.
    assert {s for low, high in places.index for s in range(low, high + 1)} == set(within) and any(low < high for low, high in places.index)


def test_the_length_in_bytes_decides_not_the_number_of_words(spark):
    passage = " ".join(f"w{i:05}" for i in range(80))
    cases = [("short", passage[:399]), ("long", passage[-400:])]
    texts = [(f"{kind}{i}", f"{at}{i}{part}{i}{at}") for at, (kind, part) in enumerate(cases) for i in (1, 2)]
    found = {r.doc_id: r for r in repeated_spans.remove_repeats(prepare(spark).createDataFrame(texts, "doc_id string, text string")).collect()}
    # Over 50 words each: 399 bytes stay, 400 go.
    assert all(len(part.split()) > 50 for _, part in cases)
    assert {k: (r.n_removed, r.n_spans) for k, r in found.items()} == {"short1": (0, 0), "short2": (0, 0), "long1": (400, 1), "long2": (400, 1)}
