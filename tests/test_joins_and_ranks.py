"""Skewed joins, deduplication, ranks and plans against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from querybook.fixtures import review_view
from reviewmill.operators import aggregates, clean, joins, predictions, ranking


@pytest.fixture
def skewed(spark):
    """A third of 3,000 rows hold one product, some hold none."""
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 0 else f"p{i % 40}")) for i in range(3000)]
    lookup = [("hot", "Hot title")] + [(f"p{i}", f"title {i}") for i in range(0, 40, 2)]
    return (spark.createDataFrame(rows, "id int, parent_asin string"),
            spark.createDataFrame(lookup, "parent_asin string, title string"), rows, dict(lookup))


def test_hot_keys_are_split_by_size(skewed):
    rows, _, _, _ = skewed
    assert {r.parent_asin: r._splits for r in joins.hot_keys(rows, "parent_asin", 300).collect()} == {"hot": 4}


def test_salted_join_equals_plain_join(skewed):
    rows, lookup, raw, titles = skewed
    hot = joins.hot_keys(rows, "parent_asin", 30)
    for how in ("left", "inner"):
        got = sorted(joins.lookup_join(rows, lookup, "parent_asin", how, hot).select("id", "title").collect())
        want = [(i, titles.get(p)) for i, p in raw if how == "left" or p in titles]
        assert [tuple(r) for r in got] == sorted(want)


def test_hot_key_reaches_several_tasks(spark, skewed):
    rows, lookup, _, _ = skewed
    hot = joins.hot_keys(rows, "parent_asin", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.lookup_join(rows, lookup, "parent_asin", "left", hot).filter("parent_asin = 'hot'")
        assert joined.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    from querybook.cleaning import clean_table

    plan = clean_table(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Partial") >= 2 and "WindowGroupLimit" in plan
    # Derived text is computed after the last shuffle, not carried through it.
    exchange = plan[plan.index("Exchange hashpartitioning(review_key"):]
    assert "\\s{2,}" in plan and "\\s{2,}" not in exchange


def test_scan_reads_needed_columns_only(spark, sf_dir):
    plan = aggregates.sentiment_daily(review_view(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    line = next(part for part in plan.splitlines() if "lineitem" in part)
    assert "l_extendedprice" not in line and "l_tax" not in line


def test_dedupe_takes_the_smallest_in_order(spark):
    ddl = ("review_key string, review_timestamp bigint, asin string, parent_asin string, rating double, helpful_vote bigint, "
           "verified_purchase boolean, images_json string, user_id string, title string")
    rows = [("k", 1, "a", "p", r, v, True, "[]", "u", None) for r, v in ((3.0, 1), (2.0, 5), (2.0, 9), (4.0, 0))]
    got = clean.dedupe(spark.createDataFrame(rows * 200, ddl)).collect()
    assert [(r.rating, r.helpful_vote) for r in got] == [(2.0, 9)]


def test_metadata_cannot_multiply_reviews(spark):
    raw = spark.createDataFrame(
        [(5.0, "t", "  two\r\n lines ", "[]", "a", "p1", "u", 1704067200999, 0, True, "b")],
        "rating double, title string, review_text string, images_json string, asin string, parent_asin string, user_id string, "
        "review_timestamp bigint, helpful_vote bigint, verified_purchase boolean, load_batch_id string")
    meta = spark.createDataFrame(
        [("p1", "x", "s", "c", "b"), ("p1", "y", "s", "c", "b"), ("p1", "z", "s", "c", "other")],
        "parent_asin string, product_title string, store_name string, main_category string, load_batch_id string")
    [row] = clean.clean_reviews(raw, meta, "b").collect()
    assert (row.review_text_clean, row.text_length, row.product_title, row.dt) == ("two lines", 9, "x", "2024-01-01")
    assert (row.rating_label, row.metadata_matched, str(row.review_time)) == ("positive", True, "2024-01-01 00:00:00")


def test_duplicate_flag(spark):
    rows = [("k", "m", i) for i in range(500)] + [("j", None, 0), ("j", None, 1)]
    flagged = predictions.flag_duplicates(spark.createDataFrame(rows, "review_key string, model_version string, n int"), [F.col("n")])
    assert Counter(r.is_duplicate for r in flagged.collect()) == {True: 500, False: 2}


def test_distributed_rank_is_a_permutation_in_hash_order(spark):
    table = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.expr("IF(id % 10 = 0, 'small', 'big')").alias("g"))
    ranked = ranking.distributed_rank(table, "g", "k", 7, total="n", slices=64).withColumn("h", F.xxhash64(F.lit(7), "k")).collect()
    groups = defaultdict(list)
    for r in ranked:
        groups[r.g].append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: (r.h, r.k))
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert {r.n for r in rows} == {len(rows)}
    assert table.count() == len(ranked)


def test_rank_slices_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        ranking.distributed_rank(spark.range(3).withColumn("g", F.lit(1)), "g", "id", 1, slices=100)


def test_top_n_per_group(spark):
    rows = [(f"k{i}", "hot" if i % 3 else "cold", (i * 37) % 101) for i in range(2000)]
    got = ranking.top_n_per_group(spark.createDataFrame(rows, "k string, g string, s int"), "g", [F.desc("s"), F.asc("k")], 25, "k")
    for group in ("hot", "cold"):
        want = sorted(((-s, k) for k, g, s in rows if g == group))[:25]
        have = sorted((r["rank"], r.k) for r in got.filter(F.col("g") == group).collect())
        assert [k for _, k in have] == [k for _, k in want]


def test_uniform_sample_repeats(spark):
    table = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = sorted(r.k for r in ranking.uniform_sample(table, 50, "k").collect())
    assert first == sorted(r.k for r in ranking.uniform_sample(table.repartition(7), 50, "k").collect()) and len(set(first)) == 50


def test_overview_of_nothing(spark, sf_dir):
    row = aggregates.sentiment_overview(review_view(spark, sf_dir).filter(F.lit(False))).first()
    assert (row.review_count, row.positive_count, row.positive_rate, row.average_rating) == (0, None, 0.0, None)


def test_missing_kpi_row_is_an_error(spark, sf_dir):
    from reviewmill.plans.serving_queries import kpi

    empty = aggregates.sentiment_daily(review_view(spark, sf_dir)).filter(F.lit(False))
    with pytest.raises(Exception, match="no row for this batch"):
        kpi(empty).collect()
