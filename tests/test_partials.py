"""Mergeable partials, word tables of rules, published tables."""

import random

import pytest
from pyspark.sql import functions as F

from querybook import warehouse
from querybook.fixtures import BATCH, MODEL, review_view
from reviewmill.operators import aggregates as agg
from reviewmill.operators import partials, rules
from reviewmill.settings import ASPECT_RULES, REASON_RULES, KeywordRule, RuleSet
from reviewmill.sources.published import Published
from reviewmill.sources.tables import overwrite_partition

SCHEMA = ("dt string, review_time timestamp, parent_asin string, product_title string, store_name string, main_category string, "
          "rating double, pred_score double, helpful_vote long, pred_label string, verified_purchase boolean")


@pytest.fixture(scope="module")
def view(spark):
    rng, rows = random.Random(4), []
    for _ in range(3000):
        day = rng.randrange(1, 29)
        product = rng.choice([None, " ", *[f"P{i}" for i in range(90)]])
        rows.append((f"2020-0{day % 3 + 1}-{day:02d}", None, product, f"t{product}", rng.choice((None, "Shop", " shop", "SHOP ", "Other")),
                     rng.choice((None, "A", "a ", "B", "")), rng.choice((None, 1.0, 4.0)), rng.choice((0.5, 0.75, None)), rng.choice((None, 3)),
                     rng.choice(("negative", "neutral", "positive")), rng.choice((True, False, None))))
    return spark.createDataFrame(rows, SCHEMA).withColumn("review_time", F.to_timestamp("dt")).cache()


def rows(table):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in table.select(*sorted(table.columns)).collect()), key=repr)


def direct(view):
    return {
        "dws_sentiment_overview": agg.sentiment_overview(view), "dws_sentiment_daily": agg.sentiment_daily(view),
        "dws_product_sentiment": agg.product_sentiment(view), "dws_category_sentiment": agg.category_sentiment(view),
        "dws_store_sentiment": agg.store_sentiment(view), "dws_monthly_sentiment": agg.monthly_sentiment(view),
    }


def test_tables_from_partials_equal_those_from_the_view(view):
    found, expected = partials.serving_tables(view), direct(view)
    for name, table in expected.items():
        assert sorted(found[name].columns) == sorted(table.columns) and rows(found[name]) == rows(table), name


def test_an_empty_view(view):
    empty = view.limit(0)
    found, expected = partials.serving_tables(empty), direct(empty)
    for name, table in expected.items():
        assert rows(found[name]) == rows(table), name


def test_days_merge_without_a_second_look(view):
    whole, known, merged = partials.product_numbers(view), None, None
    for day in ("2020-01", "2020-02", "2020-03"):
        part = view.filter(F.col("dt").startswith(day))
        known = partials.kept(partials.product_numbers(part, known), "numbers")
        new = partials.bitmaps(partials.daily_partials(part, known), "main_category")
        merged = new if merged is None else partials.merged(merged, new, "main_category")
    assert rows(partials.categories(merged)) == rows(agg.category_sentiment(view))
    numbers = sorted(r.number for r in known.collect())
    assert numbers == list(range(1, whole.count() + 1)) and known.select("parent_asin").distinct().count() == len(numbers)


def test_products_beyond_one_bitmap(spark):
    wide = spark.range(70_000).select(
        F.lit("2020-01-01").alias("dt"), F.timestamp_seconds(F.lit(1.6e9)).alias("review_time"), F.concat(F.lit("P"), "id").alias("parent_asin"),
        F.lit("t").alias("product_title"), F.lit("s").alias("store_name"), F.lit("c").alias("main_category"), F.lit(1.0).alias("rating"),
        F.lit(0.5).alias("pred_score"), F.lit(1).alias("helpful_vote"), F.lit("neutral").alias("pred_label"), F.lit(True).alias("verified_purchase"))
    parts = partials.bitmaps(partials.daily_partials(wide, partials.product_numbers(wide)))
    assert parts.count() == 3 and partials.distinct_products(parts).first()[0] == 70_000


def test_one_scan_and_no_expanded_rows(spark, sf_dir):
    data = review_view(spark, sf_dir)
    table = partials.daily_partials(data, partials.product_numbers(data))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and "Expand" not in plan
    kept = partials.kept(table, "daily-partials")
    for made in (partials.overview(partials.bitmaps(kept)), partials.monthly(partials.bitmaps(kept, "month_id")),
                 partials.categories(partials.bitmaps(kept, "main_category")), partials.stores(kept)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan and "Expand" not in plan


def test_tables_of_products_come_from_one_row_for_each_product(spark, sf_dir):
    view = review_view(spark, sf_dir).withColumn("parent_asin", F.expr("concat('P', length(parent_asin))"))
    for name in partials.OF_ITEMS:
        # Rebuilt from the written partials: products, not days times products.
        made = partials.serving_tables(view, name)[name]
        files = made.inputFiles()
        assert files and all("item-partials" in f or "product-places" in f for f in files)
    assert partials.item_partials(view).count() == view.select(*partials.ITEM).distinct().count() < partials.daily_partials(view, partials.product_numbers(view)).count()
    plan = partials.serving_tables(view, "dws_monthly_sentiment")["dws_monthly_sentiment"]._jdf.queryExecution().optimizedPlan().toString()
    assert "product_title" not in plan and "Expand" not in plan


def test_rules_of_words_equal_rules_of_patterns(spark):
    rng = random.Random(1)
    pieces = ["well", "made", "too", "small", "look", "looks", "color", "colour", "not", "as", "described", "quality", "poorly", "is", "off", "fell", "apart",
              "écolor", "color2", "Small", "WASTE", "of", "money", "late", "lately", "never", "arrived", "size_fit", "größe", "hole", "a"]
    gaps = [" ", " ", " ", "  ", ",", ". ", "-", "'", " ", "_", "́", ""]
    texts = ["".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randrange(14))) for _ in range(4000)] + [None, "", " "]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    for given in (ASPECT_RULES, REASON_RULES):
        plain = RuleSet(tuple(KeywordRule(r.code, r.name, r.pattern) for r in given.rules), "v")
        found = table.select("text", rules.matched_codes(F.col("text"), given).alias("a"), rules.matched_codes(F.col("text"), plain).alias("b")).collect()
        assert all(r.a == r.b for r in found) and sum(bool(r.a) for r in found) > 500
    needing = RuleSet((KeywordRule("x", "X", "(^| )too [a-z]+ (of|is)( |$)", needs=("too",)), KeywordRule("y", "Y", "o{2}")), "v", separator=" ")
    free = RuleSet((KeywordRule("x", "X", "(^| )too [a-z]+ (of|is)( |$)"), KeywordRule("y", "Y", "o{2}")), "v")
    found = table.select(rules.matched_codes(F.col("text"), needing).alias("a"), rules.matched_codes(F.col("text"), free).alias("b")).collect()
    assert all(r.a == r.b for r in found)


def test_text_is_walked_once(spark):
    table = spark.createDataFrame([("too small",)], "text string")
    plan = table.select(rules.matched_codes(F.col("text"), ASPECT_RULES).alias("codes"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_reads_come_from_published_partitions(spark, sf_dir):
    published = warehouse.catalogue(spark, sf_dir)
    for name in ("dws_sentiment_overview", "dws_sentiment_alerts", "dws_store_sentiment"):
        plan = published.table(name)._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert f"= {BATCH}" in filters and f"= {MODEL}" in filters and "lineitem" not in plan
    assert rows(published.table("dws_store_sentiment")) == rows(agg.store_sentiment(review_view(spark, sf_dir)))


def test_a_catalogue_builds_each_table_once(spark, tmp_path):
    built = []

    def build(published):
        built.append(published.model)
        return spark.range(3).withColumn("model", F.lit(published.model))

    one, two = (Published(spark, str(tmp_path), "b", m, {"dws_sentiment_daily": build}) for m in ("m1", "m2"))
    assert not one.has("dws_sentiment_daily")
    for _ in range(2):
        assert [r.model for r in one.table("dws_sentiment_daily").collect()] == ["m1"] * 3
        assert [r.model for r in two.table("dws_sentiment_daily").collect()] == ["m2"] * 3
    assert built == ["m1", "m2"]
    one.publish()
    assert built == ["m1", "m2", "m1"] and one.table("dws_sentiment_daily").count() == 3
    with pytest.raises(ValueError):
        Published(spark, str(tmp_path), "b", "m", {"orders": build})
    overwrite_partition(spark.range(5), f"{tmp_path}/dws_review_samples", one.spec)
    assert one.table("dws_review_samples").count() == 5
