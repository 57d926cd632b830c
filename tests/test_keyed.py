"""Tables stored by review key: the same results as plain joins, without moving a row."""

import random

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import checks, joins
from reviewmill.operators import predictions as pred
from reviewmill.sources import keyed

PREDICTION = ("review_key string, load_batch_id string, pred_label string, pred_score double, negative_score double, neutral_score double, "
              "positive_score double, model_version string, inferred_at timestamp")


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    rng = random.Random(3)
    keys = [None, " ", *[f"k{i}" for i in range(60)]]
    reviews = spark.createDataFrame([(rng.choice(keys), rng.choice(("b", "b", "b", None))) for _ in range(150)] + [(None, "b")] * 5, "review_key string, load_batch_id string")
    staged = spark.createDataFrame([
        (rng.choice([*keys, "other"]), "b", rng.choice(("negative", "positive", "odd", None)), rng.choice((0.5, 0.9, 1.5, None)), rng.choice((None, 0.1, 2.0)), None, None,
         rng.choice(("m", "m", "m", "n", " ", None)), None) for _ in range(400)], PREDICTION)
    staged = staged.withColumn("inferred_at", F.when(F.xxhash64(*staged.columns) % 7 != 0, F.lit("2024-01-01").cast("timestamp")))
    store = keyed.KeyedStore(spark, str(tmp_path_factory.mktemp("keyed")), 5, "keyed_tests")
    one, two = store.write("reviews", reviews), store.write("staged", staged)
    return reviews, staged, one, two, store.write("imported", keyed.imported(two, one, "m"))


def rows(table):
    return sorted(map(repr, (tuple(r) for r in table.collect())))


def test_stored_rows_are_whole(data):
    reviews, staged, one, two, _ = data
    assert rows(one.all()) == rows(reviews) and rows(two.all()) == rows(staged)
    assert one.keyless.count() == reviews.filter("review_key is null").count() > 0


def test_results_equal_plain_joins(data):
    reviews, staged, one, two, imported = data
    plain = pred.import_predictions(staged, reviews, "m")
    assert rows(imported.all().drop("imported_at").select("review_key", "pred_label", "pred_score", "model_version_partition")) == \
        rows(plain.select("review_key", "pred_label", "pred_score", "model_version_partition")) and imported.rows.count() > 20
    assert rows(keyed.unknown_predictions(two, one)) == rows(joins.unknown_keys(staged, reviews))
    assert rows(keyed.missing_reviews(one, two)) == rows(joins.missing_keys(reviews, staged))
    assert keyed.matched_keys(two, one).first()[0] == joins.matched_keys(staged, reviews).count()
    assert keyed.coverage(one, two).first()[0] == joins.coverage(reviews, staged).first()[0]


def test_checks_equal_those_of_plain_tables(spark, data):
    _, _, one, two, imported = data
    only = keyed.Keyed(one.rows.filter("load_batch_id = 'b'"), one.keyless.filter("load_batch_id = 'b'"))
    known = [c for c in imported.rows.columns if c != "imported_at"]
    bad = keyed.Keyed(imported.rows.withColumn("pred_score", F.when(F.col("review_key") > "k3", 3.0).otherwise(F.col("pred_score"))), imported.keyless)
    for production in (imported, bad):
        view = only.rows.join(production.rows.select(*known).drop("load_batch_id"), "review_key")
        expected = {r.name: r.value for r in checks.check_import(two.all(), production.all(), only.all(), view, "b", "m").collect()}
        found = {r.name: r.value for r in keyed.check_import(two, production, only, "m").collect()}
        assert found == expected
    assert found["invalid_production_row_count"] > 0


def test_no_exchange_on_either_side(data):
    _, _, one, two, imported = data
    for table in (keyed.imported(two, one, "m"), keyed.unknown_predictions(two, one), keyed.missing_reviews(one, two)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    for table in (keyed.matched_keys(two, one), keyed.coverage(one, two)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == plan.count("Exchange SinglePartition") == 1
    plan = keyed.check_import(two, imported, one, "m")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "SinglePartition" not in line]
    # Only rows without a key, which meet nothing, are summed by model through an exchange.
    below = plan.split("SortMergeJoin")
    assert len(below) == 4 and all("bucketed: true" in part.lower() for part in below[1:]) and len(moved) == 4 and all("model_version" in line or "_key" in line for line in moved)


def test_an_import_is_stored_without_moving_it(spark, data):
    """Rows that come out of a join of buckets are in the buckets of the next table already."""
    _, _, one, two, _ = data
    plan = keyed.imported(two, one, "m").filter("review_key is not null").repartition(5, "review_key")
    assert keyed.imported(two, one, "m").rdd.getNumPartitions() == 5 and plan.rdd.getNumPartitions() == 5


def test_only_tables_that_are_asked_for_are_stored(spark, sf_dir):
    from querybook import warehouse

    warehouse._KEYED.clear()
    found = warehouse.keyed_tables(spark, sf_dir, "reviews")
    assert list(warehouse._KEYED[(spark.sparkContext.applicationId, sf_dir)][1]) == ["reviews"]
    stored = spark.read.parquet(found["reviews"].rows.inputFiles()[0])
    assert sorted(stored.columns) == ["_packed", "load_batch_id"] and stored.selectExpr("max(length(_packed))").first()[0] == 33
