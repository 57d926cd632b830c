"""Reviews and predictions stored by review key, so that what joins them moves no row.

Every table is cut by its packed key (see ``packed_key``) into the same number of buckets, one file each; the key itself is not stored but unpacked on reading. Joins
and groups by key then read matching buckets side by side: no exchange on either side. Rows without a key
match nothing and would all fall into one bucket; they are stored apart, spread as they come.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import model_partition, packed_key, unpacked_key
from reviewmill.operators.checks import as_rows, distributed, together
from reviewmill.operators.joins import by_merge
from reviewmill.operators.predictions import PACKED, import_faults, valid_predictions

KEY = "review_key"


@dataclass(frozen=True)
class Keyed:
    """One stored table: rows with a key, bucketed by it, and rows without one."""

    rows: DataFrame
    keyless: DataFrame

    def all(self) -> DataFrame:
        return self.rows.drop(PACKED).unionByName(self.keyless)

    def keys(self) -> DataFrame:
        return self.rows.select(F.col(PACKED).alias("_key"))


class KeyedStore:
    """Tables below ``root``, all in ``buckets`` buckets: the number of tasks that read or write one, so about
    the bytes of the largest over what a task should hold."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, prefix: str = "keyed"):
        self.spark, self.root, self.buckets, self.prefix = spark, root, buckets, prefix

    def write(self, name: str, table: DataFrame) -> Keyed:
        """Store ``table`` anew. Rows that are partitioned by packed key in that number already are not moved."""
        keyed = table.filter(F.col(KEY).isNotNull())
        if PACKED not in table.columns:
            keyed = keyed.withColumn(PACKED, packed_key(KEY))
        catalogued = f"{self.prefix}_{name}"
        keyed.drop(KEY).repartition(self.buckets, PACKED).write.mode("overwrite").format("parquet").bucketBy(self.buckets, PACKED) \
            .option("path", f"{self.root}/{name}/keyed").option("compression", "zstd").saveAsTable(catalogued)
        table.filter(F.col(KEY).isNull()).drop(PACKED).write.mode("overwrite").parquet(f"{self.root}/{name}/keyless")
        return self.read(name)

    def read(self, name: str) -> Keyed:
        rows = self.spark.table(f"{self.prefix}_{name}").withColumn(KEY, unpacked_key(PACKED))
        rows = rows.select(KEY, *[c for c in rows.columns if c != KEY])
        return Keyed(rows, self.spark.read.schema(rows.drop(PACKED).schema).parquet(f"{self.root}/{name}/keyless"))


def imported(staged: Keyed, reviews: Keyed, model: str) -> DataFrame:
    """Valid predictions of known reviews of the same batch; as ``import_predictions``, without an exchange."""
    known = reviews.rows.select(F.col(PACKED).alias("_key"), F.col("load_batch_id").alias("_batch"))
    valid = valid_predictions(staged.rows, model)
    # The batch is no key of the join: its two sides are dealt by the review key alone.
    met = valid.join(by_merge(known), F.col(PACKED) == F.col("_key")).filter(~F.coalesce(F.col("load_batch_id") != F.col("_batch"), F.lit(True)))
    return met.drop("_key", "_batch").withColumns({
        "imported_at": F.current_timestamp(), "model_version_partition": model_partition(F.lit(model))})


def unknown_predictions(staged: Keyed, reviews: Keyed) -> DataFrame:
    """Prediction rows whose key no review has, those without a key among them."""
    return staged.rows.join(by_merge(reviews.keys()), F.col(PACKED) == F.col("_key"), "left_anti").drop(PACKED).unionByName(staged.keyless)


def missing_reviews(reviews: Keyed, staged: Keyed) -> DataFrame:
    """Review rows without a prediction."""
    return reviews.rows.join(by_merge(staged.keys()), F.col(PACKED) == F.col("_key"), "left_anti").drop(PACKED).unionByName(reviews.keyless)


def _counted(table: Keyed, name: str) -> DataFrame:
    return table.rows.groupBy(F.col(PACKED).alias("_key")).agg(F.count(F.lit(1)).alias(name))


def matched_keys(staged: Keyed, reviews: Keyed) -> DataFrame:
    """One row: how many different predicted keys reviews have."""
    met = _counted(staged, "_n").join(by_merge(_counted(reviews, "_m")), "_key")
    return met.agg(F.count(F.lit(1)).alias("matched_key_count"))


def coverage(reviews: Keyed, staged: Keyed) -> DataFrame:
    """Share of review rows with a key that have a prediction, a review counted once for each of them; 0.0 without reviews."""
    met = _counted(reviews, "_r").join(by_merge(_counted(staged, "_n")), "_key", "left")
    covered = F.coalesce(F.sum(F.col("_r") * F.col("_n")), F.lit(0))
    total = F.coalesce(F.sum(F.col("_r") * F.coalesce("_n", F.lit(1))), F.lit(0))
    return met.agg(safe_rate(covered, total).alias("prediction_coverage"))


def check_import(staged: Keyed, production: Keyed, reviews: Keyed, model: str) -> DataFrame:
    """The (name, value) rows of ``checks.check_import`` for tables of one batch.

    Staged and imported rows are summed by key and model, then by key, and each meets the reviews counted by
    key; all of it inside buckets. One row of sums leaves every task, and one for each label and model.
    """
    def total(c: Column | str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    def summed(table: Keyed, measures: dict[str, Column]) -> DataFrame:
        """By key: the sums of ``measures``, those of ``model``, and the (key, model) pairs that occur more than once."""
        def pairs(rows: DataFrame) -> DataFrame:
            return rows.groupBy(F.col(PACKED).alias("_key"), "model_version").agg(
                F.count(F.lit(1)).alias("rows"), *[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(n) for n, c in measures.items()])

        def keys(found: DataFrame) -> DataFrame:
            own = F.when(F.col("model_version") == model, F.col("rows"))
            return found.groupBy("_key").agg(
                F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in measures], F.count(F.when(F.col("rows") > 1, 1)).alias("twice"),
                total(own).alias("of_model"), F.count(F.when(own > 1, 1)).alias("of_model_twice"),
                *[total(F.when(F.col("model_version") == model, F.col(n))).alias(f"of_model_{n}") for n in measures])

        met = keys(pairs(table.rows)).join(by_merge(_counted(reviews, "_r")), "_key", "left")
        # Keyless rows meet no review; they are summed apart and joined as sums.
        return met.unionByName(keys(pairs(table.keyless.withColumn(PACKED, packed_key(KEY)))).withColumn("_r", F.lit(None).cast("long")))

    faults = import_faults(model)
    bad = faults.pop("bad")
    staging = summed(staged, faults).agg(
        total("rows").alias("staging_row_count"), *[total(n).alias(n) for n in faults],
        total("twice").alias("duplicate_staging_prediction_key_groups"),
        total(F.when(F.col("_r").isNull(), F.col("of_model"))).alias("unknown_review_key_count"))
    own = summed(production, {"bad": bad}).agg(
        total("of_model").alias("production_sentiment_row_count"), total("of_model_bad").alias("invalid_production_row_count"),
        total("of_model_twice").alias("duplicate_production_prediction_key_groups"),
        total(F.col("of_model") * F.col("_r")).alias("joined_view_row_count"))
    of_model = production.rows.filter(F.col("model_version") == model).groupBy(F.col(PACKED).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    covered = _counted(reviews, "_r").join(by_merge(of_model), "_key", "left").agg(
        total(F.when(F.col("_n").isNull(), F.col("_r"))).alias("missing"),
        total(F.col("_r") * F.coalesce("_n", F.lit(0))).alias("covered"), total(F.col("_r") * F.coalesce("_n", F.lit(1))).alias("all"))
    keyless = reviews.keyless.agg(F.count(F.lit(1)).alias("missing"))
    found = covered.unionByName(keyless, allowMissingColumns=True).agg(
        total("missing").alias("missing_review_key_count"),
        safe_rate(total("covered"), total(F.coalesce("all", F.lit(0))) + total(F.when(F.col("all").isNull(), F.col("missing")))).alias("prediction_coverage"))
    return together(*map(as_rows, (staging, own, found)), _distributions(production, model))


def _distributions(production: Keyed, model: str) -> DataFrame:
    """Imported rows by label and by model version, counted in each task, so that only counts are moved."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).value_counts().to_pylist():
                found[x["values"]] += x["counts"]
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["name", "rows"])

    names = production.all().select(F.explode(distributed(model)).alias("name"))
    return names.mapInArrow(counted, "name string, rows long").repartition(1).groupBy("name").agg(F.sum("rows").cast("double").alias("value"))
