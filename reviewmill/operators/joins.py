"""Equi-joins of the warehouse, safe when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import is_blank, strip

# A list of up to this many hot keys is broadcast; a longer one is joined.
HOT_KEY_LIMIT = 4096


def hot_keys(table: DataFrame, key: str, rows_per_split: int = 1_000_000) -> DataFrame:
    """Keys with more rows than one task should hold, and into how many parts to cut them.

    Counting runs on the key column alone with map-side combining.
    """
    counted = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = counted.filter(F.col("n") > rows_per_split)
    return hot.select(key, F.ceil(F.col("n") / rows_per_split).cast("int").alias("_splits"))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left", hot: DataFrame | None = None,
                spread_by: Column | None = None) -> DataFrame:
    """Join many rows to a lookup table on ``key``.

    With ``hot`` (from :func:`hot_keys`), rows of a hot key are spread over
    several tasks and only that key's lookup rows are repeated, so every row
    still meets its match exactly once. Rows without a key meet nothing; they are
    spread over all tasks by ``spread_by`` (by all columns, if it is not given).
    """
    spread = F.xxhash64(*rows.columns) if spread_by is None else spread_by
    if hot is None:
        part = F.when(F.col(key).isNull(), spread).otherwise(F.lit(0).cast("bigint"))
        # Always 0, but no literal: a literal would be taken out of the join's keys.
        only = lookup.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(1).cast("bigint")))
        return rows.withColumn("_part", part).join(only, [key, "_part"], how).drop("_part")
    if hot.count() <= HOT_KEY_LIMIT:
        hot = F.broadcast(hot)
    part = F.when(F.col(key).isNull(), spread).when(F.col("_splits").isNull(), F.lit(0).cast("bigint")).otherwise(F.pmod(spread, F.col("_splits").cast("bigint")))
    parted = rows.join(hot, key, "left").withColumn("_part", part).drop("_splits")
    every_part = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_splits", F.lit(1)).cast("bigint") - 1)
    repeated = lookup.join(hot, key, "left").withColumn("_part", F.explode(every_part)).drop("_splits")
    return parted.join(repeated, [key, "_part"], how).drop("_part")


def by_merge(table: DataFrame) -> DataFrame:
    """Ask for a sort-merge join. For sides that grow with the reviews: the size
    estimate of a compressed file must never make one of them a broadcast."""
    return table.hint("merge")


def first_per_key(table: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """First row of each key. Copies are reduced before the shuffle, so a key
    held by a third of the rows costs no more than any other."""
    keys = [key] if isinstance(key, str) else key
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return table.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def metadata_for(reviews: DataFrame, metadata: DataFrame, order: list[Column], key: str = "parent_asin") -> DataFrame:
    """First metadata row of every product that occurs in the reviews."""
    wanted = reviews.filter(~is_blank(key)).select(key).distinct()
    return first_per_key(metadata.join(wanted, key, "left_semi"), key, order)


def missing_parents(reviews: DataFrame, metadata: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Reviewed products without metadata, in order."""
    wanted = reviews.filter(~is_blank(key)).select(key).distinct()
    return wanted.join(metadata.select(key), key, "left_anti").orderBy(key)


def unknown_keys(predictions: DataFrame, reviews: DataFrame, key: str = "review_key") -> DataFrame:
    """Prediction rows whose key no review has."""
    return predictions.join(by_merge(reviews.select(key)), key, "left_anti")


def missing_keys(reviews: DataFrame, predictions: DataFrame, key: str = "review_key") -> DataFrame:
    """Review rows without a prediction."""
    return reviews.join(by_merge(predictions.select(key)), key, "left_anti")


def matched_keys(predictions: DataFrame, reviews: DataFrame, key: str = "review_key") -> DataFrame:
    """Distinct predicted keys that reviews have."""
    return predictions.select(key).distinct().join(by_merge(reviews.select(key)), key, "left_semi")


def coverage(reviews: DataFrame, predictions: DataFrame, key: str = "review_key") -> DataFrame:
    """Share of review rows that have a prediction; 0.0 without reviews.

    As in a left join, a review counts once for each of its predictions; the
    predictions are counted per key before they are joined.
    """
    counted = predictions.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    joined = reviews.filter(F.col(key).isNotNull()).select(key).join(by_merge(counted), key, "left")
    covered = F.coalesce(F.sum("_n"), F.lit(0))
    total = F.coalesce(F.sum(F.coalesce("_n", F.lit(1))), F.lit(0))
    return joined.agg(covered.alias("covered"), total.alias("total")).select(
        safe_rate("covered", "total").alias("prediction_coverage")
    )


def metadata_match(reviews: DataFrame, metadata: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Joined, unmatched and total row counts of reviews and metadata, and the match rate.

    Both sides are counted per key first: only one row per product is joined,
    whatever the number of its reviews or metadata rows.
    """
    left = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    right = metadata.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    joined = left.join(right, key, "left")
    counted = joined.agg(
        F.coalesce(F.sum(F.col("_r") * F.col("_m")), F.lit(0)).alias("reviews_with_metadata"),
        F.coalesce(F.sum(F.when(F.col("_m").isNull(), F.col("_r"))), F.lit(0)).alias("reviews_without_metadata"),
    )
    total = F.col("reviews_with_metadata") + F.col("reviews_without_metadata")
    return counted.withColumn("metadata_match_rate", safe_rate(F.col("reviews_with_metadata"), total))


def join_rate(reviews: DataFrame, metadata: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Rows whose stripped product key occurs in the metadata: matched, unmatched, without key, rate."""
    left = reviews.select(strip(key).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    right = metadata.select(strip(key).alias("k")).filter("k <> ''").distinct().withColumn("hit", F.lit(True))
    joined = left.join(right, "k", "left")
    blank = F.col("k").isNull() | (F.col("k") == "")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    counted = joined.agg(
        total(~blank).alias("reviews_with_parent_asin"),
        total(~blank & F.col("hit").isNotNull()).alias("matched_parent_asin_rows"),
        total(~blank & F.col("hit").isNull()).alias("unmatched_parent_asin_rows"),
        total(blank).alias("missing_or_blank_parent_asin_rows"),
    )
    return counted.withColumn(
        "sample_parent_asin_join_rate", safe_rate("matched_parent_asin_rows", "reviews_with_parent_asin")
    )
