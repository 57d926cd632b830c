"""Serving aggregates over the joined review/prediction view.

Each builder takes the view of one batch and one model and returns one table
without scope columns; :func:`stamp` adds those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import folded_name, is_blank
from reviewmill.functions.times import month_text
from reviewmill.schemas import LABELS
from reviewmill.settings import CONFIDENCE_BUCKETS, MONTH_FORMAT, UNKNOWN_NAME, ConfidenceBucket


def scope(view: DataFrame, batch: str, model: str) -> DataFrame:
    """Rows of one batch and model; every aggregate must start from this."""
    return view.filter((F.col("load_batch_id") == batch) & (F.col("model_version") == model))


def stamp(table: DataFrame, batch: str, model: str) -> DataFrame:
    """Add the build time and the scope columns of a serving table."""
    return table.withColumns({
        "generated_at": F.current_timestamp(),
        "load_batch_id": F.lit(batch),
        "model_version": F.lit(model),
    })


def count_where(condition: Column) -> Column:
    """Conditional count; null (as SQL SUM) when there are no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def label_counts() -> list[Column]:
    return [count_where(F.col("pred_label") == label).alias(f"{label}_count") for label in reversed(LABELS)]


def with_rates(table: DataFrame, total: str = "review_count") -> DataFrame:
    return table.withColumns(
        {f"{label}_rate": safe_rate(f"{label}_count", total) for label in reversed(LABELS)}
    )


def _measures(total: str = "review_count") -> list[Column]:
    return [F.count(F.lit(1)).alias(total), *label_counts()]


def _rating() -> Column:
    return F.avg("rating").alias("average_rating")


def _score() -> Column:
    return F.avg("pred_score").alias("average_prediction_score")


def _votes() -> Column:
    return F.avg(F.col("helpful_vote").cast("double")).alias("average_helpful_vote")


def _products() -> Column:
    return F.count_distinct("parent_asin").alias("product_count")


def sentiment_overview(view: DataFrame) -> DataFrame:
    """One row for the scope; on no rows the counts of labels are null, the rates 0.0."""
    return with_rates(view.agg(*_measures(), _products(), _rating(), _score()))


def sentiment_daily(view: DataFrame) -> DataFrame:
    return with_rates(view.groupBy("dt").agg(*_measures(), _rating()))


def product_sentiment(view: DataFrame) -> DataFrame:
    """Grain: product with its title, store and category."""
    rows = view.filter(~is_blank("parent_asin"))
    grouped = rows.groupBy("parent_asin", "product_title", "store_name", "main_category").agg(
        *_measures(), count_where(F.col("verified_purchase")).alias("verified_count"), _rating(), _votes(), _score(),
    )
    rated = with_rates(grouped).withColumn("verified_purchase_rate", safe_rate("verified_count", "review_count"))
    return rated.drop("verified_count")


def _by_name(view: DataFrame, name: str) -> DataFrame:
    """Measures by folded name, with the smallest spelling of it.

    Reviews are first summed by (name, product) with plain hash aggregation.
    Folding the names, the smallest spelling and the distinct products then
    work on those few rows instead of on all reviews.
    """
    pairs = view.groupBy(name, "parent_asin").agg(
        *_measures(), *[F.sum(c).alias(f"{c}_sum") for c in ("rating", "pred_score")],
        *[F.count(c).alias(f"{c}_rows") for c in ("rating", "pred_score")],
    )
    counts = ("review_count", *[f"{label}_count" for label in reversed(LABELS)])
    grouped = pairs.groupBy(folded_name(name).alias("folded")).agg(
        F.coalesce(F.min(name), F.lit(UNKNOWN_NAME)).alias(name),
        *[F.sum(c).alias(c) for c in counts],
        _products(),
        (F.sum("rating_sum") / F.nullif(F.sum("rating_rows"), F.lit(0))).alias("average_rating"),
        (F.sum("pred_score_sum") / F.nullif(F.sum("pred_score_rows"), F.lit(0))).alias("average_prediction_score"),
    )
    return with_rates(grouped)


def category_sentiment(view: DataFrame) -> DataFrame:
    """Grain: folded category name."""
    return _by_name(view, "main_category").withColumnRenamed("folded", "category_key")


def store_sentiment(view: DataFrame) -> DataFrame:
    """Grain: folded store name, identified by its hash."""
    return _by_name(view, "store_name").withColumn("store_key", F.sha2("folded", 256)).drop("folded")


def verified_sentiment(view: DataFrame) -> DataFrame:
    status = F.when(F.col("verified_purchase"), F.lit("verified")).otherwise(F.lit("unverified"))
    return with_rates(view.groupBy(status.alias("purchase_status")).agg(*_measures(), _rating(), _votes(), _score()))


def monthly_sentiment(view: DataFrame, month_format: str = MONTH_FORMAT) -> DataFrame:
    month = month_text("review_time", month_format).alias("month_id")
    return with_rates(view.groupBy(month).agg(*_measures(), _products(), _rating(), _score()))


def rating_matrix(view: DataFrame, ratings: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Dense grid of star rating and predicted label, zeros included.

    One pass of conditional counts gives one row, which is then unfolded; the
    grid needs no join and exists even for an empty view.
    """
    cells = [(rating, label) for rating in ratings for label in LABELS]
    counted = view.agg(*[
        F.coalesce(count_where((F.col("rating") == rating) & (F.col("pred_label") == label)), F.lit(0)).alias(f"n_{rating}_{label}")
        for rating, label in cells
    ])
    grid = counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(rating).alias("rating_value"),
            F.lit(label).alias("pred_label"),
            F.col(f"n_{rating}_{label}").alias("review_count"),
        )
        for rating, label in cells
    ])))
    return share_within(grid, "rating_value", "review_count", "rate_within_rating")


def share_within(table: DataFrame, group: str, count: str, name: str) -> DataFrame:
    """Share of each row in the total of its group. For aggregated tables only:
    a group is held by one task."""
    total = F.sum(count).over(Window.partitionBy(group))
    return table.withColumn(name, safe_rate(F.col(count), total))


def confidence_buckets(view: DataFrame, buckets: tuple[ConfidenceBucket, ...] = CONFIDENCE_BUCKETS) -> DataFrame:
    """Label counts by score range, empty ranges included.

    All ranges are measured in one pass, as one row that is then unfolded. The
    last range includes its upper bound.
    """
    score, measures = F.col("pred_score"), []
    for order, bucket in enumerate(buckets, 1):
        below = score <= bucket.high if order == len(buckets) else score < bucket.high
        inside = (score >= bucket.low) & below
        measures += [F.count(F.when(inside, 1)).alias(f"n_{order}"), F.avg(F.when(inside, score)).alias(f"avg_{order}")]
        measures += [F.count(F.when(inside & (F.col("pred_label") == label), 1)).alias(f"{label}_{order}") for label in LABELS]
    return view.agg(*measures).select(F.inline(F.array(*[
        F.struct(
            F.lit(bucket.code).alias("bucket_code"), F.lit(order).alias("bucket_order"),
            F.lit(bucket.low).alias("minimum_score"), F.lit(bucket.high).alias("maximum_score"),
            F.col(f"n_{order}").alias("review_count"),
            *[F.col(f"{label}_{order}").alias(f"{label}_count") for label in reversed(LABELS)],
            F.col(f"avg_{order}").alias("average_prediction_score"),
        )
        for order, bucket in enumerate(buckets, 1)
    ])))


def distinct_products(table: DataFrame, key: str = "parent_asin") -> DataFrame:
    return table.filter(~is_blank(key)).agg(F.count_distinct(key).alias("distinct_products"))


def distribution(table: DataFrame, column: str) -> DataFrame:
    """Row count by value, ordered by the value."""
    return table.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def non_null_counts(table: DataFrame, *columns: str) -> DataFrame:
    return table.agg(*[F.count(c).alias(f"{c}_non_null") for c in columns])


def label_distribution(table: DataFrame, column: str = "pred_label") -> DataFrame:
    """One row with the count of each label, zero when absent."""
    return table.agg(*[
        F.coalesce(count_where(F.col(column) == label), F.lit(0)).alias(label) for label in LABELS
    ])


def score_stats(table: DataFrame) -> DataFrame:
    return table.agg(
        F.min("pred_score").alias("score_minimum"),
        F.max("pred_score").alias("score_maximum"),
        F.avg("pred_score").alias("score_mean"),
    )


def duplicate_groups(table: DataFrame, *keys: str) -> DataFrame:
    """Number of keys that occur more than once."""
    return _duplicated(table, keys).agg(F.count(F.lit(1)).alias("duplicate_groups"))


def duplicate_excess(table: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of every duplicated key."""
    return _duplicated(table, keys).agg(F.sum(F.col("n") - 1).alias("duplicate_excess"))


def _duplicated(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
