"""Read queries over the serving tables.

Every function takes a serving table already narrowed to one batch and model
and returns a DataFrame. Rankings end with a unique key, so that ties always
come out in the same order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.labels import level_rank
from reviewmill.functions.text import equals_ignore_case

PRODUCT_GRAIN = ("parent_asin", "product_title", "store_name", "main_category")


def positive(value: int) -> int:
    """A number of rows to return; what is asked for is returned, whatever its size."""
    if int(value) < 1:
        raise ValueError("the limit must be at least 1")
    return int(value)


def min_reviews(table: DataFrame, n: int) -> DataFrame:
    return table.filter(F.col("review_count") >= n)


def between_dates(table: DataFrame, start: str | None = None, end: str | None = None, column: str = "dt") -> DataFrame:
    """Inclusive range of ISO dates held as text; either end may be open."""
    if start:
        table = table.filter(F.col(column) >= start)
    if end:
        table = table.filter(F.col(column) <= end)
    return table


def _ranked(table: DataFrame, label: str, keys: tuple[str, ...]) -> list[Column]:
    return [F.desc(f"{label}_rate"), F.desc(f"{label}_count"), F.desc("review_count"),
            *[F.asc_nulls_first(key) for key in keys]]


def _top(table: DataFrame, label: str, keys: tuple[str, ...], limit: int, least: int) -> DataFrame:
    return min_reviews(table, least).orderBy(*_ranked(table, label, keys)).limit(positive(limit))


def kpi(overview: DataFrame) -> DataFrame:
    """The overview row of the scope. No row at all is an error, never a row of zeros."""
    found = overview.agg(F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in overview.columns])
    guard = F.when(F.col("rows") == 0, F.raise_error(F.lit("the overview has no row for this batch and model")))
    checked = found.withColumn("_ok", F.coalesce(guard.cast("boolean"), F.lit(True)))
    return checked.filter("_ok").select(*overview.columns)


def top_negative_products(products: DataFrame, limit: int = 10, least_reviews: int = 1) -> DataFrame:
    return _top(products, "negative", PRODUCT_GRAIN, limit, least_reviews)


def top_positive_products(products: DataFrame, limit: int = 10, least_reviews: int = 5) -> DataFrame:
    shown = ("parent_asin", "product_title", "store_name", "main_category", "review_count", "average_rating",
             "positive_count", "positive_rate", "neutral_rate", "negative_rate", "average_prediction_score")
    return _top(products, "positive", PRODUCT_GRAIN, limit, least_reviews).select(*shown)


def top_negative_stores(stores: DataFrame, limit: int = 10, least_reviews: int = 20) -> DataFrame:
    return _top(stores, "negative", ("store_key",), limit, least_reviews)


def top_positive_stores(stores: DataFrame, limit: int = 10, least_reviews: int = 20) -> DataFrame:
    shown = ("store_key", "store_name", "review_count", "product_count", "average_rating", "positive_count",
             "positive_rate", "neutral_rate", "negative_rate", "average_prediction_score")
    return _top(stores, "positive", ("store_key",), limit, least_reviews).select(*shown)


def trend(daily: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None,
          recent_days: int | None = None) -> DataFrame:
    """Days in order. ``recent_days`` keeps the latest n rows, not n calendar days."""
    days = between_dates(daily, start, end)
    if recent_days is not None and recent_days > 0:
        return days.orderBy(F.desc("dt")).limit(recent_days).orderBy("dt")
    days = days.orderBy("dt")
    return days if limit is None else days.limit(limit)


def monthly_trend(monthly: DataFrame, last: int | None = None) -> DataFrame:
    if last is None:
        return monthly.orderBy("month_id")
    return monthly.orderBy(F.desc("month_id")).limit(positive(last)).orderBy("month_id")


def categories(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("review_count"), "category_key")


def verified_purchase(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("review_count"), "purchase_status")


def rating_matrix_rows(table: DataFrame) -> DataFrame:
    return table.orderBy("rating_value", "pred_label")


def confidence_rows(table: DataFrame) -> DataFrame:
    return table.orderBy("bucket_order")


def aspect_rows(aspects: DataFrame, aspect: str | None = None) -> DataFrame:
    """Aspects by mentions under their display names; optionally one code or name."""
    if aspect:
        aspects = aspects.filter(equals_ignore_case("aspect_code", aspect) | equals_ignore_case("aspect_name", aspect))
    ordered = aspects.orderBy(F.desc("mention_count"), F.desc("negative_rate"), "aspect_code")
    renamed = {
        "aspect": "aspect_code", "reason_code": "aspect_code", "reason_name": "aspect_name",
        "average_confidence": "average_prediction_score", "extractor_version": "rule_version",
    }
    return ordered.withColumns({new: F.col(old) for new, old in renamed.items()}).drop("aspect_code", "aspect_name")


def reason_rows(reasons: DataFrame, limit: int = 20, parent_asin: str | None = None) -> DataFrame:
    """Reasons by mentions. They exist for the whole scope only: any product filter gives no rows."""
    if parent_asin and parent_asin.strip():
        reasons = reasons.filter(F.lit(False))
    ordered = reasons.orderBy(F.desc("mention_count"), F.desc("share_of_negative_reviews"), "reason_code").limit(limit)
    return ordered.withColumns({
        "parent_asin": F.lit(""), "product_title": F.lit(""), "aspect": F.lit(""),
        "reason_count": F.col("mention_count"), "reason_share": F.col("share_of_negative_reviews"),
        "extractor_version": F.col("rule_version"),
    })


def alert_order() -> list[Column]:
    return [level_rank("alert_level"), F.desc("metric_value"), F.asc("alert_id")]


def alert_rows(alerts: DataFrame, limit: int = 20, level: str | None = None) -> DataFrame:
    if level:
        alerts = alerts.filter(equals_ignore_case("alert_level", level))
    return alerts.orderBy(*alert_order()).limit(positive(limit))


def sample_rows(samples: DataFrame, limit: int = 20, label: str | None = None) -> DataFrame:
    if label:
        samples = samples.filter(equals_ignore_case("pred_label", label))
    return samples.orderBy("sample_rank", F.desc("pred_score"), "sample_id").limit(positive(limit))


def high_and_critical(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """The critical alerts, then the high ones, cut to ``limit`` in total."""
    both = alert_rows(alerts, limit, "CRITICAL").unionByName(alert_rows(alerts, limit, "HIGH"))
    return both.orderBy(*alert_order()).limit(limit)


def alerts_of(alerts: DataFrame, entity: DataFrame, key: str) -> DataFrame:
    """Alerts of the entities in a ranking that was cut by ``limit``; its keys are few by construction."""
    keys = entity.select(F.col(key).alias("entity_id")).distinct()
    return alerts.join(F.broadcast(keys), "entity_id", "left_semi")


def top_aspects(aspects: DataFrame, limit: int = 8) -> DataFrame:
    """Aspects with the most negative reviews."""
    summed = aspects.groupBy("aspect_code").agg(F.sum("negative_count").alias("negative_count"))
    return summed.orderBy(F.desc("negative_count"), "aspect_code").limit(limit)


def weighted_score(buckets: DataFrame) -> DataFrame:
    """Mean score over buckets weighted by their reviews; 0.0 when there are none."""
    weighted = F.sum(F.coalesce(F.col("average_prediction_score"), F.lit(0.0)) * F.col("review_count"))
    total = F.sum("review_count")
    score = F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0.0)).otherwise(weighted / total)
    return buckets.agg(
        F.coalesce(total, F.lit(0)).alias("review_count"),
        score.alias("weighted_score"),
        F.count(F.lit(1)).alias("bucket_count"),
    )


def first_last(days: DataFrame) -> DataFrame:
    """Negative rate of the first and the last day, and the change between them."""
    ends = days.agg(
        F.min_by("negative_rate", "dt").alias("first_rate"),
        F.max_by("negative_rate", "dt").alias("last_rate"),
        F.count(F.lit(1)).alias("points"),
    )
    return ends.withColumn("delta", F.coalesce("last_rate", F.lit(0.0)) - F.coalesce("first_rate", F.lit(0.0)))


def latest_point(rows: DataFrame, time: str = "dt", rate: str = "negative_rate") -> DataFrame:
    """Latest row whose rate is a number."""
    valid = rows.filter(F.col(rate).isNotNull() & ~F.isnan(rate))
    return valid.orderBy(F.desc(time)).limit(1).select(time, rate)


def health_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each serving table, and the reviews the overview speaks for."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in tables.items()
    ]
    if "dws_sentiment_overview" in tables:
        reviews = tables["dws_sentiment_overview"].agg(F.coalesce(F.sum("review_count"), F.lit(0)).alias("rows"))
        counts.append(reviews.select(F.lit("review_count").alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, counts)
