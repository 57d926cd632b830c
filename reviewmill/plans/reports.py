"""Investigation reports as rows: section, position, id, name, value, count.

Each report combines a few short, ordered extracts of the serving tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.plans import serving_queries as serving


def _section(rows: DataFrame, section: str, order: list[Column], key: str, name: str, value: str, count: str,
             first: int | None = None) -> DataFrame:
    """Number the rows of an extract that a limit has already made short."""
    position = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    numbered = rows.withColumn("position", position)
    if first is not None:
        numbered = numbered.filter(F.col("position") <= first)
    return numbered.select(
        F.lit(section).alias("section"), "position",
        F.col(key).cast("string").alias("id"), F.col(name).cast("string").alias("name"),
        F.col(value).cast("double").alias("value"), F.col(count).cast("bigint").alias("count"),
    )


def _metrics(row: DataFrame, names: list[str]) -> DataFrame:
    """Columns of a one-row frame as report rows."""
    cells = [
        F.struct(F.lit("metric").alias("section"), F.lit(i).alias("position"), F.lit(n).alias("id"),
                 F.lit(n).alias("name"), F.col(n).cast("double").alias("value"), F.lit(None).cast("bigint").alias("count"))
        for i, n in enumerate(names, 1)
    ]
    return row.select(F.inline(F.array(*cells)))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _order(label: str, key: tuple[str, ...]) -> list[Column]:
    return [F.desc(f"{label}_rate"), F.desc(f"{label}_count"), F.desc("review_count"), *[F.asc_nulls_first(k) for k in key]]


_PRODUCT_KEY = serving.PRODUCT_GRAIN


def _product_ranking(products: DataFrame) -> DataFrame:
    top = serving.top_negative_products(products, 10, 5).withColumn("name", F.coalesce("product_title", "parent_asin"))
    return _section(top, "ranking", _order("negative", _PRODUCT_KEY), "parent_asin", "name", "negative_rate", "review_count", 3)


def _alert_section(rows: DataFrame, first: int | None = None) -> DataFrame:
    return _section(rows, "alert", serving.alert_order(), "alert_id", "entity_name", "metric_value", "review_count", first)


def _aspect_section(aspects: DataFrame, first: int) -> DataFrame:
    top = aspects.orderBy(F.desc("mention_count"), F.desc("negative_rate"), "aspect_code").limit(first)
    order = [F.desc("mention_count"), F.desc("negative_rate"), F.asc("aspect_code")]
    return _section(top, "aspect", order, "aspect_code", "aspect_name", "negative_rate", "mention_count")


def _reason_section(reasons: DataFrame, first: int, section: str = "reason") -> DataFrame:
    order = [F.desc("mention_count"), F.desc("share_of_negative_reviews"), F.asc("reason_code")]
    top = reasons.orderBy(*order).limit(first)
    return _section(top, section, order, "reason_code", "reason_name", "share_of_negative_reviews", "mention_count")


def _sample_section(samples: DataFrame, first: int = 3) -> DataFrame:
    order = [F.asc("sample_rank"), F.desc("pred_score"), F.asc("sample_id")]
    rows = serving.sample_rows(samples, first, "negative")
    return _section(rows, "sample", order, "sample_id", "review_text_preview", "pred_score", "text_length")


def product_risk(products: DataFrame, alerts: DataFrame, aspects: DataFrame, reasons: DataFrame, samples: DataFrame) -> DataFrame:
    """The riskiest product with at least five reviews; rules and samples are context for the whole scope."""
    top = serving.top_negative_products(products, 1, 5)
    own_alerts = serving.alert_rows(serving.alerts_of(alerts, top, "parent_asin"), 20)
    return _all([
        _metrics(top, ["negative_rate", "negative_count", "review_count", "average_prediction_score"]),
        _product_ranking(products), _alert_section(own_alerts),
        _aspect_section(aspects, 5), _reason_section(reasons, 5), _sample_section(samples),
    ])


def store_risk(stores: DataFrame, alerts: DataFrame) -> DataFrame:
    """The riskiest store with at least twenty reviews."""
    top = serving.top_negative_stores(stores, 1, 20)
    ranking = _section(serving.top_negative_stores(stores, 10, 20), "ranking", _order("negative", ("store_key",)),
                       "store_key", "store_name", "negative_rate", "review_count", 3)
    own_alerts = serving.alert_rows(serving.alerts_of(alerts, top, "store_key"), 20)
    return _all([
        _metrics(top, ["negative_rate", "review_count", "product_count", "average_rating"]),
        ranking, _alert_section(own_alerts),
    ])


def reason_report(reasons: DataFrame, aspects: DataFrame, samples: DataFrame) -> DataFrame:
    return _all([
        _reason_section(reasons, 1, "metric"), _reason_section(reasons, 3, "ranking"),
        _reason_section(reasons, 8), _aspect_section(aspects, 8), _sample_section(samples),
    ])


def confidence_report(buckets: DataFrame) -> DataFrame:
    ranking = _section(buckets, "ranking", [F.asc("bucket_order")], "bucket_code", "bucket_code",
                       "average_prediction_score", "review_count", 3)
    return _all([_metrics(serving.weighted_score(buckets), ["review_count", "weighted_score", "bucket_count"]), ranking])


def trend_report(daily: DataFrame, recent_days: int = 365) -> DataFrame:
    """Change of the negative rate in percentage points over the latest days."""
    ends = serving.first_last(daily.orderBy(F.desc("dt")).limit(recent_days))
    return ends.withColumn("delta_points", F.col("delta") * 100).drop("delta")


def rating_agreement(matrix: DataFrame, rating: int = 1) -> DataFrame:
    """How often reviews with this many stars are predicted negative."""
    negative = F.col("pred_label") == "negative"
    return matrix.filter(F.col("rating_value") == rating).agg(
        F.coalesce(F.sum("review_count"), F.lit(0)).alias("review_count"),
        F.coalesce(F.sum(F.when(negative, F.col("review_count"))), F.lit(0)).alias("negative_count"),
        F.coalesce(F.max(F.when(negative, F.col("rate_within_rating"))), F.lit(0.0)).alias("agreement"),
    )


def batch_summary(overview: DataFrame, products: DataFrame, alerts: DataFrame, aspects: DataFrame,
                  reasons: DataFrame, samples: DataFrame) -> DataFrame:
    return _all([
        _metrics(overview, ["review_count", "positive_rate", "neutral_rate", "negative_rate"]),
        _product_ranking(products), _alert_section(serving.alert_rows(alerts, 5)),
        _aspect_section(aspects, 5), _reason_section(reasons, 5), _sample_section(samples),
    ])


# Fixed values of the health index.
ALERT_WEIGHT, ALERT_PENALTY_LIMIT = 1.1, 15.0
STORE_WEIGHT, STORE_PENALTY_LIMIT, STORES_CONSIDERED = 25.0, 12.0, 3


def health_index(overview: DataFrame, alerts: DataFrame, stores: DataFrame, shown_alerts: int = 12) -> DataFrame:
    """0..100, higher is healthier: the non-negative share less penalties for alerts and risky stores.

    The three inputs are one row each; they meet in one aggregate, not a join.
    """
    severe = F.lower("alert_level").isin("high", "critical")
    rate = overview.select(F.col("negative_rate").alias("rate"))
    high = serving.alert_rows(alerts, shown_alerts).agg(F.count(F.when(severe, 1)).alias("high"))
    store = serving.top_negative_stores(stores, STORES_CONSIDERED, 20).agg(F.avg("negative_rate").alias("store"))
    merged = rate.unionByName(high, allowMissingColumns=True).unionByName(store, allowMissingColumns=True).agg(
        F.coalesce(F.max("rate"), F.lit(0.0)).alias("rate"),
        F.coalesce(F.max("high"), F.lit(0)).alias("high"),
        F.coalesce(F.max("store"), F.lit(0.0)).alias("store"),
    )
    parts = merged.select(
        ((1 - F.col("rate")) * 100).alias("base"),
        F.least(F.lit(ALERT_PENALTY_LIMIT), F.col("high") * ALERT_WEIGHT).alias("alert_penalty"),
        F.least(F.lit(STORE_PENALTY_LIMIT), F.col("store") * STORE_WEIGHT).alias("store_penalty"),
    )
    index = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("base") - F.col("alert_penalty") - F.col("store_penalty")))
    return parts.withColumn("health_index", index)


def reconcile_overview(overview: DataFrame, predictions: DataFrame) -> DataFrame:
    """Reviews of each overview next to the number of its predictions."""
    scope = ["load_batch_id", "model_version"]
    counted = predictions.groupBy(*scope).agg(F.count(F.lit(1)).alias("prediction_count"))
    return overview.join(counted, scope).select(*scope, F.col("review_count").alias("overview_count"), "prediction_count")
