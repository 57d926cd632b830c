"""Alerts: products, stores and categories whose negative rate is too high."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.settings import AlertPolicy


def _first_level(rate: Column, policy: AlertPolicy, value) -> Column:
    """Value of the most severe level reached, null below all of them."""
    result = F.lit(None)
    for level, threshold in reversed(policy.levels):
        result = F.when(rate >= threshold, F.lit(value(level, threshold))).otherwise(result)
    return result


def _entity_alerts(table: DataFrame, entity: str, key: str, name: str, grain: tuple[str, ...], policy: AlertPolicy) -> DataFrame:
    rate = F.col("negative_rate")
    identity = [F.lit(entity), *[F.coalesce(F.col(c), F.lit("")) for c in grain], F.lit("negative_rate")]
    return table.filter(F.col("review_count") >= policy.min_reviews).select(
        F.sha2(F.concat_ws("|", *identity), 256).alias("alert_id"),
        F.lit(f"{entity}_negative_rate").alias("alert_type"),
        _first_level(rate, policy, lambda level, _: level).cast("string").alias("alert_level"),
        F.lit(entity).alias("entity_type"),
        F.col(key).alias("entity_id"),
        F.col(name).alias("entity_name"),
        F.lit("negative_rate").alias("metric_name"),
        rate.alias("metric_value"),
        _first_level(rate, policy, lambda _, threshold: threshold).cast("double").alias("threshold_value"),
        "review_count",
    ).filter(F.col("alert_level").isNotNull())


def sentiment_alerts(products: DataFrame, stores: DataFrame, categories: DataFrame,
                     policy: AlertPolicy = AlertPolicy()) -> DataFrame:
    """One alert per entity at its most severe level. Thresholds are literals, so no join is needed."""
    parts = [
        _entity_alerts(products, "product", "parent_asin", "product_title",
                       ("parent_asin", "product_title", "store_name", "main_category"), policy),
        _entity_alerts(stores, "store", "store_key", "store_name", ("store_key",), policy),
        _entity_alerts(categories, "category", "category_key", "main_category", ("category_key",), policy),
    ]
    message = F.concat_ws(
        " ", F.col("entity_type"), F.col("entity_id"), F.lit("negative_rate reached"),
        F.col("threshold_value").cast("string"),
    )
    return reduce(DataFrame.unionByName, parts).withColumn("alert_message", message)
