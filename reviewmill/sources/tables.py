"""Partitioned Parquet tables: cleaned reviews, predictions and serving tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators import aggregates as agg
from reviewmill.operators import partials
from reviewmill.operators.alerts import sentiment_alerts
from reviewmill.operators.ranking import review_samples
from reviewmill.operators.rules import aspect_summary, negative_reasons
from reviewmill.schemas import SERVING_TABLES
from reviewmill.settings import ASPECT_RULES, REASON_RULES, AlertPolicy, RuleSet


def write_clean(reviews: DataFrame, path: str) -> None:
    """Replace the (batch, year) partitions that occur in ``reviews``.

    Years that receive no row keep their old files; drop the batch folder first
    when a batch is reloaded with fewer years. Rows are rebalanced by year, so
    that a small year is one file and a year of any size is cut into files of
    the advised partition size, written in parallel.
    """
    balanced = reviews.hint("rebalance", F.col("load_batch_id"), F.col("review_year"))
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_batch_id", "review_year").parquet(path)


def overwrite_partition(table: DataFrame, path: str, spec: dict[str, str]) -> None:
    """Replace exactly one partition, named by literal values; others stay as they are."""
    stamped = table.withColumns({name: F.lit(value) for name, value in spec.items()})
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*spec).parquet(path)


def guard_version(spark: SparkSession, path: str, spec: dict[str, str], force: bool = False) -> None:
    """Refuse to import a partition that already has rows, unless forced."""
    if force:
        return
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    for name, value in spec.items():
        rows = rows.filter(F.col(name) == value)
    if rows.limit(1).count():
        raise ValueError(f"partition {spec} exists; pass force=True to replace it")


def build_export(handoff: DataFrame, path: str) -> DataFrame:
    """Recreate the isolated classifier-input table and return it as written."""
    handoff.write.mode("overwrite").parquet(path)
    return handoff.sparkSession.read.parquet(path)


def partitions(table: DataFrame, *columns: str) -> DataFrame:
    return table.select(*columns).distinct().orderBy(*columns)


def serving_table(spark: SparkSession, root: str, name: str, batch: str, model: str) -> DataFrame:
    """One serving table of one batch and model; other names are refused."""
    if name not in SERVING_TABLES:
        raise ValueError(f"unknown serving table {name}")
    return agg.scope(spark.read.parquet(f"{root}/{name}"), batch, model)


def build_serving(view: DataFrame, aspect_rules: RuleSet = ASPECT_RULES, reason_rules: RuleSet = REASON_RULES,
                  policy: AlertPolicy = AlertPolicy()) -> dict[str, DataFrame]:
    """All serving tables of a view that is narrowed to one batch and model.

    The view must carry ``review_text_clean``; tables that do not use the text
    do not read it. Partials of days and products are written on the way.
    """
    summed = partials.serving_tables(view)
    alerts = sentiment_alerts(*[summed[f"dws_{entity}_sentiment"] for entity in ("product", "store", "category")], policy)
    return summed | {
        "dws_verified_purchase_sentiment": agg.verified_sentiment(view),
        "dws_rating_prediction_matrix": agg.rating_matrix(view),
        "dws_prediction_confidence": agg.confidence_buckets(view),
        "dws_sentiment_alerts": alerts,
        "dws_review_samples": review_samples(view),
        "dws_aspect_summary": aspect_summary(view, aspect_rules),
        "dws_negative_reasons": negative_reasons(view, reason_rules),
    }


def publish(view: DataFrame, root: str, batch: str, model: str, **options) -> list[str]:
    """Build and write all serving tables of one scope.

    The joined view is written once, and read by column from there; a lost executor costs nothing that was
    written. Six tables come from one table of partials, alerts from the product, store and
    category tables just written.
    """
    spark = view.sparkSession
    scoped = partials.kept(agg.scope(view, batch, model), "serving-view")
    spec = {"load_batch_id": batch, "model_version": model}
    tables = build_serving(scoped, **options)
    for name, table in tables.items():
        if name == "dws_sentiment_alerts":
            written = [serving_table(spark, root, t, batch, model)
                       for t in ("dws_product_sentiment", "dws_store_sentiment", "dws_category_sentiment")]
            table = sentiment_alerts(*written, options.get("policy", AlertPolicy()))
        overwrite_partition(agg.stamp(table, batch, model), f"{root}/{name}", spec)
    return list(tables)


def write_jdbc(table: DataFrame, url: str, name: str, properties: dict[str, str]) -> None:
    """Optional copy of a serving table into a relational store the caller runs."""
    table.write.jdbc(url, name, mode="append", properties=properties)
