"""Classification metrics from the confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.schemas import LABELS


def confusion_matrix(predictions: DataFrame, label: str = "rating_label", predicted: str = "pred_label") -> DataFrame:
    """Dense count of every pair of actual and predicted label."""
    cells = [(actual, guess) for actual in LABELS for guess in LABELS]
    row = predictions.agg(*[
        F.count(F.when((F.col(label) == actual) & (F.col(predicted) == guess), 1)).alias(f"{actual}_{guess}")
        for actual, guess in cells
    ])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(actual).alias("actual"), F.lit(guess).alias("predicted"), F.col(f"{actual}_{guess}").alias("row_count"))
        for actual, guess in cells
    ])))


def class_metrics(predictions: DataFrame, label: str = "rating_label", predicted: str = "pred_label") -> DataFrame:
    """Precision, recall, F1 and support of each label; 0.0 where undefined."""
    cells = confusion_matrix(predictions, label, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("row_count")).otherwise(0)
    # Nine cells become one row per label by giving each cell to both its labels.
    sides = cells.select(
        F.explode(F.array(F.struct(F.lit("actual").alias("side"), F.col("actual").alias("label")),
                          F.struct(F.lit("predicted").alias("side"), F.col("predicted").alias("label")))).alias("s"),
        "row_count", hit.alias("hit"),
    ).select("s.side", "s.label", "row_count", "hit")

    def total(side: str, value: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col(value)).otherwise(0))

    sums = sides.groupBy("label").agg(
        total("actual", "hit").alias("hits"), total("actual", "row_count").alias("support"),
        total("predicted", "row_count").alias("predicted_count"),
    )
    rated = sums.withColumns({"precision": safe_rate("hits", "predicted_count"), "recall": safe_rate("hits", "support")})
    # F1 from counts: twice the hits over all rows that either side gives the label.
    f1 = safe_rate(2 * F.col("hits"), F.col("support") + F.col("predicted_count"))
    return rated.withColumn("f1", f1).select("label", "precision", "recall", "f1", "support", "predicted_count", "hits")


def classification_metrics(predictions: DataFrame, label: str = "rating_label", predicted: str = "pred_label") -> DataFrame:
    """One row: accuracy, macro and weighted precision, recall and F1."""
    classes = class_metrics(predictions, label, predicted)

    def weighted(c: str) -> Column:
        return safe_rate(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return classes.agg(
        F.sum("support").alias("row_count"),
        safe_rate(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )
