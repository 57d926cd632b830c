"""Exact stratified splits that no task holds a whole label for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.ranking import distributed_rank

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def stratified_split(table: DataFrame, key: str = "review_key", label: str = "rating_label", seed: int = 42,
                     train: float = 0.8, validation_of_rest: float = 0.5) -> DataFrame:
    """Add ``split``: the first part of every label trains, half of the rest validates, the others test."""
    ranked = distributed_rank(table, label, key, seed, rank="_rank", total="_total")
    for_training = F.floor(F.col("_total") * train)
    for_validation = F.floor((F.col("_total") - for_training) * validation_of_rest)
    split = (
        F.when(F.col("_rank") <= for_training, F.lit(TRAIN))
        .when(F.col("_rank") <= for_training + for_validation, F.lit(VALIDATION))
        .otherwise(F.lit(TEST))
    )
    return ranked.withColumn("split", split).drop("_rank", "_total")


def stratified_folds(table: DataFrame, folds: int = 5, key: str = "review_key", label: str = "rating_label",
                     seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1; the folds of a label differ by at most one row."""
    ranked = distributed_rank(table, label, key, seed, rank="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")
