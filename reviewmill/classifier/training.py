"""Training, model choice, out-of-fold scoring and inference."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.classifier.features import FeatureModel, FeatureSettings, learn_from_terms, learn_without, learn_without_each, with_terms
from reviewmill.classifier.fitting import Goal, fitted
from reviewmill.classifier.metrics import classification_metrics
from reviewmill.classifier.packed import class_scores, packed, scored
from reviewmill.classifier.split import TEST, TRAIN, VALIDATION, stratified_folds, stratified_split
from reviewmill.schemas import LABELS
from reviewmill.session import scratch_path

# Fixed values of the training contract.
C_GRID = (0.5, 1.0, 2.0)
MAX_ITERATIONS = 1000
FOLDS = 5


def label_number(c: str) -> Column:
    """Position of the label in the fixed vocabulary, -1 for any other."""
    return (F.coalesce(F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col(c)), F.lit(0)) - 1).cast("int")


def with_balanced_weights(table: DataFrame, label: str) -> DataFrame:
    """Add ``weight``: all rows / (labels in use * rows of the label). At most one row per known label comes to the driver."""
    known = table.filter(F.col(label).isin(*LABELS)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts = {r[label]: r["n"] for r in known.collect()}
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for name, n in counts.items():
        weight = F.when(F.col(label) == name, F.lit(total / (len(counts) * n))).otherwise(weight)
    return table.withColumn("weight", weight)


@dataclass
class SentimentModel:
    features: FeatureModel
    regression: LogisticRegressionModel
    text: str = "review_text_clean"

    def score(self, table: DataFrame) -> DataFrame:
        """Add label, score and class scores to unseen reviews; batch or stream."""
        scores = class_scores(self.features, *self.classes())
        return to_predictions(with_terms(table, self.text).withColumn("_scores", scores("terms"))).drop("terms", "_scores")

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients and intercepts by class."""
        return self.regression.coefficientMatrix.toArray(), self.regression.interceptVector.toArray()

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        self.regression.write().overwrite().save(f"{path}/regression")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SentimentModel:
        return SentimentModel(FeatureModel.load(spark, f"{path}/features"), LogisticRegressionModel.load(f"{path}/regression"))


def to_predictions(scored: DataFrame, scores: str = "_scores") -> DataFrame:
    """Label of the largest class score, that score, and all three."""
    values = F.col(scores)
    best = F.array_max(values)
    names = F.array(*[F.lit(label) for label in LABELS])
    return scored.withColumns({
        "pred_label": F.element_at(names, F.array_position(values, best).cast("int")),
        "pred_score": best,
        **{f"{label}_score": values[i] for i, label in enumerate(LABELS)},
    })


def prediction_output(predictions: DataFrame, model_version: str) -> DataFrame:
    """Prediction rows in the contract form: key, label, scores, version, UTC time."""
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return predictions.select(
        "review_key", "pred_label", "pred_score", *[f"{label}_score" for label in LABELS],
        F.lit(model_version).alias("model_version"), at.alias("inferred_at"),
    )


def fit(train: DataFrame, c: float = 0.5, text: str = "review_text_clean", label: str = "rating_label",
        max_iterations: int = MAX_ITERATIONS, settings: FeatureSettings = FeatureSettings()) -> SentimentModel:
    """Rows whose label is none of the known ones teach nothing and are left out. The text is cut into words once."""
    spark, path = train.sparkSession, scratch_path(train.sparkSession, "words")
    cut = with_terms(train.filter(F.col(label).isin(*LABELS)).select(text, label), text)
    cut.select("terms", label_number(label).alias("_label"), F.lit(0).alias("_part")).write.parquet(path)
    terms = spark.read.schema("terms STRING, _label INT, _part INT").parquet(path)
    features = learn_from_terms(terms.select("terms"), settings)
    counted = packed(terms, [features], ("_label", "_part"))
    return _fit_all(counted, [Goal(features, 0, _rows(terms, {0}), c)], text, max_iterations)[0]


def _rows(terms: DataFrame, parts: set[int]) -> dict[int, np.ndarray]:
    """Rows of each of ``parts`` by label. One row per part and label comes to the driver."""
    found = {p: np.zeros(len(LABELS), np.int64) for p in parts}
    for r in terms.filter((F.col("_label") >= 0) & F.col("_part").isin(*parts)).groupBy("_part", "_label").agg(F.count(F.lit(1)).alias("n")).collect():
        found[r["_part"]][r["_label"]] = r["n"]
    return found


def _fit_all(counted: DataFrame, goals: list[Goal], text: str, max_iterations: int) -> list[SentimentModel]:
    """One model per goal over the packed counts, fitted together."""
    return [SentimentModel(g.features, _regression(*found), text) for g, found in zip(goals, fitted(counted, goals, max_iterations))]


def _regression(coefficients: np.ndarray, intercepts: np.ndarray) -> LogisticRegressionModel:
    rows, columns = coefficients.shape
    return LogisticRegressionModel._create_from_java_class(
        "org.apache.spark.ml.classification.LogisticRegressionModel", "logreg",
        DenseMatrix(rows, columns, coefficients.ravel(order="F")), DenseVector(intercepts), rows, True)


@dataclass
class Selection:
    c: float
    model: SentimentModel
    validation: list[dict]
    test: dict


def select_c(table: DataFrame, grid: tuple[float, ...] = C_GRID, key: str = "review_key", text: str = "review_text_clean",
             label: str = "rating_label", seed: int = 42, max_iterations: int = MAX_ITERATIONS,
             settings: FeatureSettings = FeatureSettings()) -> Selection:
    """Choose C by validation macro-F1, then accuracy; refit without the test part; test once."""
    # The text is cut into words once, for statistics of all three parts and for counts that all fits and scores read, as for folds.
    parts = (TRAIN, VALIDATION, TEST)
    number = (F.array_position(F.array(*[F.lit(p) for p in parts]), F.col("split")) - 1).cast("int")
    split = stratified_split(table.select(key, text, label), key, label, seed)
    terms = _cut(split.select(text, label, number.alias("_part")), text, label, label)
    features = learn_without(terms.filter("_label >= 0").select("_part", "terms"), "_part", 3, [{1, 2}, {2}], settings)
    kept = packed(terms, features, ("_label", "_part"), (label,))

    def metrics(model: SentimentModel, number: int, part: int) -> dict:
        rows = scored(kept, {}, (label,), {part: (number, model.features, *model.classes())}, "_part")
        return classification_metrics(to_predictions(rows), label).first().asDict()

    rows = _rows(terms, {0, 1})
    models = _fit_all(kept, [Goal(features[0], 0, {0: rows[0]}, c) for c in grid], text, max_iterations)
    results = [{"c": c, **metrics(model, 0, 1)} for c, model in zip(grid, models)]
    best = max(results, key=lambda r: (r["macro_f1"], r["accuracy"]))["c"]
    final = _fit_all(kept, [Goal(features[1], 1, rows, best)], text, max_iterations)[0]
    return Selection(best, final, results, metrics(final, 1, 2))


def _cut(table: DataFrame, text: str, label: str, *kept: str) -> DataFrame:
    """``terms``, ``_label`` by number, ``_part`` and the ``kept`` columns of ``table``, whose text is cut into words once: a written table, which outlives lost executors."""
    path = scratch_path(table.sparkSession, "words")
    cut = with_terms(table, text).select("terms", label_number(label).alias("_label"), "_part", F.struct(*dict.fromkeys(kept)).alias("_kept"))
    cut.write.parquet(path)
    return table.sparkSession.read.schema(cut.schema).parquet(path).select("terms", "_label", "_part", "_kept.*")


def oof_predictions(table: DataFrame, c: float = 0.5, folds: int = FOLDS, key: str = "review_key",
                    text: str = "review_text_clean", label: str = "rating_label", seed: int = 42,
                    max_iterations: int = MAX_ITERATIONS, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """Score every row once, with a model that did not see it in training.

    The text is cut into words once. Terms are counted by fold, from which the vocabulary and frequencies without
    each fold follow by subtraction, and packed as counts that all fits and scores read. The folds are fitted together.
    """
    folded = stratified_folds(table.select(key, text, label), folds, key, label, seed)
    terms = _cut(folded.withColumnRenamed("fold", "_part"), text, label, key, label)
    features = learn_without_each(terms.filter("_label >= 0").select("_part", "terms"), "_part", folds, settings)
    kept = packed(terms, features, ("_label", "_part"), (key, label))
    rows = _rows(terms, set(range(folds)))
    goals = [Goal(features[fold], fold, {p: n for p, n in rows.items() if p != fold}, c) for fold in range(folds)]
    models = _fit_all(kept, goals, text, max_iterations)
    by_fold = {fold: (fold, model.features, *model.classes()) for fold, model in enumerate(models)}
    return to_predictions(scored(kept, {"_part": "fold"}, (key, label), by_fold, "_part")).drop("_scores")
