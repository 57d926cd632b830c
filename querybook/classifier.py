"""The text classifier: splits, features, training, scoring, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.fixtures import review_view, text_view
from querybook.registry import common_table, query
from reviewmill.classifier import metrics, training
from reviewmill.classifier.features import fit_features
from reviewmill.classifier.split import stratified_folds, stratified_split

# The label's word stands before the text and after every blank, so that the right
# prediction of every row is known.
_PLANTED = {"negative": "awful", "neutral": "middling", "positive": "lovely"}


def _labelled(spark, sf):
    word = F.lit(None).cast("string")
    for label, planted in _PLANTED.items():
        word = F.when(F.col("rating_label") == label, F.lit(planted)).otherwise(word)
    body = F.replace(F.coalesce("review_text_clean", F.lit("")), F.lit(" "), F.concat(F.lit(" "), word, F.lit(" ")))
    return text_view(spark, sf).select("review_key", F.concat(word, F.lit(" "), body).alias("review_text_clean"), "rating_label")


@query("stratified_split", """SELECT rating_label, split, CASE split WHEN 'train' THEN train WHEN 'validation' THEN (n - train) // 2 ELSE n - train - (n - train) // 2 END AS row_count
  FROM (SELECT rating_label, COUNT(*) AS n, CAST(floor(COUNT(*) * 0.8::DOUBLE) AS BIGINT) AS train FROM text_view GROUP BY 1) t,
       (SELECT unnest(['train', 'validation', 'test']) AS split) s""")
def _split(spark, sf):
    parts = stratified_split(text_view(spark, sf).select("review_key", "rating_label"))
    return parts.groupBy("rating_label", "split").agg(F.count(F.lit(1)).alias("row_count"))


@query("stratified_folds", """SELECT rating_label, fold, COUNT(*) AS row_count FROM (SELECT rating_label,
  CAST((ROW_NUMBER() OVER (PARTITION BY rating_label ORDER BY review_key) - 1) % 5 AS INTEGER) AS fold FROM text_view) f GROUP BY ALL""")
def _folds(spark, sf):
    folded = stratified_folds(text_view(spark, sf).select("review_key", "rating_label"))
    return folded.groupBy("rating_label", "fold").agg(F.count(F.lit(1)).alias("row_count"))


common_table("words", r"""SELECT review_key, regexp_extract_all(strip_accents(lower(review_text_clean)), '[\p{L}\p{N}_]{2,}') AS w FROM text_view""")
common_table("term_counts", """SELECT review_key, term, COUNT(*) AS tf FROM (SELECT review_key,
  unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS term FROM words) t GROUP BY ALL""")
common_table("term_weights", """SELECT term, ln((SELECT COUNT(*) + 1 FROM text_view) / (COUNT(*) + 1)::DOUBLE) + 1 AS idf FROM term_counts
  GROUP BY term HAVING COUNT(*) >= 2 AND COUNT(*) <= 0.98 * (SELECT COUNT(*) FROM text_view) ORDER BY SUM(tf) DESC, term LIMIT 50000""")


@query("tfidf_features", """SELECT v.review_key, COUNT(x) AS feature_count, round(COALESCE(MAX(x) / sqrt(SUM(x * x)), 0), 9) AS largest,
  round(COALESCE(SUM(x) / sqrt(SUM(x * x)), 0), 6) AS total FROM text_view v
  LEFT JOIN (SELECT review_key, (1 + ln(tf)) * idf AS x FROM term_counts JOIN term_weights USING (term)) f ON f.review_key = v.review_key GROUP BY v.review_key""")
def _features(spark, sf):
    table = text_view(spark, sf).select("review_key", "review_text_clean")
    model = fit_features(table, "review_text_clean")
    # The stored entries of the sparse vectors only.
    made = model.transform(table, "review_text_clean").select("review_key", F.unwrap_udt("features")["values"].alias("x"))
    return made.select(
        "review_key", F.size("x").alias("feature_count"), F.round(F.coalesce(F.array_max("x"), F.lit(0.0)), 9).alias("largest"),
        F.round(F.aggregate("x", F.lit(0.0), lambda total, v: total + v), 6).alias("total"))


def _model(spark, sf):
    return training.fit(_labelled(spark, sf))


def _keeps_contract():
    """The scores sum up to 1, and the label is that of the largest, whose score is stated."""
    scores = [F.col(f"{label}_score") for label in _PLANTED]
    own = F.when(F.col("pred_label") == "negative", scores[0]).when(F.col("pred_label") == "neutral", scores[1]).otherwise(scores[2])
    right = (F.abs(scores[0] + scores[1] + scores[2] - 1) < 1e-6) & (own == F.greatest(*scores)) & (own == F.col("pred_score"))
    return right.alias("keeps_contract")


_RIGHT = ", ".join(f"1.0::DOUBLE AS {m}" for m in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"))


@query("logistic_regression", f"SELECT COUNT(*) AS row_count, {_RIGHT} FROM text_view")
def _regression(spark, sf):
    row = metrics.classification_metrics(_model(spark, sf).score(_labelled(spark, sf)))
    return row.select("row_count", *[F.round(c, 9).alias(c) for c in row.columns if c != "row_count"])


@query("select_c", """SELECT c, CAST(SUM((n - CAST(floor(n * 0.8::DOUBLE) AS BIGINT)) // 2) AS BIGINT) AS row_count, 1.0::DOUBLE AS macro_f1, 1.0::DOUBLE AS accuracy, c = 0.5 AS chosen
  FROM (SELECT unnest([0.5::DOUBLE, 1.0, 2.0]) AS c) grid, (SELECT COUNT(*) AS n FROM text_view GROUP BY rating_label) l GROUP BY c""")
def _select(spark, sf):
    found = training.select_c(_labelled(spark, sf))
    return spark.createDataFrame(
        [(r["c"], r["row_count"], round(r["macro_f1"], 9), round(r["accuracy"], 9), r["c"] == found.c) for r in found.validation],
        "c double, row_count bigint, macro_f1 double, accuracy double, chosen boolean")


_KNOWN = "SELECT review_key, rating_label, rating_label AS pred_label, true AS keeps_contract FROM text_view"


@query("oof_predictions", _KNOWN)
def _oof(spark, sf):
    return training.oof_predictions(_labelled(spark, sf)).select("review_key", "rating_label", "pred_label", _keeps_contract())


@query("batch_inference", _KNOWN)
def _inference(spark, sf):
    return _model(spark, sf).score(_labelled(spark, sf)).select("review_key", "rating_label", "pred_label", _keeps_contract())


@query("prediction_output", """SELECT review_key, rating_label AS pred_label, true AS keeps_contract, 'tfidf_logreg_v1' AS model_version, true AS utc_time FROM text_view""")
def _output(spark, sf):
    from reviewmill.functions.times import parse_utc

    rows = training.prediction_output(_model(spark, sf).score(_labelled(spark, sf)), "tfidf_logreg_v1")
    return rows.select("review_key", "pred_label", _keeps_contract(), "model_version", parse_utc("inferred_at").isNotNull().alias("utc_time"))


common_table("class_rows", """SELECT label, COUNT(*) FILTER (rating_label = label AND pred_label = label) AS hits,
  COUNT(*) FILTER (rating_label = label) AS support, COUNT(*) FILTER (pred_label = label) AS predicted_count
  FROM review_view, (SELECT unnest(['negative', 'neutral', 'positive']) AS label) l GROUP BY label""")
common_table("class_rates", """SELECT *, hits::DOUBLE / predicted_count AS precision, hits::DOUBLE / support AS recall,
  (2 * hits)::DOUBLE / (support + predicted_count) AS f1 FROM class_rows""")


@query("confusion_matrix", "SELECT rating_label AS actual, pred_label AS predicted, COUNT(*) AS row_count FROM review_view GROUP BY ALL")
def _confusion(spark, sf):
    return metrics.confusion_matrix(review_view(spark, sf))


@query("class_metrics", "SELECT label, precision, recall, f1, support, predicted_count, hits FROM class_rates")
def _class_metrics(spark, sf):
    return metrics.class_metrics(review_view(spark, sf))


@query("classification_metrics", """SELECT CAST(SUM(support) AS BIGINT) AS row_count, round(SUM(hits)::DOUBLE / SUM(support)::DOUBLE, 9) AS accuracy,
  round(AVG(precision), 9) AS macro_precision, round(AVG(recall), 9) AS macro_recall, round(AVG(f1), 9) AS macro_f1,
  round(SUM(precision * support) / SUM(support), 9) AS weighted_precision, round(SUM(recall * support) / SUM(support), 9) AS weighted_recall,
  round(SUM(f1 * support) / SUM(support), 9) AS weighted_f1 FROM class_rates""")
def _metrics(spark, sf):
    row = metrics.classification_metrics(review_view(spark, sf))
    return row.select("row_count", *[F.round(c, 9).alias(c) for c in row.columns if c != "row_count"])
