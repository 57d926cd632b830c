"""Prediction JSON lines: read with an open schema, check, stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.labels import is_label
from reviewmill.functions.once import computed_once
from reviewmill.functions.text import missing_or_blank
from reviewmill.functions.times import parse_utc
from reviewmill.functions.variants import JsonField, open_fields
from reviewmill.operators.predictions import codes, field_name_errors
from reviewmill.schemas import MODEL_VERSION_PATTERN, PREDICTION_OPTIONAL
from reviewmill.session import scratch_path
from reviewmill.sources.delimited import write_staging
from reviewmill.sources.lines import BLANK, MALFORMED, NON_OBJECT, OBJECT, classify, number_lines, read_lines

_CONTROL = "[\\x01\\r\\n\\t]"


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Numbered, classified lines of a prediction file."""
    return classify(number_lines(read_lines(spark, path)))


def _score_ok(name: str) -> Column:
    """JSON number between 0 and 1; numbers given as text do not count."""
    is_number = F.col(f"_kind_{name}").isin("integer", "number")
    return F.coalesce(is_number & F.col(name).between(0.0, 1.0), F.lit(False))


def _record_errors(model: str) -> Column:
    """Error codes of one JSON object against the closed prediction schema."""
    version = F.col("model_version")
    version_blank = missing_or_blank("model_version")
    safe = version.rlike(MODEL_VERSION_PATTERN)
    optional_bad = F.lit(False)
    for name in PREDICTION_OPTIONAL:
        given = F.coalesce(F.col(f"_kind_{name}"), F.lit("null")) != "null"
        optional_bad = optional_bad | (given & ~_score_ok(name))
    values = codes({
        "invalid_review_key": missing_or_blank("review_key") | F.col("review_key").rlike(_CONTROL),
        "invalid_label": ~is_label("pred_label"),
        "invalid_score": ~_score_ok("pred_score"),
        "invalid_optional_score": optional_bad,
        "blank_model_version": version_blank,
        "unsafe_model_version": ~version_blank & ~safe,
        "model_version_mismatch": ~version_blank & safe & (version != model),
        "invalid_timestamp": F.col("inferred_at").isNull(),
    })
    # Lines with NaN or Infinity are no JSON to the first reader of names.
    names = F.coalesce(F.json_object_keys("value"), F.map_keys(F.from_json("value", "map<string,string>")))
    return F.concat(field_name_errors(names), values)


def check_records(classified: DataFrame, model: str) -> DataFrame:
    """Typed prediction columns, ``line_no`` and all error codes of each line."""
    scores = ("pred_score", *PREDICTION_OPTIONAL)
    opened = open_fields(classified, "review_key", "pred_label", *scores, "model_version", "inferred_at")
    typed = opened.select(
        "line_no", "value", "status",
        JsonField("review_key").as_text().alias("review_key"),
        JsonField("pred_label").as_text().alias("pred_label"),
        *[JsonField(name).as_number().alias(name) for name in scores],
        *[JsonField(name).kind.alias(f"_kind_{name}") for name in scores],
        JsonField("model_version").as_text().alias("model_version"),
        parse_utc(JsonField("inferred_at").as_text()).alias("inferred_at"),
    )
    status = F.col("status")
    errors = (
        F.when(status == OBJECT, _record_errors(model))
        .when(status == BLANK, F.array(F.lit("blank_line")))
        .when(status == MALFORMED, F.array(F.lit("malformed_json")))
        .when(status == NON_OBJECT, F.array(F.lit("non_object")))
    )
    kept = ("line_no", "review_key", "pred_label", *scores, "model_version", "inferred_at", "errors")
    return computed_once(typed, "errors", errors).select(*kept)


def stage(checked: DataFrame, path: str, batch: str) -> None:
    """Write checked predictions to the staging area; all or nothing. ``checked`` is evaluated once."""
    once = scratch_path(checked.sparkSession, "checked-predictions")
    checked.write.parquet(once)
    checked = checked.sparkSession.read.schema(checked.schema).parquet(once)
    if checked.filter(F.size("errors") > 0).limit(1).count():
        raise ValueError("the prediction file has invalid records")
    repeated = checked.groupBy("review_key", "model_version").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.limit(1).count():
        raise ValueError("the prediction file repeats a key and model")
    write_staging(checked, path, batch)
