"""Whitespace of any kind makes a handed-over key or text blank."""

import json

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import checks
from reviewmill.schemas import HANDOFF_FIELDS
from reviewmill.sources import prediction_files
from reviewmill.sources.lines import classify

SPACES = [" ", "　", " \t ", ""]


@pytest.mark.parametrize("space", SPACES)
def test_export_rows(spark, space):
    row = {c: "x" for c in HANDOFF_FIELDS} | {"review_key": space, "review_text_clean": space, "rating_label": "neutral", "load_batch_id": "b"}
    table = spark.createDataFrame([tuple(row[c] for c in HANDOFF_FIELDS)], ", ".join(f"{c} string" for c in HANDOFF_FIELDS))
    table = table.withColumn("rating", F.lit(3.0)).select(*HANDOFF_FIELDS)
    assert {"blank_review_key", "blank_review_text"} <= set(checks.check_export(table, "b").first().errors)
    counted = checks.export_metrics(table).first()
    assert (counted.null_review_key_count, counted.blank_review_text_count, counted.unique_review_key_count) == (1, 1, 0)


@pytest.mark.parametrize("space", SPACES)
def test_prediction_records(spark, space):
    record = {"review_key": space, "pred_label": "neutral", "pred_score": 0.5, "model_version": space, "inferred_at": "2026-01-01T00:00:00Z"}
    lines = classify(spark.createDataFrame([(1, json.dumps(record))], "line_no long, value string"))
    found = prediction_files.check_records(lines, "m1").first().errors
    assert {"invalid_review_key", "blank_model_version"} <= set(found) and "unsafe_model_version" not in found
