"""Prediction files line by line, rule by rule, and as a whole."""

import json

import pytest

from reviewmill.operators.predictions import validate_predictions
from reviewmill.sources import prediction_files
from reviewmill.sources.delimited import read_staging

MODEL = "tfidf-7.2"
LABELS = ("negative", "neutral", "positive")
# The line of review number i: a different label and score for each.
FIELDS = ("review_key", "pred_label", "pred_score", "model_version", "inferred_at")


def line(i, drop=(), **changes):
    values = (f"review-{i:03}", LABELS[i % 3], 0.25 + i / 100, MODEL, f"2031-03-04T05:{i % 60:02}:07Z")
    record = {**dict(zip(FIELDS, values)), **changes}
    return json.dumps({k: v for k, v in record.items() if k not in drop}, ensure_ascii=False)


def keys(n):
    return [f"review-{i:03}" for i in range(n)]


@pytest.fixture
def checked(spark, tmp_path):
    def read(rows):
        path = tmp_path / "returned.jsonl"
        path.write_text("\n".join(rows) + "\n", encoding="utf-8")
        return prediction_files.check_records(prediction_files.read_predictions(spark, str(path)), MODEL)

    return read


@pytest.fixture
def verdict(spark, checked):
    def judge(rows, known, **rules):
        table = spark.createDataFrame([(k,) for k in known], "review_key string")
        return validate_predictions(checked(rows), table, "batch", MODEL, **rules).first()

    return judge


# One line per rule, and the codes that it must raise; the key and model stay valid where the rule is about something else.
BROKEN = {
    "blank_line": ["\u3000 "],
    "malformed_json": ['{"review_key": "review-000",', "review-000"],
    "non_object": ['"review-000"', "[]", "12"],
    "missing_required_field": [line(0, drop=(f,)) for f in FIELDS],
    "forbidden_field": [line(0, SQL="select 1"), line(0, Password=None)],
    "unexpected_field": [line(0, rank=1)],
    "invalid_review_key": [line(0, review_key=k) for k in ("", "\u00a0\u2003", "one\u0001two", "one\ntwo", None, 17)],
    "invalid_label": [line(0, pred_label=v) for v in ("Positive", "mixed", None, 1)],
    "invalid_score": [line(0, pred_score=v) for v in (-0.01, 1.0001, "0.5", False, None, [0.5])] + [line(0).replace("0.25", "NaN"), line(0).replace("0.25", "1e999")],
    "invalid_optional_score": [line(0, neutral_score=v) for v in (2, -1, "0.1", True)] + [line(0, positive_score=0.5).replace("0.5", "Infinity")],
    "blank_model_version": [line(0, model_version=v) for v in ("", "\u00a0", None)],
    "unsafe_model_version": [line(0, model_version=v) for v in ("../x", ".hidden", "a b", "x" * 129)],
    "model_version_mismatch": [line(0, model_version="tfidf-7.3")],
    "invalid_timestamp": [line(0, inferred_at=v) for v in ("2031-03-04", "2031-03-04T05:06:07", "2031-03-04T05:06:07+01:00", "later", 1, None)],
}


@pytest.mark.parametrize("code", BROKEN)
def test_every_way_to_break_a_rule_is_counted(verdict, code):
    row = verdict(BROKEN[code], keys(1), allow_partial=True, minimum_coverage=0.0)
    assert row[f"{code}_count"] == len(BROKEN[code])
    assert row.validation_status == "FAIL" and code in row.failure_reasons.split(",") and row.valid_prediction_row_count == 0


def test_faults_of_optional_scores_are_faults_of_scores(verdict):
    row = verdict(BROKEN["invalid_score"][:2] + BROKEN["invalid_optional_score"][:3], keys(1))
    assert (row.invalid_score_count, row.invalid_optional_score_count) == (5, 3)


def test_a_complete_file_passes(verdict):
    row = verdict([line(i) for i in range(6)], keys(6))
    assert (row.validation_status, row.failure_reasons, row.coverage_rate) == ("PASS", "", 1.0)
    assert [row[f"{label}_count"] for label in LABELS] == [2, 2, 2]
    assert (row.score_minimum, row.score_maximum) == (0.25, 0.3)
    assert json.loads(row.model_version_distribution) == {MODEL: 6}


def test_what_is_allowed_passes(verdict):
    rows = [line(0, negative_score=None), line(1, negative_score=0, neutral_score=1, positive_score=0.5), line(2, pred_score=1), line(3, review_key="k" * 5000)]
    assert verdict(rows, [*keys(3), "k" * 5000]).validation_status == "PASS"


def test_a_repeated_field_has_its_last_value(checked):
    row = checked([line(0)[:-1] + ', "pred_label": "positive", "pred_score": 0.75}']).first()
    assert (row.errors, row.pred_label, row.pred_score) == ([], "positive", 0.75)


def test_the_first_of_repeated_keys_counts(verdict):
    row = verdict([line(1), line(2)] + [line(1, pred_score=s / 10) for s in range(5)], keys(3)[1:])
    assert (row.duplicate_count, row.valid_prediction_row_count, row.score_minimum) == (5, 2, 0.26)
    assert row.failure_reasons == "duplicate_key_model_version"


@pytest.mark.parametrize("rules, reasons", [
    ({}, "coverage_below_minimum,partial_file_not_allowed"),
    ({"allow_partial": True, "minimum_coverage": 0.75}, ""),
    ({"allow_partial": True, "minimum_coverage": 0.76}, "coverage_below_minimum"),
    ({"minimum_coverage": 0.1}, "partial_file_not_allowed"),
])
def test_coverage(verdict, rules, reasons):
    row = verdict([line(i) for i in range(3)], keys(4), **rules)
    assert (row.coverage_rate, row.missing_key_count, row.failure_reasons) == (0.75, 1, reasons)


def test_unknown_keys(verdict):
    row = verdict([line(i) for i in range(3)], keys(1))
    assert (row.unknown_key_count, row.matched_key_count, row.failure_reasons) == (2, 1, "unknown_review_key")


def test_the_verdict_quotes_no_record(verdict):
    assert "sesame" not in str(verdict([line(0, review_key="sesame", user_id="sesame", pred_label="sesame")], ["sesame"]))


def test_staging(spark, checked, tmp_path):
    prediction_files.stage(checked([line(0, negative_score=0.25, neutral_score=0.5, positive_score=0.25), line(1)]), str(tmp_path / "staging"), "batch")
    written = sorted("".join(p.read_text() for p in (tmp_path / "staging").rglob("*.txt")).splitlines())
    assert [w.split("\u0001") for w in written] == [
        ["review-000", "negative", "0.25", "0.25", "0.5", "0.25", MODEL, "2031-03-04 05:00:07", "batch"],
        ["review-001", "neutral", "0.26", "\\N", "\\N", "\\N", MODEL, "2031-03-04 05:01:07", "batch"]]
    back = read_staging(spark, str(tmp_path / "staging")).orderBy("review_key").collect()
    assert [(r.pred_score, r.positive_score) for r in back] == [(0.25, 0.25), (0.26, None)]


@pytest.mark.parametrize("extra", [line(0, pred_score=0.9), line(3, rank=1), " "])
def test_staging_takes_all_or_nothing(checked, tmp_path, extra):
    with pytest.raises(ValueError):
        prediction_files.stage(checked([line(0), line(1), extra]), str(tmp_path / "staging"), "batch")
    assert not (tmp_path / "staging").exists()


def test_keys_travel_packed(spark):
    from pyspark.sql import functions as F

    from reviewmill.functions.text import packed_key, unpacked_key
    from reviewmill.operators import predictions as pred

    keys = [None, "", " ", "\x01", "a" * 64, "A" * 64, "0f" * 32, "0f" * 32 + "\n", "0f" * 31, "g" * 64, "é" * 32, "\x01" + "x" * 32]
    table = spark.createDataFrame([(k,) for k in keys], "review_key string").withColumn("p", packed_key("review_key"))
    got = table.select("review_key", unpacked_key("p").alias("back"), "p", F.length("p").alias("n")).collect()
    assert all(r.review_key == r.back for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == len(keys) - 1
    assert {r.n for r in got if r.review_key in ("a" * 64, "0f" * 32)} == {33}
    staged = spark.createDataFrame([("0f" * 32, "b", "negative", 0.5, None, None, None, "m", "2024-01-01")], "review_key string, load_batch_id string, "
        "pred_label string, pred_score double, negative_score double, neutral_score double, positive_score double, model_version string, inferred_at string")
    plan = pred.import_predictions(staged, staged.select("review_key", "load_batch_id"), "m")._jdf.queryExecution().executedPlan().toString()
    assert all("_packed" in line and "review_key" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) and "_packed" in plan


def test_import_checks_have_the_distributions(spark):
    """imported rows of the batch by label, of the model only, and by model version; counts of the keys stay as they are without them."""
    from reviewmill.operators import checks

    schema = ("review_key string, load_batch_id string, pred_label string, pred_score double, negative_score double, neutral_score double, "
              "positive_score double, model_version string, inferred_at timestamp")
    at = __import__("datetime").datetime(2024, 1, 1)

    def row(key, label, model, batch="b"):
        return (key, batch, label, 0.5, None, None, None, model, at)

    imported = [row("a", "negative", "m"), row("a", "negative", "m"), row("b", "positive", "m"), row(None, None, "m"), row("b", "odd", "m"),
                row("a", "neutral", "n"), row("c", "neutral", None), row("a", "positive", "m", "other")]
    reviews = spark.createDataFrame([(k, "b") for k in ("a", "b", "d", None)], "review_key string, load_batch_id string")
    produced = spark.createDataFrame(imported, schema)
    found = {r.name: r.value for r in checks.check_import(produced, produced, reviews, produced, "b", "m").collect()}
    spread = {k: v for k, v in found.items() if k.startswith(("pred_label", "model_version"))}
    assert spread == {"pred_label=negative": 2, "pred_label=positive": 1, "pred_label=odd": 1, "pred_label is null": 1,
                      "model_version=m": 5, "model_version=n": 1, "model_version is null": 1}
    counts = {k: v for k, v in found.items() if k not in spread}
    assert len(counts) == 14 and counts["production_sentiment_row_count"] == 5 and counts["invalid_production_row_count"] == 2
    assert counts["duplicate_production_prediction_key_groups"] == 2 and counts["missing_review_key_count"] == 2 and counts["unknown_review_key_count"] == 1
    nothing = produced.limit(0)
    empty = {r.name: r.value for r in checks.check_import(nothing, nothing, reviews.limit(0), nothing, "b", "m").collect()}
    assert empty.keys() == counts.keys() and not any(empty.values())
    judged = {r.check_name: r.value for r in checks.reconcile_import(checks.check_import(produced, produced, reviews, produced, "b", "m")).collect()}
    assert judged["production_is_valid_staging"] == 5
