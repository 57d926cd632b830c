"""Checking returned predictions and joining them to the reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.labels import is_label
from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import is_blank, model_partition, packed_key, unpacked_key
from reviewmill.operators.joins import by_merge
from reviewmill.schemas import (
    LABELS,
    MODEL_VERSION_PATTERN,
    PREDICTION_FORBIDDEN,
    PREDICTION_OPTIONAL,
    PREDICTION_REQUIRED,
    SENTIMENT_VIEW_COLUMNS,
)
from reviewmill.settings import PROBABILITY_TOLERANCE


def in_unit(c: str) -> Column:
    return F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))


def null_or_in_unit(c: str) -> Column:
    return F.col(c).isNull() | in_unit(c)


def is_valid(model: str) -> Column:
    """True for a staged prediction that may be imported; never null."""
    checks = [
        ~is_blank("review_key"), is_label("pred_label"), in_unit("pred_score"),
        *[null_or_in_unit(c) for c in PREDICTION_OPTIONAL],
        F.coalesce(F.col("model_version") == model, F.lit(False)),
        F.col("inferred_at").isNotNull(),
    ]
    return reduce(Column.__and__, checks)


def import_faults(model: str) -> dict[str, Column]:
    """Conditions that the checks of an import count: of staged rows, and ``bad`` of imported ones."""
    optional = reduce(Column.__or__, [~null_or_in_unit(c) for c in PREDICTION_OPTIONAL])
    return {
        "valid_staging_row_count": is_valid(model),
        "invalid_label_count": ~is_label("pred_label"),
        "invalid_score_count": ~in_unit("pred_score") | optional,
        "blank_model_version_count": is_blank("model_version"),
        "invalid_inferred_timestamp_count": F.col("inferred_at").isNull(),
        "bad": ~is_label("pred_label") | ~in_unit("pred_score") | F.col("inferred_at").isNull(),
    }


def valid_predictions(staged: DataFrame, model: str) -> DataFrame:
    return staged.filter(is_valid(model))


PACKED = "_packed"


def import_predictions(staged: DataFrame, reviews: DataFrame, model: str, packed: bool = False) -> DataFrame:
    """Valid predictions of known reviews, stamped with the import time and the partition name.

    With ``packed`` the key by which they were joined stays beside them, for a join that follows.
    """
    known = reviews.select("review_key", "load_batch_id")
    kept = _joined_by_key(valid_predictions(staged, model), known)
    return (kept if packed else kept.drop(PACKED)).withColumns({
        "imported_at": F.current_timestamp(),
        # Valid rows carry this model version only.
        "model_version_partition": model_partition(F.lit(model)),
    })


def sentiment_view(reviews: DataFrame, predictions: DataFrame) -> DataFrame:
    """Reviews with their predictions: one row per review and model version."""
    key = PACKED if PACKED in predictions.columns else "review_key"
    scored = predictions.select(key, "load_batch_id", "pred_label", "pred_score", "model_version", "inferred_at")
    return _joined_by_key(reviews, scored).select(*SENTIMENT_VIEW_COLUMNS)


def _joined_by_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join by review key and batch, to which keys travel packed; the packed key stays."""
    sides = [t if PACKED in t.columns else t.withColumn(PACKED, packed_key("review_key")).drop("review_key") for t in (left, right)]
    met = sides[0].join(by_merge(sides[1]), [PACKED, "load_batch_id"], "inner").withColumn("review_key", unpacked_key(PACKED))
    return met.select("review_key", "load_batch_id", *[c for c in met.columns if c not in ("review_key", "load_batch_id")])


def flag_duplicates(predictions: DataFrame, order: list[Column]) -> DataFrame:
    """Mark the second and later rows of a (key, model) pair in the given order.

    A pair may be repeated without bound, so its copies are not gathered: the
    first row of each pair is found by aggregation and every other row differs
    from it. ``order`` must be unique within a pair.
    """
    position = F.struct(*order) if len(order) > 1 else order[0]
    pair = ["review_key", "model_version"]
    placed = predictions.withColumn("_at", position)
    first = placed.groupBy(*pair).agg(F.min("_at").alias("_first"))
    marked = placed.alias("p").join(
        by_merge(first.alias("f")),
        F.col("p.review_key").eqNullSafe(F.col("f.review_key"))
        & F.col("p.model_version").eqNullSafe(F.col("f.model_version")),
    )
    return marked.select("p.*", (F.col("_at") > F.col("_first")).alias("is_duplicate")).drop("_at")


# ---- checks on single records ---------------------------------------------
def staged_record_errors(model: str) -> Column:
    """Error codes of a typed prediction row."""
    version = F.col("model_version")
    blank_version = is_blank("model_version")
    unsafe = ~blank_version & ~version.rlike(MODEL_VERSION_PATTERN)
    optional_bad = reduce(Column.__or__, [~null_or_in_unit(c) for c in PREDICTION_OPTIONAL])
    return codes({
        "invalid_review_key": is_blank("review_key") | F.col("review_key").rlike("[\\x01\\r\\n\\t]"),
        "invalid_label": ~is_label("pred_label"),
        "invalid_score": ~in_unit("pred_score"),
        "invalid_optional_score": optional_bad,
        "blank_model_version": blank_version,
        "unsafe_model_version": unsafe,
        "model_version_mismatch": ~blank_version & ~unsafe & (version != model),
        "invalid_timestamp": F.col("inferred_at").isNull(),
    })


def codes(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, as an array."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()]))


def field_name_errors(names: Column) -> Column:
    """Codes for missing, forbidden and unexpected field names of a record."""
    lowered = F.transform(names, F.lower)
    required = F.array(*[F.lit(n) for n in PREDICTION_REQUIRED])
    allowed = F.array(*[F.lit(n) for n in (*PREDICTION_REQUIRED, *PREDICTION_OPTIONAL)])
    forbidden = F.array(*[F.lit(n) for n in PREDICTION_FORBIDDEN])
    return codes({
        "missing_required_field": F.size(F.array_except(required, names)) > 0,
        "forbidden_field": F.size(F.array_intersect(lowered, forbidden)) > 0,
        "unexpected_field": F.size(F.array_except(names, allowed)) > 0,
    })


def error_counts(checked: DataFrame, errors: str = "errors") -> DataFrame:
    """Rows per error code; a row may raise several."""
    return checked.select(F.explode(errors).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("row_count"))


def check_probabilities(predictions: DataFrame, tolerance: float = PROBABILITY_TOLERANCE) -> DataFrame:
    """Rows that break the probability contract: sum 1, label of the largest score, score of the label."""
    scores = {label: F.col(f"{label}_score") for label in LABELS}
    given = reduce(Column.__and__, [c.isNotNull() for c in scores.values()])
    total = reduce(Column.__add__, scores.values())
    own = F.lit(None).cast("double")
    for label, score in scores.items():
        own = F.when(F.col("pred_label") == label, score).otherwise(own)
    return predictions.filter(given).withColumn("errors", codes({
        "sum_not_one": F.abs(total - 1.0) > tolerance,
        "label_not_largest": F.coalesce(own < F.greatest(*scores.values()), F.lit(True)),
        "score_not_of_label": F.coalesce(F.abs(own - F.col("pred_score")) > tolerance, F.lit(True)),
    })).filter(F.size("errors") > 0)


# ---- the verdict on a whole file ------------------------------------------
# Error codes reported by name in the summary.
LINE_CODES = ("blank_line", "malformed_json", "non_object")
RECORD_CODES = (
    "missing_required_field", "forbidden_field", "unexpected_field", "invalid_review_key", "invalid_label",
    "invalid_score", "invalid_optional_score", "blank_model_version", "unsafe_model_version",
    "model_version_mismatch", "invalid_timestamp",
)
DUPLICATE_CODE = "duplicate_key_model_version"


def validate_predictions(checked: DataFrame, known: DataFrame, batch: str, model: str, allow_partial: bool = False,
                         minimum_coverage: float = 1.0) -> DataFrame:
    """One-row verdict on checked prediction rows (see ``sources.prediction_files``).

    ``checked`` has the prediction columns, ``line_no`` and ``errors``; ``known``
    has the review keys of the batch. Rows with the same key and model are
    folded before any join, so a key repeated without bound is one row there.
    ``invalid_score_count`` takes in faults of the optional scores, which are also
    counted apart.
    """
    if not 0 <= minimum_coverage <= 1:
        raise ValueError("minimum coverage must lie between 0 and 1")
    clean = F.size("errors") == 0
    line_counts = [f"{c}_count" for c in (*LINE_CODES, *RECORD_CODES)]
    # One pass over the lines. Clean rows are folded to one row per key, whose
    # first row is the prediction and whose other rows are duplicates (clean rows
    # carry the expected model only). All other lines fold into the null key.
    per_key = checked.groupBy(F.when(clean, F.col("review_key")).alias("review_key")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(clean, 1)).alias("clean_rows"),
        *[F.count(F.when(F.array_contains("errors", c), 1)).alias(f"{c}_count") for c in (*LINE_CODES, *RECORD_CODES)],
        F.min_by(F.when(clean, F.struct("pred_label", "pred_score")), "line_no").alias("first"),
    )
    keys = known.select("review_key").distinct().withColumn("in_reviews", F.lit(1))
    joined = per_key.join(by_merge(keys), "review_key", "full")
    is_kept, is_known = F.coalesce(F.col("clean_rows"), F.lit(0)) > 0, F.col("in_reviews").isNotNull()
    score = F.when(is_kept, F.col("first.pred_score"))

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).alias(c)

    row = joined.agg(
        total("lines"), total("clean_rows"), *[total(c) for c in line_counts],
        F.count(F.when(is_kept, 1)).alias("valid_prediction_row_count"),
        F.count(F.when(is_kept, 1)).alias("unique_review_key_count"),
        F.count(F.when(is_kept & is_known, 1)).alias("matched_key_count"),
        F.count(F.when(is_known, 1)).alias("dwd_key_count"),
        F.count(F.when(is_kept & ~is_known, 1)).alias("unknown_key_count"),
        F.count(F.when(~is_kept & is_known, 1)).alias("missing_key_count"),
        *[F.count(F.when(is_kept & (F.col("first.pred_label") == label), 1)).alias(f"{label}_count") for label in LABELS],
        F.min(score).alias("score_minimum"), F.max(score).alias("score_maximum"), F.avg(score).alias("score_mean"),
    ).withColumnRenamed("lines", "physical_line_count")
    row = row.withColumns({
        "duplicate_count": F.col("clean_rows") - F.col("valid_prediction_row_count"),
        "prediction_row_count": F.col("physical_line_count") - F.col("blank_line_count"),
        "coverage_rate": safe_rate("matched_key_count", "dwd_key_count"),
    })
    row = row.withColumns({
        "parsed_object_count": F.col("prediction_row_count") - F.col("malformed_json_count") - F.col("non_object_count"),
        "invalid_record_count": F.col("prediction_row_count") - F.col("valid_prediction_row_count"),
    })
    failures = codes({
        **{c: F.col(f"{c}_count") > 0 for c in (*LINE_CODES, *RECORD_CODES)},
        DUPLICATE_CODE: F.col("duplicate_count") > 0,
        "unknown_review_key": F.col("unknown_key_count") > 0,
        "coverage_below_minimum": F.col("coverage_rate") < minimum_coverage,
        "partial_file_not_allowed": (F.col("missing_key_count") > 0) & F.lit(not allow_partial),
        "no_review_keys": F.col("dwd_key_count") == 0,
    })
    valid = F.col("valid_prediction_row_count")
    return row.drop("clean_rows").withColumns({
        "invalid_score_count": F.col("invalid_score_count") + F.col("invalid_optional_score_count"),
        # Valid rows carry the expected version only.
        "model_version_distribution": F.when(valid > 0, F.to_json(F.create_map(F.lit(model), valid))).otherwise(F.lit("{}")),
        "failure_reasons": F.concat_ws(",", F.array_sort(failures)),
        "validation_status": F.when(F.size(failures) == 0, F.lit("PASS")).otherwise(F.lit("FAIL")),
        "batch_id": F.lit(batch),
        "expected_model_version": F.lit(model),
        "model_version_partition": model_partition(F.lit(model)),
        "allow_partial": F.lit(allow_partial),
        "minimum_coverage": F.lit(float(minimum_coverage)),
    })
