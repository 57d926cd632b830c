"""Quality checks, gates, the classifier input and written tables."""

from __future__ import annotations

import inspect
import json

from pyspark.sql import functions as F

from querybook import aggregates as tables
from querybook.cleaning import clean_table
from querybook.fixtures import BATCH, MODEL, predictions, raw_metadata, raw_reviews, review_view, text_view
from querybook.registry import common_table, load, query
from querybook.warehouse import keyed_tables
from reviewmill.functions.serving_values import normalise
from reviewmill.functions.times import parse_utc
from reviewmill.operators import aggregates as agg
from reviewmill.operators import checks, clean
from reviewmill.operators import predictions as pred
from reviewmill.schemas import HANDOFF_FIELDS, SERVING_TABLES
from reviewmill.session import scratch_path
from reviewmill.sources import batches, delimited, digests, handoff_files, keyed
from reviewmill.sources import tables as written

_BLANK = "({0} IS NULL OR trim({0}) = '')"
_BAD_LABEL = "({0} IS NULL OR {0} NOT IN ('negative', 'neutral', 'positive'))"


def _values_sql(facts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, CAST(({sql}) AS DOUBLE) AS value" for name, sql in facts.items())


def _judged_sql(rules: dict[str, tuple[str, str]], source: str) -> str:
    """Rules over named values; `{x}` refers to the value of x."""
    def fill(text):
        import re

        return re.sub(r"\{(\w+)\}", rf"(SELECT value FROM {source} WHERE name = '\1')", text)

    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({fill(value)} AS DOUBLE) AS value, CAST({fill(expected)} AS DOUBLE) AS expected"
        for name, (value, expected) in rules.items())
    return f"SELECT *, COALESCE(value = expected, false) AS passed FROM ({rows}) j"


# ---- raw and clean layer -----------------------------------------------------
_RAW = {
    "ods_review_count": "SELECT COUNT(*) FROM raw_reviews",
    "distinct_review_parent_asin": "SELECT COUNT(DISTINCT parent_asin) FROM raw_reviews WHERE trim(parent_asin) <> ''",
    "empty_ods_review_text": f"SELECT COUNT(*) FROM raw_reviews WHERE {_BLANK.format('review_text')}",
    "raw_eligible_review_count": "SELECT COUNT(*) FROM raw_reviews WHERE trim(review_text) <> ''",
    "invalid_ods_count_or_value_rows": """SELECT COUNT(*) FROM raw_reviews WHERE rating IS NULL OR rating < 1 OR rating > 5
        OR helpful_vote IS NULL OR helpful_vote < 0 OR verified_purchase IS NULL""",
    "ods_metadata_count": "SELECT COUNT(*) FROM raw_metadata",
    "distinct_metadata_parent_asin": "SELECT COUNT(DISTINCT parent_asin) FROM raw_metadata WHERE trim(parent_asin) <> ''",
    "expected_deduplicated_dwd_count": "SELECT COUNT(DISTINCT review_key) FROM keyed_reviews",
    "source_duplicate_review_key_groups": "SELECT COUNT(*) FROM (SELECT review_key FROM keyed_reviews GROUP BY 1 HAVING COUNT(*) > 1) d",
    "source_duplicate_excess_rows": "SELECT SUM(n - 1) FROM (SELECT COUNT(*) AS n FROM keyed_reviews GROUP BY review_key HAVING COUNT(*) > 1) d",
    "reviews_with_metadata": "SELECT COUNT(*) FROM raw_reviews r JOIN raw_metadata m ON r.parent_asin = m.parent_asin",
    "reviews_without_metadata": "SELECT COUNT(*) FROM raw_reviews r LEFT JOIN raw_metadata m ON r.parent_asin = m.parent_asin WHERE m.parent_asin IS NULL",
    "metadata_match_rate": "SELECT CAST(COUNT(m.parent_asin) AS DOUBLE) / COUNT(*) FROM raw_reviews r LEFT JOIN raw_metadata m ON r.parent_asin = m.parent_asin",
}
_CLEAN = {
    "dwd_count": "SELECT COUNT(*) FROM clean_table",
    "null_review_key": f"SELECT COUNT(*) FROM clean_table WHERE {_BLANK.format('review_key')}",
    "blank_review_text_clean": f"SELECT COUNT(*) FROM clean_table WHERE {_BLANK.format('review_text_clean')}",
    "invalid_rating_label": f"SELECT COUNT(*) FROM clean_table WHERE {_BAD_LABEL.format('rating_label')}",
    "valid_timestamp_conversion": "SELECT COUNT(review_time) FROM clean_table",
    "invalid_timestamp_conversion": "SELECT COUNT(*) FROM clean_table WHERE review_time IS NULL OR dt IS NULL OR review_year IS NULL",
    "invalid_dwd_count_or_rate_rows": "SELECT COUNT(*) FROM clean_table WHERE text_length IS NULL OR text_length <= 0 OR metadata_matched IS NULL",
    "metadata_matched": "SELECT COUNT(*) FROM clean_table WHERE metadata_matched",
    "metadata_unmatched": "SELECT COUNT(*) FROM clean_table WHERE NOT metadata_matched",
    **{label: f"SELECT COUNT(*) FROM clean_table WHERE rating_label = '{label}'" for label in ("negative", "neutral", "positive")},
    **{f"{c}_non_null": f"SELECT COUNT({c}) FROM clean_table" for c in ("product_title", "store_name", "main_category")},
    "partition_count": "SELECT COUNT(DISTINCT review_year) FROM clean_table",
    "duplicate_review_key_groups": "SELECT COUNT(*) FROM (SELECT review_key FROM clean_table GROUP BY 1 HAVING COUNT(*) > 1) d",
}
common_table("raw_check_values", _values_sql(_RAW))
common_table("clean_check_values", _values_sql(_CLEAN))
common_table("layer_check_values", "SELECT * FROM raw_check_values UNION ALL SELECT * FROM clean_check_values")


def _raw_checks(spark, sf):
    return checks.check_raw(raw_reviews(spark, sf), raw_metadata(spark, sf), BATCH)


@query("ods_checks", "SELECT * FROM raw_check_values")
def _ods(spark, sf):
    return _raw_checks(spark, sf)


@query("dwd_checks", "SELECT * FROM clean_check_values")
def _dwd(spark, sf):
    return checks.check_clean(clean_table(spark, sf), BATCH)


@query("ods_dwd_reconcile", _judged_sql({
    "unique_eligible_is_clean": ("{expected_deduplicated_dwd_count}", "{dwd_count}"),
    "eligible_less_excess_is_clean": ("{raw_eligible_review_count} - {source_duplicate_excess_rows}", "{dwd_count}"),
    "matched_and_unmatched_is_clean": ("{metadata_matched} + {metadata_unmatched}", "{dwd_count}"),
    "labels_are_clean": ("{negative} + {neutral} + {positive}", "{dwd_count}"),
    "has_partitions": ("CAST({partition_count} > 0 AS INTEGER)", "1"),
    **{n: ("{" + n + "}", "0") for n in (
        "null_review_key", "duplicate_review_key_groups", "blank_review_text_clean", "invalid_rating_label",
        "invalid_timestamp_conversion", "invalid_ods_count_or_value_rows", "invalid_dwd_count_or_rate_rows")},
}, "layer_check_values"))
def _layers(spark, sf):
    return checks.reconcile_clean(_raw_checks(spark, sf), checks.check_clean(clean_table(spark, sf), BATCH))


# ---- classifier input ----------------------------------------------------------
common_table("export_table", f"""SELECT {", ".join(HANDOFF_FIELDS)} FROM clean_table WHERE trim(review_text_clean) <> ''
  AND trim(review_key) <> '' AND rating_label IN ('negative', 'neutral', 'positive')""")
_FAULTS = {
    "null_or_blank_review_key": _BLANK.format("review_key"),
    "null_or_blank_review_text": _BLANK.format("review_text_clean"),
    "invalid_rating_label": _BAD_LABEL.format("rating_label"),
    "null_rating": "rating IS NULL",
    "null_or_blank_parent_asin": _BLANK.format("parent_asin"),
    "null_or_blank_main_category": _BLANK.format("main_category"),
    "null_review_time": "review_time IS NULL",
    "invalid_batch_id": f"(load_batch_id IS NULL OR load_batch_id <> '{BATCH}')",
}
_HANDOFF = {
    "production_dwd_row_count": "SELECT COUNT(*) FROM clean_table",
    "eligible_nlp_input_row_count": "SELECT COUNT(*) FROM export_table",
    "null_or_blank_review_key_count": f"SELECT COUNT(*) FROM clean_table WHERE {_BLANK.format('review_key')}",
    "blank_review_text_clean_count": f"SELECT COUNT(*) FROM clean_table WHERE {_BLANK.format('review_text_clean')}",
    "invalid_rating_label_count": f"SELECT COUNT(*) FROM clean_table WHERE {_BAD_LABEL.format('rating_label')}",
    **{f"rows_with_{c}": f"SELECT COUNT({c}) FROM clean_table" for c in ("parent_asin", "main_category", "review_time")},
    **{label: f"SELECT COUNT(*) FROM clean_table WHERE rating_label = '{label}'" for label in ("negative", "neutral", "positive")},
    "duplicate_review_key_group_count": "SELECT COUNT(*) FROM (SELECT review_key FROM clean_table GROUP BY 1 HAVING COUNT(*) > 1) d",
    "export_table_row_count": "SELECT COUNT(*) FROM export_table",
    **{f"export_{name}": f"SELECT COUNT(*) FROM export_table WHERE {sql}" for name, sql in _FAULTS.items()},
}
common_table("handoff_check_values", _values_sql(_HANDOFF))


def _handoff(spark, sf):
    return clean.handoff(clean_table(spark, sf))


def _handoff_checks(spark, sf):
    table = clean_table(spark, sf)
    return checks.check_handoff(table, clean.handoff(table), BATCH)


@query("handoff_checks", "SELECT * FROM handoff_check_values")
def _handoff_values(spark, sf):
    return _handoff_checks(spark, sf)


@query("handoff_reconcile", _judged_sql({
    "eligible_is_clean": ("{eligible_nlp_input_row_count}", "{production_dwd_row_count}"),
    "export_is_eligible": ("{export_table_row_count}", "{eligible_nlp_input_row_count}"),
    "labels_are_eligible": ("{negative} + {neutral} + {positive}", "{eligible_nlp_input_row_count}"),
    **{n: ("{" + n + "}", "0") for n in (
        "null_or_blank_review_key_count", "duplicate_review_key_group_count", "blank_review_text_clean_count",
        "invalid_rating_label_count", "export_invalid_batch_id")},
}, "handoff_check_values"))
def _handoff_gate(spark, sf):
    return checks.reconcile_handoff(_handoff_checks(spark, sf))


@query("temp_export_table", "SELECT * FROM export_table")
def _export_table(spark, sf):
    return normalise(written.build_export(_handoff(spark, sf), scratch_path(spark, "export")))


@query("null_profile", "SELECT " + ", ".join(f"COUNT(*) FILTER ({sql}) AS {name}" for name, sql in _FAULTS.items()) + " FROM clean_table")
def _null_profile(spark, sf):
    return checks.null_profile(clean_table(spark, sf), BATCH)


@query("agg_to_agg_join", f"SELECT '{BATCH}' AS load_batch_id, (SELECT COUNT(*) FROM clean_table) - (SELECT COUNT(*) FROM export_table) AS export_eligible_row_difference")
def _reconcile_counts(spark, sf):
    table = clean_table(spark, sf)
    return checks.reconcile_counts(table, table)


_METRICS = """COUNT(*) AS export_row_count, COUNT(DISTINCT CASE WHEN trim(review_key) <> '' THEN review_key END) AS unique_review_key_count,
  COUNT(*) FILTER (trim(review_key) <> '') - COUNT(DISTINCT CASE WHEN trim(review_key) <> '' THEN review_key END) AS duplicate_review_key_count,
  COUNT(*) FILTER (review_key IS NULL OR trim(review_key) = '') AS null_review_key_count,
  COUNT(*) FILTER (review_text_clean IS NULL OR trim(review_text_clean) = '') AS blank_review_text_count,
  COUNT(*) FILTER (rating_label IS NULL OR rating_label NOT IN ('negative', 'neutral', 'positive')) AS invalid_rating_label_count,
  COUNT(*) FILTER (rating_label = 'negative') AS negative_count, COUNT(*) FILTER (rating_label = 'neutral') AS neutral_count,
  COUNT(*) FILTER (rating_label = 'positive') AS positive_count, MIN(rating) AS minimum_rating, MAX(rating) AS maximum_rating,
  COUNT(*) FILTER (trim(parent_asin) <> '') AS rows_with_parent_asin, COUNT(*) FILTER (trim(main_category) <> '') AS rows_with_main_category,
  COUNT(review_time) AS rows_with_review_time"""
# Unclean rows on purpose: copies of the raw reviews under their keys.
common_table("repeated_export", """SELECT review_key, trim(review_text) AS review_text_clean, CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3 THEN 'neutral'
  WHEN rating >= 4 THEN 'positive' ELSE 'unknown' END AS rating_label, rating, parent_asin, CAST(NULL AS VARCHAR) AS main_category,
  CAST(review_timestamp AS VARCHAR) AS review_time, load_batch_id FROM keyed_reviews""")


def _repeated_export(spark, sf):
    from reviewmill.functions.labels import weak_label
    from reviewmill.functions.text import review_key

    keyed = clean.with_text(raw_reviews(spark, sf)).withColumn("review_key", review_key())
    return keyed.select(
        "review_key", F.trim("review_text").alias("review_text_clean"), weak_label("rating").alias("rating_label"), "rating", "parent_asin",
        F.lit(None).cast("string").alias("main_category"), F.col("review_timestamp").cast("string").alias("review_time"), "load_batch_id")


common_table("export_facts", f"SELECT {_METRICS} FROM export_table")
common_table("repeated_facts", f"SELECT {_METRICS} FROM repeated_export")


@query("export_metrics", "SELECT * FROM repeated_facts")
def _export_metrics(spark, sf):
    return checks.export_metrics(_repeated_export(spark, sf))


@query("export_reconcile", """SELECT *, COALESCE(value = expected, false) AS passed FROM (
  SELECT 'keys_are_rows' AS check_name, CAST(unique_review_key_count + duplicate_review_key_count + null_review_key_count AS DOUBLE) AS value, CAST(export_row_count AS DOUBLE) AS expected FROM repeated_facts
  UNION ALL SELECT 'labels_are_rows', CAST(negative_count + neutral_count + positive_count + invalid_rating_label_count AS DOUBLE), CAST(export_row_count AS DOUBLE) FROM repeated_facts
  UNION ALL SELECT 'duplicate_review_key_count', CAST(duplicate_review_key_count AS DOUBLE), 0.0 FROM repeated_facts
  UNION ALL SELECT 'null_review_key_count', CAST(null_review_key_count AS DOUBLE), 0.0 FROM repeated_facts
  UNION ALL SELECT 'blank_review_text_count', CAST(blank_review_text_count AS DOUBLE), 0.0 FROM repeated_facts
  UNION ALL SELECT 'invalid_rating_label_count', CAST(invalid_rating_label_count AS DOUBLE), 0.0 FROM repeated_facts) j""")
def _export_reconcile(spark, sf):
    return checks.reconcile_export(checks.export_metrics(_repeated_export(spark, sf)))


@query("export_record_check", """SELECT review_key, rating, concat_ws(',', CASE WHEN rating_label = 'unknown' THEN 'invalid_rating_label' END,
  CASE WHEN rating IS NULL THEN 'rating_not_numeric' END, CASE WHEN rating < 1 OR rating > 5 THEN 'rating_out_of_range' END) AS error_codes FROM repeated_export""")
def _export_record_check(spark, sf):
    checked = checks.check_export(_repeated_export(spark, sf), BATCH)
    return checked.select("review_key", "rating", F.concat_ws(",", "errors").alias("error_codes"))


@query("run_summary", f"""SELECT *, '{BATCH}' AS batch_id, 'production_v1.0' AS schema_version, 'clean_reviews' AS source_table, 'data' AS output_name,
  true AS has_time FROM export_facts""")
def _summary(spark, sf):
    made = handoff_files.summary(_handoff(spark, sf), BATCH)
    return made.withColumn("has_time", parse_utc("export_timestamp").isNotNull()).drop("content_hash", "export_timestamp")


@query("export_manifest", f"""SELECT 'production_v1.0' AS schema_version, '{",".join(HANDOFF_FIELDS)}' AS field_order, '{BATCH}' AS batch_id,
  true AS rating_label_is_weak_label, 8 AS meanings, 3 AS labels, COUNT(*) > 0 AS has_rows, 8 AS types, 'number' AS rating_type, 'clean_reviews' AS source_table,
  'data' AS output_name, true AS has_statement, true AS has_time FROM export_table""")
def _manifest(spark, sf):
    made = handoff_files.manifest(handoff_files.summary(_handoff(spark, sf), BATCH))
    return made.select(
        "schema_version", F.concat_ws(",", "field_order").alias("field_order"), "batch_id", "rating_label_is_weak_label",
        F.size("field_meanings").alias("meanings"), F.size("label_mapping").alias("labels"), (F.col("content_hash") != "0").alias("has_rows"),
        F.size("expected_types").alias("types"), F.col("expected_types")["rating"].alias("rating_type"), "source_table", "output_name",
        F.col("rating_label_statement").contains("not an NLP model prediction").alias("has_statement"),
        parse_utc("generated_timestamp").isNotNull().alias("has_time"))


@query("schema_columns", "SELECT c.*, (SELECT COUNT(*) FROM export_table) AS line_count FROM (VALUES "
       + ", ".join(f"({i}, '{c}', {i}, false)" for i, c in enumerate(HANDOFF_FIELDS, 1))
       + ") c(position, column_name, expected_position, forbidden)")
def _schema_columns(spark, sf):
    path = scratch_path(spark, "handoff-lines")
    handoff_files.write_jsonl(_handoff(spark, sf), path)
    return checks.schema_columns(spark.read.text(path))


# ---- predictions -----------------------------------------------------------------
@query("probability_contract", """SELECT review_key, pred_label, concat_ws(',', CASE WHEN abs(negative_score + neutral_score + positive_score - 1.0) > 0.000001 THEN 'sum_not_one' END,
    CASE WHEN own IS NULL OR own < greatest(negative_score, neutral_score, positive_score) THEN 'label_not_largest' END,
    CASE WHEN own IS NULL OR abs(own - pred_score) > 0.000001 THEN 'score_not_of_label' END) AS error_codes
  FROM (SELECT *, CASE pred_label WHEN 'negative' THEN negative_score WHEN 'neutral' THEN neutral_score WHEN 'positive' THEN positive_score END AS own FROM predictions
        WHERE negative_score IS NOT NULL AND neutral_score IS NOT NULL AND positive_score IS NOT NULL) p
  WHERE abs(negative_score + neutral_score + positive_score - 1.0) > 0.000001 OR own IS NULL
    OR own < greatest(negative_score, neutral_score, positive_score) OR abs(own - pred_score) > 0.000001""")
def _probabilities(spark, sf):
    bad = pred.check_probabilities(predictions(spark, sf))
    return bad.select("review_key", "pred_label", F.concat_ws(",", "errors").alias("error_codes"))


_OPTIONAL_BAD = " OR ".join(f"({c} IS NOT NULL AND ({c} < 0 OR {c} > 1))" for c in ("negative_score", "neutral_score", "positive_score"))
_IMPORT = {
    "staging_row_count": "SELECT COUNT(*) FROM predictions",
    "valid_staging_row_count": "SELECT COUNT(*) FROM valid_predictions",
    "invalid_label_count": f"SELECT COUNT(*) FROM predictions WHERE {_BAD_LABEL.format('pred_label')}",
    "invalid_score_count": f"SELECT COUNT(*) FROM predictions WHERE pred_score IS NULL OR pred_score < 0 OR pred_score > 1 OR {_OPTIONAL_BAD}",
    "blank_model_version_count": f"SELECT COUNT(*) FROM predictions WHERE {_BLANK.format('model_version')}",
    "invalid_inferred_timestamp_count": "SELECT COUNT(*) FROM predictions WHERE inferred_at IS NULL",
    "production_sentiment_row_count": "SELECT COUNT(*) FROM imported",
    "invalid_production_row_count": "SELECT 0",
    "joined_view_row_count": "SELECT COUNT(*) FROM imported p JOIN review_view d ON p.review_key = d.review_key",
    "duplicate_staging_prediction_key_groups": "SELECT COUNT(*) FROM (SELECT 1 FROM predictions GROUP BY review_key, model_version HAVING COUNT(*) > 1) d",
    "duplicate_production_prediction_key_groups": "SELECT COUNT(*) FROM (SELECT 1 FROM imported GROUP BY review_key, model_version HAVING COUNT(*) > 1) d",
    "unknown_review_key_count": f"SELECT COUNT(*) FROM predictions p LEFT JOIN review_view d ON p.review_key = d.review_key WHERE p.model_version = '{MODEL}' AND d.review_key IS NULL",
    "missing_review_key_count": "SELECT COUNT(*) FROM review_view d LEFT JOIN imported p ON p.review_key = d.review_key WHERE p.review_key IS NULL",
    "prediction_coverage": "SELECT CAST(COUNT(p.review_key) AS DOUBLE) / COUNT(d.review_key) FROM review_view d LEFT JOIN imported p ON p.review_key = d.review_key",
}
common_table("import_check_values", _values_sql(_IMPORT))
common_table("import_check_rows", "SELECT * FROM import_check_values" + "".join(
    f" UNION ALL SELECT COALESCE('{c}=' || {c}, '{c} is null') AS name, CAST(COUNT(*) AS DOUBLE) AS value FROM imported GROUP BY {c}" for c in checks.DISTRIBUTIONS))


def _import_checks(spark, sf):
    reviews, staged = review_view(spark, sf, keyed=True), predictions(spark, sf)
    imported = pred.import_predictions(staged, reviews, MODEL, packed=True)
    view = pred.sentiment_view(reviews.drop("pred_label", "pred_score", "model_version", "inferred_at"), imported)
    return checks.check_import(staged, imported, reviews, view, BATCH, MODEL)


@query("import_checks", "SELECT * FROM import_check_rows")
def _import_values(spark, sf):
    return _import_checks(spark, sf)


def _keyed(name: str, sql: str):
    """A query over the tables stored by key that it names: reviews, staged and imported predictions."""
    return lambda fn: query(name, sql)(lambda spark, sf: fn(**keyed_tables(spark, sf, *inspect.signature(fn).parameters)))


@_keyed("keyed_import_checks", "SELECT * FROM import_check_values")
def _keyed_checks(reviews, staged, imported):
    # The SQL of this query is of the counts alone; import_checks has the distributions too.
    return keyed.check_import(staged, imported, reviews, MODEL).filter(~checks.in_distribution("name"))


@_keyed("keyed_import", "SELECT review_key, pred_label, pred_score, model_version FROM imported")
def _keyed_import(reviews, staged):
    return keyed.imported(staged, reviews, MODEL).select("review_key", "pred_label", "pred_score", "model_version")


@_keyed("keyed_unknown", "SELECT p.review_key, p.pred_label FROM predictions p LEFT JOIN review_view d ON p.review_key = d.review_key WHERE d.review_key IS NULL")
def _keyed_unknown(reviews, staged):
    return keyed.unknown_predictions(staged, reviews).select("review_key", "pred_label")


@_keyed("keyed_missing", "SELECT d.review_key FROM review_view d LEFT JOIN predictions p ON p.review_key = d.review_key WHERE p.review_key IS NULL")
def _keyed_missing(reviews, staged):
    return keyed.missing_reviews(reviews, staged).select("review_key")


@_keyed("keyed_matched", "SELECT COUNT(DISTINCT p.review_key) AS matched_key_count FROM predictions p JOIN review_view d ON p.review_key = d.review_key")
def _keyed_matched(reviews, staged):
    return keyed.matched_keys(staged, reviews)


@_keyed("keyed_coverage", "SELECT CAST(COUNT(p.review_key) AS DOUBLE) / COUNT(d.review_key) AS prediction_coverage FROM review_view d LEFT JOIN predictions p ON p.review_key = d.review_key")
def _keyed_coverage(reviews, staged):
    return keyed.coverage(reviews, staged)


@query("import_reconcile", _judged_sql({
    "production_is_valid_staging": ("{production_sentiment_row_count}", "{valid_staging_row_count}"),
    "view_is_valid_staging": ("{joined_view_row_count}", "{valid_staging_row_count}"),
    "duplicate_production_prediction_key_groups": ("{duplicate_production_prediction_key_groups}", "0"),
    "invalid_production_row_count": ("{invalid_production_row_count}", "0"),
}, "import_check_values"))
def _import_gate(spark, sf):
    return checks.reconcile_import(_import_checks(spark, sf))


# ---- serving tables ---------------------------------------------------------------
_RATES = " OR ".join(f"{c} < 0 OR {c} > 1" for c in ("positive_rate", "neutral_rate", "negative_rate"))
_SERVING = {
    "overview_rows_for_model": "SELECT COUNT(*) FROM dws_overview",
    "overview_review_count": "SELECT review_count FROM dws_overview",
    "label_count_sum": "SELECT positive_count + neutral_count + negative_count FROM dws_overview",
    "invalid_overview_rate_rows": f"SELECT COUNT(*) FROM dws_overview WHERE {_RATES}",
    "daily_review_count_sum": "SELECT SUM(review_count) FROM dws_daily",
    "invalid_daily_rate_rows": f"SELECT COUNT(*) FROM dws_daily WHERE {_RATES}",
    "product_review_count_sum": "SELECT SUM(review_count) FROM dws_product",
    "invalid_product_rate_rows": f"SELECT COUNT(*) FROM dws_product WHERE {_RATES} OR verified_purchase_rate < 0 OR verified_purchase_rate > 1",
    "blank_product_parent_asin_rows": f"SELECT COUNT(*) FROM dws_product WHERE {_BLANK.format('parent_asin')}",
    "prediction_count": "SELECT COUNT(*) FROM review_view",
    "smoke_or_synthetic_source_rows": "SELECT COUNT(*) FROM review_view WHERE lower(model_version) LIKE '%smoke%'",
    "duplicate_overview_model_groups": "SELECT 0",
    "unexpected_model_version_rows": "SELECT 0",
}
common_table("serving_check_values", _values_sql(_SERVING))


def _serving_checks(spark, sf):
    view = review_view(spark, sf)
    stamped = [agg.stamp(table(spark, sf), BATCH, MODEL) for table in (tables.overview, tables.daily, tables.products)]
    return checks.check_serving(*stamped, view.select("load_batch_id", "model_version"), BATCH, MODEL)


@query("dws_checks", "SELECT * FROM serving_check_values")
def _dws(spark, sf):
    return _serving_checks(spark, sf)


@query("dws_reconcile", _judged_sql({
    "one_overview_row": ("{overview_rows_for_model}", "1"),
    "overview_is_predictions": ("{overview_review_count}", "{prediction_count}"),
    "daily_is_overview": ("{daily_review_count_sum}", "{overview_review_count}"),
    "products_are_overview": ("{product_review_count_sum}", "{overview_review_count}"),
}, "serving_check_values"))
def _dws_gate(spark, sf):
    return checks.reconcile_serving(_serving_checks(spark, sf))


@query("aspect_checks", """SELECT aspect_code, CASE WHEN aspect_code = 'durability' THEN 'uncontrolled_code' ELSE '' END AS error_codes FROM dws_aspects""")
def _aspect_checks(spark, sf):
    # One code is left out of the vocabulary to show that it is reported.
    stamped = agg.stamp(tables.aspects(spark, sf), BATCH, MODEL)
    known = ("appearance", "comfort", "material", "price_value", "quality", "shipping_packaging", "size_fit")
    checked = checks.check_aspects(stamped, known, BATCH, MODEL)
    return checked.select("aspect_code", F.concat_ws(",", "errors").alias("error_codes"))


# ---- tables written below the shared folder and read back ----------------------------
@query("ods_text_sink", "SELECT * FROM raw_reviews")
def _ods_text(spark, sf):
    path = scratch_path(spark, "raw-reviews")
    delimited.write_raw(raw_reviews(spark, sf).drop("load_batch_id"), path, BATCH)
    return delimited.read_raw_reviews(spark, path)


@query("ctrl_a_text_scan", """SELECT main_category, product_title, average_rating, rating_number, features_json, description_json, price_raw, images_json,
  videos_json, store_name, categories_json, details_json, parent_asin, bought_together_json, load_batch_id FROM raw_metadata""")
def _metadata_text(spark, sf):
    from reviewmill.schemas import RAW_METADATA

    path = scratch_path(spark, "raw-metadata")
    delimited.write_raw(raw_metadata(spark, sf), path, BATCH, RAW_METADATA)
    return delimited.read_raw_metadata(spark, path)


_STAGED = """SELECT review_key, pred_label, pred_score, negative_score, neutral_score, positive_score, model_version,
  strftime(inferred_at, '%Y-%m-%d %H:%M:%S') AS inferred_at, load_batch_id FROM valid_predictions"""


@query("prepared_predictions_sink", _STAGED)
def _staging(spark, sf):
    path = scratch_path(spark, "staging")
    delimited.write_staging(pred.valid_predictions(predictions(spark, sf), MODEL), path, BATCH)
    return normalise(delimited.read_staging(spark, path))


@query("prediction_staging_scan", f"SELECT model_version, load_batch_id, COUNT(*) AS row_count FROM ({_STAGED}) s GROUP BY ALL")
def _staging_scan(spark, sf):
    path = scratch_path(spark, "staging")
    delimited.write_staging(pred.valid_predictions(predictions(spark, sf), MODEL), path, BATCH)
    return delimited.read_staging(spark, path).groupBy("model_version", "load_batch_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("dynamic_partition_overwrite", "SELECT * FROM clean_table")
def _write_clean(spark, sf):
    path = scratch_path(spark, "clean")
    written.write_clean(clean_table(spark, sf), path)
    return normalise(spark.read.parquet(path))


@query("static_partition_overwrite", f"""SELECT dt, review_count, negative_rate, '{BATCH}' AS load_batch_id, '{MODEL}' AS model_version FROM dws_daily
  UNION ALL SELECT dt, review_count, negative_rate, '{BATCH}', 'm0' FROM dws_daily""")
def _static(spark, sf):
    path = scratch_path(spark, "daily")
    daily = tables.daily(spark, sf)
    for model, table in (("m0", daily), (MODEL, daily.limit(1)), (MODEL, daily)):
        written.overwrite_partition(table, path, {"load_batch_id": BATCH, "model_version": model})
    return spark.read.parquet(path).select("dt", "review_count", "negative_rate", "load_batch_id", "model_version")


@query("jsonl_export_sink", "SELECT * FROM export_table WHERE rating IS NOT NULL")
def _jsonl(spark, sf):
    path = scratch_path(spark, "handoff")
    handoff_files.export(_handoff(spark, sf), path, BATCH)
    return handoff_files.read_export(spark, path)


def _text_root(spark, sf):
    root = scratch_path(spark, "serving")
    view = text_view(spark, sf).withColumns({
        "dt": F.date_format("review_time", "yyyy-MM-dd"), "verified_purchase": F.lit(True), "helpful_vote": F.lit(1).cast("bigint")})
    written.publish(view, root, BATCH, MODEL, aspect_rules=tables.TEXT_ASPECTS, reason_rules=tables.TEXT_REASONS)
    return root


@query("serving_publish", """SELECT 'dws_sentiment_overview' AS table_name, CAST(1 AS BIGINT) AS "rows"
  UNION ALL SELECT 'dws_sentiment_daily', COUNT(DISTINCT strftime(review_time, '%Y-%m-%d')) FROM text_view
  UNION ALL SELECT 'dws_product_sentiment', COUNT(*) FROM (SELECT DISTINCT parent_asin, product_title, store_name, main_category FROM text_view) p
  UNION ALL SELECT 'dws_category_sentiment', COUNT(DISTINCT main_category) FROM text_view
  UNION ALL SELECT 'dws_store_sentiment', COUNT(DISTINCT store_name) FROM text_view
  UNION ALL SELECT 'dws_verified_purchase_sentiment', 1
  UNION ALL SELECT 'dws_rating_prediction_matrix', 15
  UNION ALL SELECT 'dws_prediction_confidence', 4
  UNION ALL SELECT 'dws_monthly_sentiment', COUNT(DISTINCT strftime(review_time, '%Y-%m')) FROM text_view
  UNION ALL SELECT 'dws_sentiment_alerts', COUNT(*) FROM (
    SELECT 1 FROM text_view GROUP BY parent_asin, product_title, store_name, main_category HAVING COUNT(*) >= 20 AND COUNT(*) FILTER (pred_label = 'negative')::DOUBLE / COUNT(*) >= 0.3
    UNION ALL SELECT 1 FROM text_view GROUP BY store_name HAVING COUNT(*) >= 20 AND COUNT(*) FILTER (pred_label = 'negative')::DOUBLE / COUNT(*) >= 0.3
    UNION ALL SELECT 1 FROM text_view GROUP BY main_category HAVING COUNT(*) >= 20 AND COUNT(*) FILTER (pred_label = 'negative')::DOUBLE / COUNT(*) >= 0.3) a
  UNION ALL SELECT 'dws_review_samples', COUNT(*) FROM dws_samples
  UNION ALL SELECT 'dws_aspect_summary', COUNT(*) FROM dws_aspects
  UNION ALL SELECT 'dws_negative_reasons', COUNT(*) FROM dws_reasons
  UNION ALL SELECT 'review_count', COUNT(*) FROM text_view""")
def _publish(spark, sf):
    from reviewmill.plans.serving_queries import health_counts

    root = _text_root(spark, sf)
    return health_counts({name: written.serving_table(spark, root, name, BATCH, MODEL) for name in SERVING_TABLES})


@query("serving_table_scan", f"SELECT *, '{BATCH}' AS load_batch_id, '{MODEL}' AS model_version FROM dws_store")
def _serving_scan(spark, sf):
    root = scratch_path(spark, "serving")
    stamped = agg.stamp(tables.stores(spark, sf), BATCH, MODEL)
    written.overwrite_partition(stamped, f"{root}/dws_store_sentiment", {"load_batch_id": BATCH, "model_version": MODEL})
    return written.serving_table(spark, root, "dws_store_sentiment", BATCH, MODEL).drop("generated_at")


@query("refuse_existing_partition", "SELECT true AS refused, true AS allowed_other, true AS allowed_forced, COUNT(*) AS row_count FROM dws_daily")
def _refuse(spark, sf):
    path = scratch_path(spark, "guarded")
    spec = {"load_batch_id": BATCH, "model_version": MODEL}
    written.guard_version(spark, path, spec)
    written.overwrite_partition(tables.daily(spark, sf), path, spec)

    def refused(**options):
        try:
            written.guard_version(spark, path, {**spec, **options.pop("spec", {})}, **options)
        except ValueError:
            return True
        return False

    facts = (refused(), not refused(spec={"model_version": "other"}), not refused(force=True))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(*[F.lit(f).alias(n) for f, n in zip(facts, ("refused", "allowed_other", "allowed_forced"))], "row_count")


@query("sample_sink", "SELECT doc_id, lang, sha256(text) AS text_hash FROM documents ORDER BY sha256('42:' || doc_id), doc_id LIMIT 100")
def _sample_sink(spark, sf):
    from reviewmill.operators.ranking import uniform_sample

    path = scratch_path(spark, "samples")
    uniform_sample(load(spark, sf, "documents").select("doc_id", "text", "lang"), 100, "doc_id").write.json(path)
    back = spark.read.schema("doc_id BIGINT, text STRING, lang STRING").json(path)
    return back.select("doc_id", "lang", F.sha2("text", 256).alias("text_hash"))


# A record of a wrong label and rating and a blank line are added to the written data.
@query("export_revalidate", """SELECT unnest(['export_row_count', 'unique_review_key_count', 'invalid_rating_label_count', 'maximum_rating', 'invalid_records', 'blank_lines', 'content_hash']) AS fact,
  unnest([CAST(export_row_count AS VARCHAR), CAST(unique_review_key_count AS VARCHAR), CAST(invalid_rating_label_count AS VARCHAR), CAST(maximum_rating AS VARCHAR), '0', '0', NULL]) AS stated,
  unnest([CAST(export_row_count + 1 AS VARCHAR), CAST(unique_review_key_count + 1 AS VARCHAR), CAST(invalid_rating_label_count + 1 AS VARCHAR), '9.0', '1', '1', NULL]) AS found FROM export_facts""")
def _revalidate(spark, sf):
    path = scratch_path(spark, "handoff")
    handoff_files.export(_handoff(spark, sf), path, BATCH)
    planted = {"review_key": "planted", "review_text_clean": "x", "rating_label": "unknown", "rating": 9.0,
               "parent_asin": None, "main_category": None, "review_time": None, "load_batch_id": BATCH}
    spark.createDataFrame([(json.dumps(planted),), (" ",)], "value string").write.mode("append").text(f"{path}/{handoff_files.DATA}")
    known = F.col("fact") != "content_hash"
    return handoff_files.revalidate(spark, path, BATCH).select("fact", *[F.when(known, F.col(c)).alias(c) for c in ("stated", "found")])


# ---- batches that are replaced exactly, digests that tell where tables differ ------------------
def _reloaded(spark, sf):
    """A batch stored with all its years, then reloaded without the early ones."""
    path = scratch_path(spark, "batches")
    reviews = review_view(spark, sf).select("review_key", "asin", "rating", "load_batch_id", F.year("review_time").alias("review_year"))
    for rows, batch in ((reviews, BATCH), (reviews.withColumn("load_batch_id", F.lit("b2")), "b2"), (reviews.filter("review_year >= 1995"), BATCH)):
        batches.replace_batch(rows, path, batch)
    return path


_YEARS = "SELECT load_batch_id, CAST(year(review_time) AS INTEGER) AS review_year, COUNT(*) AS row_count FROM review_view {0} GROUP BY ALL"
_RELOADED = _YEARS.format("WHERE year(review_time) >= 1995") + " UNION ALL " + _YEARS.format("").replace("load_batch_id,", "'b2' AS load_batch_id,")


@query("batch_reload", _RELOADED)
def _reload(spark, sf):
    rows = batches.read_batches(spark, _reloaded(spark, sf))
    return rows.groupBy("load_batch_id", "review_year").agg(F.count(F.lit(1)).alias("row_count"))


@query("batch_partitions", _RELOADED)
def _batch_partitions(spark, sf):
    return batches.partitions(spark, _reloaded(spark, sf))


_ROW_SQL = "'=' || review_key || chr(31) || coalesce('=' || store_name, '~')"
_DIGEST_SQL = """SELECT CAST({0} AS INTEGER) AS level, substring(md5(coalesce(review_key, '')), 1, {0}) AS key_range, COUNT(*) AS row_count,
  CAST(SUM(CAST('0x' || substring(md5({1}), 1, 15) AS BIGINT)) AS VARCHAR) AS digest FROM review_view GROUP BY 1, 2"""


@query("range_digests", " UNION ALL ".join(_DIGEST_SQL.format(n, _ROW_SQL) for n in digests.LEVELS))
def _range_digests(spark, sf):
    return digests.digests(review_view(spark, sf, keyed=True).select("review_key", "store_name"), "review_key")


@query("differing_rows", "SELECT review_key, CAST(1 AS BIGINT) AS stated_copies, CAST(0 AS BIGINT) AS found_copies FROM review_view WHERE ends_with(review_key, 'abc')")
def _differing_rows(spark, sf):
    """The reviews, and the same without those whose key has a certain end."""
    rows = review_view(spark, sf, keyed=True).select("review_key", "store_name")
    return digests.differing_rows(rows, rows.filter("not endswith(review_key, 'abc')"), "review_key")
