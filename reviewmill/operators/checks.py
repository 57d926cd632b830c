"""Data-quality checks as rows: name, value, expected, passed.

Counts of one table come from one pass; tables are brought together as rows and
compared in one small aggregate, never by joining the tables themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.labels import is_label
from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import is_blank, looks_like_smoke_model, missing_or_blank, packed_key, review_key
from reviewmill.operators import aggregates as agg
from reviewmill.operators.clean import eligible, for_batch, with_text
from reviewmill.operators.joins import by_merge, metadata_match, unknown_keys
from reviewmill.operators.predictions import PACKED, codes, import_faults
from reviewmill.schemas import HANDOFF_FIELDS, HANDOFF_FORBIDDEN, LABELS


def rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def as_rows(metrics: DataFrame) -> DataFrame:
    """Columns of a one-row frame as (name, value) rows."""
    cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in metrics.columns]
    return metrics.select(F.inline(F.array(*cells)))


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def as_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """(name, value) rows back to one row with a column per name."""
    return rows.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def judged(values: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per rule: its value, the value it must have, and whether it has."""
    cells = [
        F.struct(F.lit(name).alias("check_name"), value.cast("double").alias("value"),
                 expected.cast("double").alias("expected"))
        for name, (value, expected) in rules.items()
    ]
    return values.select(F.inline(F.array(*cells))).withColumn(
        "passed", F.coalesce(F.col("value") == F.col("expected"), F.lit(False))
    )


def zero(name: str) -> tuple[Column, Column]:
    return F.col(name), F.lit(0)


# ---- row conditions ---------------------------------------------------------
def outside(c: str, low: float, high: float) -> Column:
    return F.col(c).isNull() | (F.col(c) < low) | (F.col(c) > high)


def bad_raw_values() -> Column:
    return (outside("rating", 1, 5) | F.col("helpful_vote").isNull() | (F.col("helpful_vote") < 0)
            | F.col("verified_purchase").isNull())


def bad_clean_values() -> Column:
    return F.col("text_length").isNull() | (F.col("text_length") <= 0) | F.col("metadata_matched").isNull()


def bad_rates(*rates: str) -> Column:
    """A rate below 0 or above 1; a missing rate is not counted here."""
    outside_unit = [(F.col(r) < 0) | (F.col(r) > 1) for r in rates]
    return F.coalesce(reduce(Column.__or__, outside_unit), F.lit(False))


LABEL_RATES = ("positive_rate", "neutral_rate", "negative_rate")


# ---- raw and clean layer -----------------------------------------------------
def check_raw(reviews: DataFrame, metadata: DataFrame, batch: str) -> DataFrame:
    """(name, value) rows about the raw layer of one batch."""
    reviews, metadata = for_batch(reviews, batch), for_batch(metadata, batch)
    counts = reviews.agg(
        F.count(F.lit(1)).alias("ods_review_count"),
        F.count_distinct(F.when(~is_blank("parent_asin"), F.col("parent_asin"))).alias("distinct_review_parent_asin"),
        rows_where(is_blank("review_text")).alias("empty_ods_review_text"),
        rows_where(~is_blank("review_text")).alias("raw_eligible_review_count"),
        rows_where(bad_raw_values()).alias("invalid_ods_count_or_value_rows"),
    )
    meta = metadata.agg(
        F.count(F.lit(1)).alias("ods_metadata_count"),
        F.count_distinct(F.when(~is_blank("parent_asin"), F.col("parent_asin"))).alias("distinct_metadata_parent_asin"),
    )
    # Expected clean rows, duplicate groups and excess all follow from the rows per key.
    per_key = with_text(reviews).select(review_key().alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.agg(
        F.count(F.lit(1)).alias("expected_deduplicated_dwd_count"),
        rows_where(F.col("n") > 1).alias("source_duplicate_review_key_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("source_duplicate_excess_rows"),
    )
    return together(*map(as_rows, (counts, meta, keys, metadata_match(reviews, metadata))))


def check_clean(clean: DataFrame, batch: str) -> DataFrame:
    """(name, value) rows about the cleaned table of one batch."""
    rows = for_batch(clean, batch)
    counts = rows.agg(
        F.count(F.lit(1)).alias("dwd_count"),
        rows_where(is_blank("review_key")).alias("null_review_key"),
        rows_where(is_blank("review_text_clean")).alias("blank_review_text_clean"),
        rows_where(~is_label("rating_label")).alias("invalid_rating_label"),
        F.count("review_time").alias("valid_timestamp_conversion"),
        rows_where(F.col("review_time").isNull() | F.col("dt").isNull() | F.col("review_year").isNull()).alias("invalid_timestamp_conversion"),
        rows_where(bad_clean_values()).alias("invalid_dwd_count_or_rate_rows"),
        rows_where(F.col("metadata_matched")).alias("metadata_matched"),
        rows_where(~F.col("metadata_matched")).alias("metadata_unmatched"),
        *[rows_where(F.col("rating_label") == label).alias(label) for label in ("negative", "neutral", "positive")],
        *[F.count(c).alias(f"{c}_non_null") for c in ("product_title", "store_name", "main_category")],
        F.count_distinct("review_year").alias("partition_count"),
    )
    duplicates = agg.duplicate_groups(rows, "review_key").withColumnRenamed("duplicate_groups", "duplicate_review_key_groups")
    return together(as_rows(counts), as_rows(duplicates))


def reconcile_clean(raw_checks: DataFrame, clean_checks: DataFrame) -> DataFrame:
    """Gate between the raw and the cleaned layer."""
    names = [
        "expected_deduplicated_dwd_count", "raw_eligible_review_count", "source_duplicate_excess_rows",
        "dwd_count", "metadata_matched", "metadata_unmatched", "negative", "neutral", "positive", "partition_count",
        "null_review_key", "duplicate_review_key_groups", "blank_review_text_clean", "invalid_rating_label",
        "invalid_timestamp_conversion", "invalid_ods_count_or_value_rows", "invalid_dwd_count_or_rate_rows",
    ]
    row = as_columns(together(raw_checks, clean_checks), names)
    count = F.col("dwd_count")
    return judged(row, {
        "unique_eligible_is_clean": (F.col("expected_deduplicated_dwd_count"), count),
        "eligible_less_excess_is_clean": (F.col("raw_eligible_review_count") - F.col("source_duplicate_excess_rows"), count),
        "matched_and_unmatched_is_clean": (F.col("metadata_matched") + F.col("metadata_unmatched"), count),
        "labels_are_clean": (F.col("negative") + F.col("neutral") + F.col("positive"), count),
        "has_partitions": ((F.col("partition_count") > 0).cast("int"), F.lit(1)),
        **{name: zero(name) for name in names[10:]},
    })


# ---- classifier input ----------------------------------------------------------
def null_profile(export: DataFrame, batch: str) -> DataFrame:
    """Bad values of the classifier input, one column per rule; null on no rows."""
    wrong_batch = F.col("load_batch_id").isNull() | (F.col("load_batch_id") != batch)
    rules = {
        "null_or_blank_review_key": is_blank("review_key"),
        "null_or_blank_review_text": is_blank("review_text_clean"),
        "invalid_rating_label": ~is_label("rating_label"),
        "null_rating": F.col("rating").isNull(),
        "null_or_blank_parent_asin": is_blank("parent_asin"),
        "null_or_blank_main_category": is_blank("main_category"),
        "null_review_time": F.col("review_time").isNull(),
        "invalid_batch_id": wrong_batch,
    }
    return export.agg(*[agg.count_where(condition).alias(name) for name, condition in rules.items()])


def reconcile_counts(export: DataFrame, clean: DataFrame) -> DataFrame:
    """Difference of exported and eligible rows per batch, for batches on both sides."""
    exported = export.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("exported"))
    allowed = eligible(clean).groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("eligible"))
    return exported.join(allowed, "load_batch_id").select(
        "load_batch_id", (F.col("exported") - F.col("eligible")).alias("export_eligible_row_difference")
    )


def schema_columns(lines: DataFrame, value: str = "value") -> DataFrame:
    """Position and name of the fields that the JSON lines of an export carry, with the position
    the contract gives them (null for others) and the number of lines."""
    fields = lines.select(F.posexplode(F.json_object_keys(value)).alias("at", "column_name"))
    place = F.array_position(F.array(*[F.lit(name) for name in HANDOFF_FIELDS]), F.col("column_name")).cast("int")
    return fields.groupBy("at", "column_name").agg(F.count(F.lit(1)).alias("line_count")).select(
        (F.col("at") + 1).alias("position"), "column_name", F.nullif(place, F.lit(0)).alias("expected_position"),
        F.col("column_name").isin(*HANDOFF_FORBIDDEN).alias("forbidden"), "line_count")


def check_handoff(clean: DataFrame, export: DataFrame, batch: str) -> DataFrame:
    """(name, value) rows about the cleaned table and the classifier input made from it."""
    rows = for_batch(clean, batch)
    ok = ~is_blank("review_text_clean") & ~is_blank("review_key") & is_label("rating_label")
    counts = rows.agg(
        F.count(F.lit(1)).alias("production_dwd_row_count"),
        rows_where(ok).alias("eligible_nlp_input_row_count"),
        rows_where(is_blank("review_key")).alias("null_or_blank_review_key_count"),
        rows_where(is_blank("review_text_clean")).alias("blank_review_text_clean_count"),
        rows_where(~is_label("rating_label")).alias("invalid_rating_label_count"),
        F.count("parent_asin").alias("rows_with_parent_asin"),
        F.count("main_category").alias("rows_with_main_category"),
        F.count("review_time").alias("rows_with_review_time"),
        *[rows_where(F.col("rating_label") == label).alias(label) for label in ("negative", "neutral", "positive")],
    )
    duplicates = agg.duplicate_groups(rows, "review_key").withColumnRenamed("duplicate_groups", "duplicate_review_key_group_count")
    exported = export.agg(F.count(F.lit(1)).alias("export_table_row_count"))
    faults = null_profile(export, batch)
    faults = faults.select([F.col(c).alias(f"export_{c}") for c in faults.columns])
    return together(*map(as_rows, (counts, duplicates, exported, faults)))


def reconcile_handoff(handoff_checks: DataFrame) -> DataFrame:
    """Gate before the classifier input is released."""
    zeros = ["null_or_blank_review_key_count", "duplicate_review_key_group_count", "blank_review_text_clean_count",
             "invalid_rating_label_count", "export_invalid_batch_id"]
    names = ["production_dwd_row_count", "eligible_nlp_input_row_count", "export_table_row_count",
             "negative", "neutral", "positive", *zeros]
    return judged(as_columns(handoff_checks, names), {
        "eligible_is_clean": (F.col("eligible_nlp_input_row_count"), F.col("production_dwd_row_count")),
        "export_is_eligible": (F.col("export_table_row_count"), F.col("eligible_nlp_input_row_count")),
        "labels_are_eligible": (F.col("negative") + F.col("neutral") + F.col("positive"), F.col("eligible_nlp_input_row_count")),
        **{name: zero(name) for name in zeros},
    })


def export_errors(batch: str) -> Column:
    """Error codes of one classifier-input row."""
    return codes({
        "blank_review_key": missing_or_blank("review_key"),
        "blank_review_text": missing_or_blank("review_text_clean"),
        "invalid_rating_label": ~is_label("rating_label"),
        "rating_not_numeric": F.col("rating").isNull(),
        "rating_out_of_range": ~F.col("rating").between(1, 5),
        "batch_mismatch": ~F.coalesce(F.col("load_batch_id") == batch, F.lit(False)),
    })


def check_export(export: DataFrame, batch: str) -> DataFrame:
    """Rows of the classifier input with their error codes.

    Wrong, missing or reordered columns are a mistake of the caller and raise.
    """
    if tuple(export.columns) != HANDOFF_FIELDS:
        raise ValueError(f"columns must be {', '.join(HANDOFF_FIELDS)}")
    return export.withColumn("errors", export_errors(batch))


def export_metrics(export: DataFrame) -> DataFrame:
    """All counts of the classifier input in one row.

    Rows are counted per key first, so distinct and duplicate keys come from the
    same pass as the other measures, with partial sums before the shuffle.
    """
    blank_key = missing_or_blank("review_key")
    present = {"parent_asin": "rows_with_parent_asin", "main_category": "rows_with_main_category", "review_time": "rows_with_review_time"}
    per_key = export.groupBy(F.when(~blank_key, F.col("review_key")).alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        rows_where(missing_or_blank("review_text_clean")).alias("blank_text"),
        rows_where(~is_label("rating_label")).alias("bad_label"),
        *[rows_where(F.col("rating_label") == label).alias(label) for label in ("negative", "neutral", "positive")],
        F.min("rating").alias("low"), F.max("rating").alias("high"),
        *[rows_where(~missing_or_blank(F.col(c).cast("string"))).alias(name) for c, name in present.items()],
    )
    has_key = F.col("k").isNotNull()

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total("n").alias("export_row_count"),
        F.count("k").alias("unique_review_key_count"),
        F.coalesce(F.sum(F.when(has_key, F.col("n") - 1)), F.lit(0)).alias("duplicate_review_key_count"),
        F.coalesce(F.sum(F.when(~has_key, F.col("n"))), F.lit(0)).alias("null_review_key_count"),
        total("blank_text").alias("blank_review_text_count"),
        total("bad_label").alias("invalid_rating_label_count"),
        *[total(label).alias(f"{label}_count") for label in ("negative", "neutral", "positive")],
        F.min("low").alias("minimum_rating"), F.max("high").alias("maximum_rating"),
        *[total(name).alias(name) for name in present.values()],
    )


def reconcile_export(metrics: DataFrame) -> DataFrame:
    rows = F.col("export_row_count")
    keys = F.col("unique_review_key_count") + F.col("duplicate_review_key_count") + F.col("null_review_key_count")
    labels = (F.col("negative_count") + F.col("neutral_count") + F.col("positive_count")
              + F.col("invalid_rating_label_count"))
    zeros = ("duplicate_review_key_count", "null_review_key_count", "blank_review_text_count", "invalid_rating_label_count")
    return judged(metrics, {"keys_are_rows": (keys, rows), "labels_are_rows": (labels, rows), **{n: zero(n) for n in zeros}})


# ---- predictions -----------------------------------------------------------------
DISTRIBUTIONS = ("pred_label", "model_version")


def distributed(model: str) -> Column:
    """Under which names an imported row counts in the distributions: its label, if it is of ``model``, and its model version."""
    names = [F.coalesce(F.concat(F.lit(f"{c}="), F.col(c)), F.lit(f"{c} is null")) for c in DISTRIBUTIONS]
    return F.array_compact(F.array(F.when(F.col("model_version") == model, names[0]), names[1]))


def in_distribution(name: str) -> Column:
    """True for the check rows of the distributions."""
    return F.col(name).rlike(rf"\A({'|'.join(DISTRIBUTIONS)})(=| is null\z)")


def check_import(staged: DataFrame, imported: DataFrame, reviews: DataFrame, view: DataFrame, batch: str, model: str) -> DataFrame:
    """(name, value) rows about staged and imported predictions of one model, with the imported rows by label (of the model) and by model version.

    Staged, imported and review rows are marked, united and summed per key and
    model, then per key; all but the row count of the view follows from that table.
    The distributions come from it too, as a pass of their own would import again: known labels of the model are marks, and only
    a row of another label or model is there once more, under that and without its key.
    """
    staged, imported, reviews = (for_batch(t, batch) for t in (staged, imported, reviews))
    faults = import_faults(model)
    bad = faults.pop("bad")

    def marked(table: DataFrame, version: Column, *more: Column, **conditions: Column) -> DataFrame:
        marks = [F.coalesce(condition, F.lit(False)).cast("long").alias(name) for name, condition in conditions.items()]
        # The key is only compared, as bytes.
        key = F.col(PACKED) if PACKED in table.columns else packed_key("review_key")
        return table.select(key.alias("review_key"), version.alias("model_version"), *marks, *more)

    def total(c: str | Column) -> Column:
        return F.coalesce(F.sum(f"`{c}`" if isinstance(c, str) else c), F.lit(0))

    one, version = F.lit(True), F.col("model_version")
    ours, by_key = F.coalesce(version == model, F.lit(False)), F.lit("")
    labels = {f"pred_label={x}": ours & (F.col("pred_label") == x) for x in LABELS}
    others = F.filter(distributed(model), lambda name: ~name.isin(*labels, f"model_version={model}"))
    produced = marked(imported, version, F.explode(F.when(ours & is_label("pred_label"), F.array(by_key)).otherwise(F.concat(F.array(by_key), others))).alias("counted"),
                      imported=one, bad=bad, **labels)
    produced = produced.select(*[F.when(F.col("counted") == by_key, F.col(f"`{c}`")).alias(c) for c in ("review_key", "model_version", "bad", *labels)],
                               "imported", F.nullif("counted", by_key).alias("counted"))
    parts = (marked(staged, version, staged=one, **faults), produced, marked(reviews, F.lit(None).cast("string"), reviews=one),
             # Counts are there without any row.
             staged.sparkSession.range(1).select(F.lit(0).cast("long").alias("staged")))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    pairs = united.groupBy("review_key", "model_version", "counted").agg(*[total(c).alias(c) for c in ("staged", *faults, "imported", "bad", "reviews", *labels)])

    def of_model(value: Column | str) -> Column:
        return F.when(version == model, value)

    keys = pairs.groupBy("review_key", "counted").agg(
        *[F.sum(f"`{c}`").alias(c) for c in ("staged", *faults, "reviews", *labels)], F.sum("imported").alias("rows"),
        F.count(F.when(F.col("staged") > 1, 1)).alias("staged_twice"),
        total(of_model(F.col("staged"))).alias("staged_of_model"),
        total(of_model(F.col("imported"))).alias("imported"), total(of_model(F.col("bad"))).alias("bad"),
        F.count(of_model(F.when(F.col("imported") > 1, 1))).alias("imported_twice"),
    )
    # As in a join, a null key meets nothing.
    found = F.when(F.col("review_key").isNotNull(), F.col("imported")).otherwise(0)
    known = F.col("review_key").isNotNull() & (F.col("reviews") > 0)
    counts = keys.groupBy("counted").agg(
        total("staged").alias("staging_row_count"), *[total(c).alias(c) for c in faults],
        total("staged_twice").alias("duplicate_staging_prediction_key_groups"),
        total(F.when(~known, F.col("staged_of_model"))).alias("unknown_review_key_count"),
        total("imported").alias("production_sentiment_row_count"), total("bad").alias("invalid_production_row_count"),
        total("imported_twice").alias("duplicate_production_prediction_key_groups"),
        total(F.when(found == 0, F.col("reviews"))).alias("missing_review_key_count"),
        safe_rate(total(F.col("reviews") * found), total(F.col("reviews") * F.greatest(found, F.lit(1)))).alias("prediction_coverage"),
        *[total(c).alias(c) for c in labels], total("rows").alias("rows"),
    )

    def cell(name: Column, value: str) -> Column:
        return F.struct(name.alias("name"), F.col(f"`{value}`").cast("double").alias("value"))

    cells = [cell(F.lit(c), c) for c in counts.columns if c not in ("counted", "rows")]
    cells.append(cell(F.lit(f"model_version={model}"), "production_sentiment_row_count"))
    rows = counts.select(F.inline(F.when(F.col("counted").isNull(), F.array(*cells)).otherwise(F.array(cell(F.col("counted"), "rows")))))
    # A value without a row is none of a distribution.
    rows = rows.filter(~in_distribution("name") | (F.col("value") > 0))
    joined = agg.scope(view, batch, model).agg(F.count(F.lit(1)).alias("joined_view_row_count"))
    return together(rows, as_rows(joined))


def reconcile_import(import_checks: DataFrame) -> DataFrame:
    """Gate after an import: everything valid arrived, exactly once."""
    names = ["valid_staging_row_count", "production_sentiment_row_count", "joined_view_row_count",
             "duplicate_production_prediction_key_groups", "invalid_production_row_count"]
    return judged(as_columns(import_checks, names), {
        "production_is_valid_staging": (F.col(names[1]), F.col(names[0])),
        "view_is_valid_staging": (F.col(names[2]), F.col(names[0])),
        names[3]: zero(names[3]),
        names[4]: zero(names[4]),
    })


# ---- serving tables ---------------------------------------------------------------
def check_serving(overview: DataFrame, daily: DataFrame, products: DataFrame, predictions: DataFrame,
                  batch: str, model: str) -> DataFrame:
    """(name, value) rows about the serving tables of one scope. All tables carry their scope columns."""
    ours = agg.scope(overview, batch, model)
    in_batch = overview.filter((F.col("load_batch_id") == batch) & (F.col("model_version") != model))
    head = ours.agg(
        F.count(F.lit(1)).alias("overview_rows_for_model"),
        F.sum("review_count").alias("overview_review_count"),
        F.sum(F.col("positive_count") + F.col("neutral_count") + F.col("negative_count")).alias("label_count_sum"),
        rows_where(bad_rates(*LABEL_RATES)).alias("invalid_overview_rate_rows"),
    )
    days = agg.scope(daily, batch, model).agg(
        F.sum("review_count").alias("daily_review_count_sum"),
        rows_where(bad_rates(*LABEL_RATES)).alias("invalid_daily_rate_rows"),
    )
    items = agg.scope(products, batch, model).agg(
        F.sum("review_count").alias("product_review_count_sum"),
        rows_where(bad_rates(*LABEL_RATES, "verified_purchase_rate")).alias("invalid_product_rate_rows"),
        rows_where(is_blank("parent_asin")).alias("blank_product_parent_asin_rows"),
    )
    scored = for_batch(predictions, batch).agg(
        rows_where(F.col("model_version") == model).alias("prediction_count"),
        rows_where(looks_like_smoke_model("model_version")).alias("smoke_or_synthetic_source_rows"),
    )
    repeated = agg.duplicate_groups(overview, "load_batch_id", "model_version").toDF("duplicate_overview_model_groups")
    other = in_batch.agg(F.count(F.lit(1)).alias("unexpected_model_version_rows"))
    return together(*map(as_rows, (head, days, items, scored, repeated, other)))


def reconcile_serving(serving_checks: DataFrame) -> DataFrame:
    names = ["overview_rows_for_model", "overview_review_count", "prediction_count",
             "daily_review_count_sum", "product_review_count_sum"]
    count = F.col("overview_review_count")
    return judged(as_columns(serving_checks, names), {
        "one_overview_row": (F.col(names[0]), F.lit(1)),
        "overview_is_predictions": (count, F.col("prediction_count")),
        "daily_is_overview": (F.col("daily_review_count_sum"), count),
        "products_are_overview": (F.col("product_review_count_sum"), count),
    })


def aspect_errors(code: str, allowed: tuple[str, ...], batch: str, model: str) -> Column:
    """Error codes of one row of a rule table (aspects or reasons)."""
    return codes({
        "uncontrolled_code": ~F.coalesce(F.col(code).isin(*allowed), F.lit(False)),
        "negative_count": (F.col("mention_count") < 0) | (F.col("product_count") < 0),
        "scope_mismatch": ~F.coalesce((F.col("load_batch_id") == batch) & (F.col("model_version") == model), F.lit(False)),
        "blank_method_or_version": is_blank("extraction_method") | is_blank("rule_version"),
    })


def check_aspects(aspects: DataFrame, allowed: tuple[str, ...], batch: str, model: str) -> DataFrame:
    """Aspect rows with their error codes."""
    labels = F.col("positive_count") + F.col("neutral_count") + F.col("negative_count")
    more = codes({
        "rate_out_of_range": bad_rates(*LABEL_RATES),
        "labels_not_mentions": labels != F.col("mention_count"),
    })
    return aspects.withColumn("errors", F.concat(aspect_errors("aspect_code", allowed, batch, model), more))


def check_reasons(reasons: DataFrame, allowed: tuple[str, ...], batch: str, model: str) -> DataFrame:
    more = codes({"rate_out_of_range": bad_rates("share_of_negative_reviews")})
    return reasons.withColumn("errors", F.concat(aspect_errors("reason_code", allowed, batch, model), more))
