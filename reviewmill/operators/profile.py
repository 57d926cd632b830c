"""Profiles of raw JSON objects: fields, types, values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import labels, numbers, times
from reviewmill.functions.once import literal_rows
from reviewmill.functions.text import missing_or_blank, strip
from reviewmill.functions.variants import JsonField, kind_of, open_fields
from reviewmill.schemas import FIELD_MEANINGS, UNKNOWN_MEANING

KINDS = ("null", "boolean", "integer", "number", "string", "array", "object")


def _rows(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def exploded_fields(objects: DataFrame) -> DataFrame:
    """One row per object field: its name ``field``, value ``node`` and JSON ``kind``."""
    source = objects.select(F.from_json("value", "map<string,string>").alias("_texts"), F.col("v").alias("_v"))
    fields = source.lateralJoin(source.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    typed = fields.withColumn("_type", F.schema_of_variant("value"))
    # Of a repeated field the last text, as the VARIANT has the last value.
    raw = F.element_at(F.filter(F.map_entries("_texts"), lambda e: e["key"] == F.col("key")), -1)["value"]
    return typed.select(F.col("key").alias("field"), F.col("value").alias("node"), kind_of(F.col("_type"), raw).alias("kind"))


def field_shapes(objects: DataFrame) -> DataFrame:
    """``field, kind, blank, row_count``: how often each field has each JSON kind, blank strings apart.

    A line's shape is the list of its fields with their kinds. Lines are counted by shape, which takes
    one row from each of them; only the shapes, few where lines come from one writer, are unfolded. The text of numbers
    is parsed only in lines that hold a number whose spelling decides its kind.
    """
    fields = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))
    spelt = F.when(F.col("value").rlike(r"\d[.eE]|\d{19}"), F.map_entries(F.from_json("value", "map<string,string>")))

    def shape(entry: Column, texts: Column) -> Column:
        schema = F.schema_of_variant(entry["value"])
        # Of a repeated field the last text, as the VARIANT has the last value.
        raw = F.element_at(F.filter(texts, lambda t: t["key"] == entry["key"]), -1)["value"]
        blank = (schema == "STRING") & missing_or_blank(F.try_variant_get(entry["value"], "$", "string"))
        return F.struct(entry["key"].alias("field"), kind_of(schema, raw).alias("kind"), F.coalesce(blank, F.lit(False)).alias("blank"))

    lines = F.transform(F.array(F.struct(fields.alias("fields"), spelt.alias("texts"))),
                        lambda x: F.transform(x["fields"], lambda e: shape(e, x["texts"])))
    shapes = objects.select(F.flatten(lines).alias("shape")).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))
    return shapes.select("n", F.inline("shape")).groupBy("field", "kind", "blank").agg(F.sum("n").alias("row_count"))


def field_profile(objects: DataFrame) -> DataFrame:
    """Per field: occurrences, nulls, blank strings and the count of each JSON kind."""
    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("row_count"))), F.lit(0))

    kind = F.col("kind")
    return field_shapes(objects).groupBy("field").agg(
        F.sum("row_count").alias("occurrences"), rows(kind == "null").alias("nulls"), rows(F.col("blank")).alias("blank_strings"),
        *[rows(kind == k).alias(f"{k}_count") for k in KINDS])


def proposed_type(kinds: Column) -> Column:
    """Column type that holds all observed JSON kinds (an array of kind names)."""
    observed = F.array_distinct(F.array_except(kinds, F.array(F.lit("null"))))

    def only(*allowed: str) -> Column:
        return (F.size(observed) > 0) & (F.size(F.array_except(observed, F.array(*[F.lit(a) for a in allowed]))) == 0)

    return (
        F.when(only("integer"), F.lit("BIGINT"))
        .when(only("integer", "number"), F.lit("DOUBLE"))
        .when(only("boolean"), F.lit("BOOLEAN"))
        .when(only("array"), F.lit("ARRAY<STRING>"))
        .otherwise(F.lit("STRING"))
    )


def data_dictionary(objects: DataFrame, expected: tuple[str, ...], dataset: str) -> DataFrame:
    """One row per observed or expected field: presence, kinds, nullability, type and status."""
    profile = field_profile(objects)
    wanted = literal_rows(objects, field=expected, expected=(True,) * len(expected))
    meanings = literal_rows(objects, field=tuple(FIELD_MEANINGS), meaning=tuple(FIELD_MEANINGS.values()))
    total = objects.agg(F.count(F.lit(1)).alias("total"))
    # The object count travels as one more row and is spread by a window over the few fields.
    joined = profile.join(wanted, "field", "full").join(meanings, "field", "left")
    counted = joined.unionByName(total, allowMissingColumns=True)
    everything = Window.partitionBy(F.lit(1))
    with_total = counted.withColumn("_total", F.max("total").over(everything)).filter(F.col("field").isNotNull())
    presence = F.coalesce("occurrences", F.lit(0))
    kinds = F.array_compact(F.array(*[
        F.when(F.coalesce(F.col(f"{kind}_count"), F.lit(0)) > 0, F.lit(kind)) for kind in sorted(KINDS)
    ]))
    status = (
        F.when(F.col("occurrences").isNull(), F.lit("missing"))
        .when(F.col("expected").isNull(), F.lit("unexpected"))
        .when(presence < F.col("_total"), F.lit("optional"))
        .otherwise(F.lit("observed"))
    )
    return with_total.select(
        F.lit(dataset).alias("dataset"), "field", presence.alias("presence"), F.concat_ws(",", kinds).alias("kinds"),
        ((presence < F.col("_total")) | (F.coalesce("nulls", F.lit(0)) > 0)).alias("nullable"),
        F.coalesce("meaning", F.lit(UNKNOWN_MEANING)).alias("meaning"),
        proposed_type(kinds).alias("proposed_type"), status.alias("status"),
    )


def _facts(objects: DataFrame) -> DataFrame:
    """The parsed columns the review profile is made of."""
    text, parent, verified = JsonField("text"), JsonField("parent_asin"), JsonField("verified_purchase")
    opened = open_fields(objects, "text", "rating", "timestamp", "helpful_vote", "parent_asin", "verified_purchase")
    parsed = opened.select(
        text.kind.alias("text_kind"), ((text.schema == "STRING") & missing_or_blank(text.as_text())).alias("blank_text"),
        numbers.parse_number(JsonField("rating").number_text()).alias("rating"),
        JsonField("timestamp").number_text().alias("time_text"),
        numbers.parse_number(JsonField("timestamp").number_text()).alias("time_raw"),
        numbers.parse_number(JsonField("helpful_vote").number_text()).alias("votes"),
        strip(parent.as_text()).alias("parent"),
        F.concat_ws(":", F.coalesce(verified.kind, F.lit("null")),
                    F.lower(F.coalesce(verified.raw, F.lit("none")))).alias("verified"),
    )
    return parsed.withColumn("time", times.parse_timestamp("time_text", F.col("time_raw")))


def review_profile(objects: DataFrame, metadata_parents: DataFrame) -> DataFrame:
    """One row of measures over review objects.

    ``metadata_parents`` has one column ``parent`` of distinct product keys.
    """
    facts = _facts(objects)
    label = labels.weak_label_in_range("rating")
    time, votes = F.col("time"), F.col("votes")
    raw = F.when(time.isNotNull(), F.coalesce(F.col("time_raw"), F.unix_micros(time) / F.lit(1e6)))
    good_votes = votes.isNotNull() & (votes >= 0)
    counts = {
        "valid_object_count": F.lit(True),
        "missing_review_text_count": F.col("text_kind").isNull(),
        "null_review_text_count": F.col("text_kind") == "null",
        "blank_review_text_count": F.col("blank_text"),
        "invalid_rating_count": F.col("rating").isNull(),
        "rating_outside_1_to_5_count": (F.col("rating") < 1) | (F.col("rating") > 5),
        **{f"weak_{name}_count": label == name for name in ("negative", "neutral", "positive")},
        "timestamp_valid_count": time.isNotNull(),
        "timestamp_invalid_or_missing_count": time.isNull(),
        "helpful_vote_valid_count": good_votes,
        "helpful_vote_invalid_or_missing_count": ~F.coalesce(good_votes, F.lit(False)),
        "helpful_vote_zero_count": good_votes & (votes == 0),
    }
    lows = {"timestamp_minimum_raw": raw, "timestamp_minimum_utc": time, "helpful_vote_minimum": F.when(good_votes, votes)}
    highs = {"timestamp_maximum_raw": raw, "timestamp_maximum_utc": time, "helpful_vote_maximum": F.when(good_votes, votes)}
    # Everything is first measured per product, which is also what the metadata
    # keys are joined to: the lines are parsed once and one row per product is joined.
    per_product = facts.groupBy(F.nullif("parent", F.lit("")).alias("parent")).agg(
        *[_rows(condition).alias(name) for name, condition in counts.items()],
        *[F.min(value).alias(name) for name, value in lows.items()],
        *[F.max(value).alias(name) for name, value in highs.items()],
        F.sum(F.when(good_votes, votes)).alias("votes"),
    )
    joined = per_product.join(metadata_parents.withColumn("hit", F.lit(True)), "parent", "left")
    n = F.col("valid_object_count")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    row = joined.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        *[F.min(name).alias(name) for name in lows],
        *[F.max(name).alias(name) for name in highs],
        (F.sum("votes") / F.nullif(F.sum("helpful_vote_valid_count"), F.lit(0))).alias("helpful_vote_mean"),
        total(F.col("parent").isNotNull()).alias("reviews_with_parent_asin"),
        total(F.col("parent").isNull()).alias("missing_or_blank_parent_asin_rows"),
        total(F.col("hit").isNotNull()).alias("matched_parent_asin_rows"),
    )
    return row.withColumns({
        "unmatched_parent_asin_rows": F.col("reviews_with_parent_asin") - F.col("matched_parent_asin_rows"),
        "sample_parent_asin_join_rate": numbers.safe_rate("matched_parent_asin_rows", "reviews_with_parent_asin"),
    })


def rating_distribution(objects: DataFrame) -> DataFrame:
    """Count by canonical rating; values that are no number are left out."""
    opened = open_fields(objects, "rating").select(numbers.parse_number(JsonField("rating").number_text()).alias("rating"))
    rows = opened.select(numbers.canonical_number("rating").alias("rating")).filter(F.col("rating").isNotNull())
    return rows.groupBy("rating").agg(F.count(F.lit(1)).alias("row_count"))


def verified_distribution(objects: DataFrame) -> DataFrame:
    """Count by JSON kind and value of the purchase flag."""
    return _facts(objects).groupBy("verified").agg(F.count(F.lit(1)).alias("row_count"))


def metadata_parents(objects: DataFrame) -> DataFrame:
    """Distinct stripped product keys of metadata objects."""
    parents = open_fields(objects, "parent_asin").select(strip(JsonField("parent_asin").as_text()).alias("parent"))
    return parents.filter(F.col("parent") != "").distinct()


def metadata_profile(objects: DataFrame) -> DataFrame:
    """Distinct product keys; the field profile is :func:`field_profile`."""
    parents = open_fields(objects, "parent_asin").select(strip(JsonField("parent_asin").as_text()).alias("parent"))
    return parents.agg(
        F.count(F.lit(1)).alias("valid_object_count"),
        F.count_distinct(F.when(F.col("parent") != "", F.col("parent"))).alias("distinct_parent_asin_within_sample"),
    )
