"""Raw reviews to cleaned, keyed, deduplicated and enriched reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import times
from reviewmill.functions.labels import is_label, weak_label
from reviewmill.functions.once import computed_once
from reviewmill.functions.text import base64_text, clean_text, is_blank, review_key, text_length
from reviewmill.operators.joins import first_per_key, lookup_join
from reviewmill.schemas import CLEAN_REVIEW_COLUMNS, HANDOFF_FIELDS, LABEL_SOURCE


def for_batch(table: DataFrame, batch: str) -> DataFrame:
    return table.filter(F.col("load_batch_id") == batch)


def with_text(table: DataFrame, text: str = "review_text") -> DataFrame:
    return table.filter(~is_blank(text))


def duplicate_order() -> list[Column]:
    """Which copy of a review survives. The list covers every raw column that
    copies can differ in, so the choice never depends on row order."""
    return [
        F.asc("review_timestamp"), F.asc("asin"), F.asc("parent_asin"), F.asc("rating"),
        F.desc("helpful_vote"), F.asc("verified_purchase"), F.asc("images_json"),
        F.asc("user_id"), F.asc("title"),
    ]


def dedupe(reviews: DataFrame) -> DataFrame:
    return first_per_key(reviews, "review_key", duplicate_order())


def unique_metadata(metadata: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One row per product, so that the join cannot multiply reviews.

    Without a file order, the smallest row in column order is taken.
    """
    if order is None:
        order = [F.asc(c) for c in ("product_title", "store_name", "main_category")]
    return first_per_key(metadata, "parent_asin", order)


def enrich(reviews: DataFrame, metadata: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Left join of product data; reviews without a product stay.

    The lookup must already be narrowed to its batch: a filter after the join
    would drop unmatched reviews.
    """
    lookup = metadata.select("parent_asin", "product_title", "store_name", "main_category", F.lit(True).alias("_hit"))
    joined = lookup_join(reviews, lookup, "parent_asin", "left", hot, spread_by=F.xxhash64("review_key"))
    return joined.withColumn("metadata_matched", F.col("_hit").isNotNull()).drop("_hit")


def with_derived_columns(reviews: DataFrame) -> DataFrame:
    """Columns computed from one row; added last, so that shuffles carry raw columns only."""
    timed = reviews.withColumns({
        "review_text_clean": clean_text("review_text"),
        "review_time": times.epoch_ms_to_time("review_timestamp"),
        "rating_label": weak_label("rating"),
        "label_source": F.lit(LABEL_SOURCE),
    })
    return timed.withColumns({
        "dt": times.date_text("review_time"),
        "review_year": times.year_text("review_time"),
        "text_length": text_length("review_text_clean"),
    })


def clean_reviews(reviews: DataFrame, metadata: DataFrame, batch: str, hot: DataFrame | None = None,
                  metadata_order: list[Column] | None = None) -> DataFrame:
    """The cleaned review table of one batch."""
    # The key hashes the whole text: once per review, whatever is filtered later.
    keyed = computed_once(with_text(for_batch(reviews, batch)), "review_key", review_key())
    lookup = unique_metadata(for_batch(metadata, batch), metadata_order)
    enriched = enrich(dedupe(keyed), lookup, hot)
    return with_derived_columns(enriched).select(*CLEAN_REVIEW_COLUMNS)


def eligible(reviews: DataFrame) -> DataFrame:
    """Reviews a classifier may see: text, key and one of the three labels."""
    return reviews.filter(~is_blank("review_text_clean") & ~is_blank("review_key") & is_label("rating_label"))


def handoff(reviews: DataFrame) -> DataFrame:
    """The classifier input: eligible reviews with the agreed columns in the agreed order."""
    return eligible(reviews).select(*HANDOFF_FIELDS)


def in_key_order(table: DataFrame, key: str = "review_key") -> DataFrame:
    """Global order by the Base64 text of the key, which is not the order of the key itself."""
    return table.orderBy(base64_text(key))


def previews(reviews: DataFrame, key_characters: int = 12) -> DataFrame:
    """Rows safe to show: a key prefix and the length of the text instead of both."""
    return reviews.select(
        F.substring("review_key", 1, key_characters).alias("review_key_prefix"),
        "rating_label", "rating", "parent_asin", "main_category",
        F.length("review_text_clean").alias("review_text_length"),
    )


def spot_check(reviews: DataFrame, n: int = 10) -> DataFrame:
    """A few rows in key order with a short text preview."""
    return reviews.orderBy("review_key").limit(n).select(
        F.substring("review_key", 1, 12).alias("review_key_prefix"),
        "asin", "parent_asin", "rating", "rating_label", "dt", "metadata_matched", "product_title", "store_name",
        F.substring("review_text_clean", 1, 80).alias("review_text_preview"),
    )
