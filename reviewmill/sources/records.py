"""Parsed JSON objects to typed raw-layer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from reviewmill.functions.variants import JsonField, open_fields
from reviewmill.schemas import METADATA_JSON_FIELDS, REVIEW_JSON_FIELDS


def review_columns() -> list[Column]:
    return [
        JsonField("rating").as_number().alias("rating"),
        JsonField("title").as_string().alias("title"),
        JsonField("text").as_string().alias("review_text"),
        JsonField("images").as_json().alias("images_json"),
        JsonField("asin").as_string().alias("asin"),
        JsonField("parent_asin").as_string().alias("parent_asin"),
        JsonField("user_id").as_string().alias("user_id"),
        JsonField("timestamp").as_integer().alias("review_timestamp"),
        JsonField("helpful_vote").as_integer().alias("helpful_vote"),
        JsonField("verified_purchase").as_boolean().alias("verified_purchase"),
    ]


def metadata_columns() -> list[Column]:
    return [
        JsonField("main_category").as_string().alias("main_category"),
        JsonField("title").as_string().alias("product_title"),
        JsonField("average_rating").as_number().alias("average_rating"),
        JsonField("rating_number").as_integer().alias("rating_number"),
        JsonField("features").as_json().alias("features_json"),
        JsonField("description").as_json().alias("description_json"),
        JsonField("price").as_raw_price().alias("price_raw"),
        JsonField("images").as_json().alias("images_json"),
        JsonField("videos").as_json().alias("videos_json"),
        JsonField("store").as_string().alias("store_name"),
        JsonField("categories").as_json().alias("categories_json"),
        JsonField("details").as_json().alias("details_json"),
        JsonField("parent_asin").as_string().alias("parent_asin"),
        JsonField("bought_together").as_json().alias("bought_together_json"),
    ]


def to_reviews(objects: DataFrame, *keep: str) -> DataFrame:
    return open_fields(objects, *REVIEW_JSON_FIELDS).select(*keep, *review_columns())


def to_metadata(objects: DataFrame, *keep: str) -> DataFrame:
    return open_fields(objects, *METADATA_JSON_FIELDS).select(*keep, *metadata_columns())
