"""Table schemas and the fixed values of the warehouse contract."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the published contract for results to agree.
# ---------------------------------------------------------------------------
KEY_SEPARATOR = "|#|"
LABELS = ("negative", "neutral", "positive")
UNKNOWN_LABEL = "unknown"
LABEL_SOURCE = "rating_weak_label"
FIELD_DELIMITER = "\u0001"
NULL_TEXT = "\\N"

HANDOFF_SCHEMA_VERSION = "production_v1.0"
HANDOFF_FIELDS = (
    "review_key", "review_text_clean", "rating_label", "rating",
    "parent_asin", "main_category", "review_time", "load_batch_id",
)
HANDOFF_FORBIDDEN = ("user_id", "review_text", "raw_metadata", "api_key", "credential", "password")
HANDOFF_MEANINGS = {
    "review_key": "Warehouse-generated stable identifier; preserve exactly.",
    "review_text_clean": "Cleaned non-empty review text for NLP input.",
    "rating_label": "Rating-derived weak label; not a model prediction.",
    "rating": "Original star rating.",
    "parent_asin": "Product-family identifier.",
    "main_category": "Product category when metadata matched.",
    "review_time": "Parsed review timestamp.",
    "load_batch_id": "Warehouse production batch identifier.",
}
HANDOFF_TYPES = {
    "review_key": "string",
    "review_text_clean": "string",
    "rating_label": "string enum: negative|neutral|positive",
    "rating": "number",
    "parent_asin": "string|null",
    "main_category": "string|null",
    "review_time": "string|null (Hive timestamp)",
    "load_batch_id": "string",
}
WEAK_LABEL_STATEMENT = "rating_label is derived from star rating and is not an NLP model prediction."
WEAK_LABEL_MAPPING = {"rating_1_to_2": "negative", "rating_3": "neutral", "rating_4_to_5": "positive"}

PREDICTION_REQUIRED = ("review_key", "pred_label", "pred_score", "model_version", "inferred_at")
PREDICTION_OPTIONAL = ("negative_score", "neutral_score", "positive_score")
PREDICTION_FORBIDDEN = (
    "user_id", "review_text", "review_text_clean", "api_key", "apikey",
    "credentials", "credential", "password", "sql", "query",
)
MODEL_VERSION_PATTERN = "^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"

REVIEW_JSON_FIELDS = (
    "rating", "title", "text", "images", "asin", "parent_asin",
    "user_id", "timestamp", "helpful_vote", "verified_purchase",
)
METADATA_JSON_FIELDS = (
    "main_category", "title", "average_rating", "rating_number", "features",
    "description", "price", "images", "videos", "store", "categories",
    "details", "parent_asin", "bought_together",
)
FIELD_MEANINGS = {
    "rating": "Review star rating",
    "title": "Review or product title",
    "text": "Review body text",
    "images": "Image information",
    "asin": "Amazon item identifier",
    "parent_asin": "Parent product identifier and join key",
    "user_id": "Reviewer identifier",
    "timestamp": "Review event timestamp",
    "helpful_vote": "Helpful-vote count",
    "verified_purchase": "Verified-purchase indicator",
    "main_category": "Primary product category",
    "average_rating": "Product average rating",
    "rating_number": "Product rating count",
    "features": "Product feature list",
    "description": "Product description",
    "price": "Product price",
    "videos": "Video information",
    "store": "Store or brand name",
    "categories": "Product category hierarchy",
    "details": "Product detail attributes",
    "bought_together": "Frequently bought-together information",
}
UNKNOWN_MEANING = "Meaning requires team confirmation"

ASPECT_CODES = (
    "appearance", "size_fit", "comfort", "material",
    "price_value", "quality", "shipping_packaging", "durability",
)
REASON_CODES = (
    "return_issue", "wrong_size", "poor_quality", "overpriced", "damaged_item",
    "uncomfortable", "color_mismatch", "not_as_described", "delivery_issue",
)
EXTRACTION_METHOD = "keyword_rules_v1"
ASPECT_RULE_VERSION = "fashion_aspects_v1"
REASON_RULE_VERSION = "negative_reasons_v1"

SERVING_TABLES = (
    "dws_sentiment_overview",
    "dws_sentiment_daily",
    "dws_product_sentiment",
    "dws_category_sentiment",
    "dws_store_sentiment",
    "dws_verified_purchase_sentiment",
    "dws_rating_prediction_matrix",
    "dws_prediction_confidence",
    "dws_monthly_sentiment",
    "dws_sentiment_alerts",
    "dws_review_samples",
    "dws_aspect_summary",
    "dws_negative_reasons",
)

# ---------------------------------------------------------------------------
# Table schemas (DDL)
# ---------------------------------------------------------------------------
RAW_REVIEW = (
    "rating DOUBLE, title STRING, review_text STRING, images_json STRING, asin STRING, "
    "parent_asin STRING, user_id STRING, review_timestamp BIGINT, helpful_vote BIGINT, "
    "verified_purchase BOOLEAN"
)
RAW_METADATA = (
    "main_category STRING, product_title STRING, average_rating DOUBLE, rating_number BIGINT, "
    "features_json STRING, description_json STRING, price_raw STRING, images_json STRING, "
    "videos_json STRING, store_name STRING, categories_json STRING, details_json STRING, "
    "parent_asin STRING, bought_together_json STRING"
)
CLEAN_REVIEW_COLUMNS = (
    "review_key", "asin", "parent_asin", "user_id", "rating", "title", "review_text",
    "review_text_clean", "review_timestamp", "review_time", "dt", "helpful_vote",
    "verified_purchase", "product_title", "store_name", "main_category", "rating_label",
    "label_source", "text_length", "metadata_matched", "load_batch_id", "review_year",
)
PREDICTION_STAGING = (
    "review_key STRING, pred_label STRING, pred_score DOUBLE, negative_score DOUBLE, "
    "neutral_score DOUBLE, positive_score DOUBLE, model_version STRING, inferred_at TIMESTAMP"
)
SENTIMENT_VIEW_COLUMNS = (
    "review_key", "asin", "parent_asin", "rating", "rating_label", "review_time", "dt",
    "verified_purchase", "helpful_vote", "product_title", "store_name", "main_category",
    "pred_label", "pred_score", "model_version", "inferred_at", "load_batch_id",
)
