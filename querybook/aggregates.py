"""The serving aggregates and the single-measure aggregates."""

from __future__ import annotations

from querybook.fixtures import predictions, raw_metadata, raw_reviews, review_view, text_view
from querybook.registry import common_table, query
from reviewmill.operators import aggregates as agg
from reviewmill.operators import alerts, partials, rules
from reviewmill.operators.ranking import review_samples
from reviewmill.settings import KeywordRule, RuleSet

_COUNTS = "COUNT(*) AS review_count, " + ", ".join(
    f"COUNT(*) FILTER (pred_label = '{label}') AS {label}_count, COALESCE(AVG(CAST(pred_label = '{label}' AS INTEGER)), 0) AS {label}_rate"
    for label in ("negative", "neutral", "positive"))
_RATING = "AVG(rating) AS average_rating"
_SCORE = "AVG(pred_score) AS average_prediction_score"
_VOTES = "AVG(CAST(helpful_vote AS DOUBLE)) AS average_helpful_vote"
_PRODUCTS = "COUNT(DISTINCT parent_asin) AS product_count"
_FOLDED = "CASE WHEN {0} IS NULL OR trim({0}) = '' THEN 'unknown' ELSE lower(trim({0})) END"

common_table("dws_overview", f"SELECT {_COUNTS}, {_PRODUCTS}, {_RATING}, {_SCORE} FROM review_view")
common_table("dws_daily", f"SELECT dt, {_COUNTS}, {_RATING} FROM review_view GROUP BY dt")
common_table("dws_product", f"""
  SELECT parent_asin, product_title, store_name, main_category, {_COUNTS}, {_RATING}, {_VOTES}, {_SCORE},
    CAST(SUM(CASE WHEN verified_purchase THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS verified_purchase_rate
  FROM review_view WHERE parent_asin IS NOT NULL AND trim(parent_asin) <> ''
  GROUP BY parent_asin, product_title, store_name, main_category""")
common_table("dws_category", f"""
  SELECT {_FOLDED.format('main_category')} AS category_key, COALESCE(MIN(t.main_category), 'unknown') AS main_category,
    {_COUNTS}, {_PRODUCTS}, {_RATING}, {_SCORE} FROM review_view t GROUP BY {_FOLDED.format('main_category')}""")
common_table("dws_store", f"""
  SELECT sha256({_FOLDED.format('store_name')}) AS store_key, COALESCE(MIN(t.store_name), 'unknown') AS store_name,
    {_COUNTS}, {_PRODUCTS}, {_RATING}, {_SCORE} FROM review_view t GROUP BY {_FOLDED.format('store_name')}""")
common_table("dws_verified", f"""
  SELECT CASE WHEN verified_purchase THEN 'verified' ELSE 'unverified' END AS purchase_status,
    {_COUNTS}, {_RATING}, {_VOTES}, {_SCORE} FROM review_view GROUP BY 1""")
common_table("dws_monthly", f"""
  SELECT strftime(review_time, '%Y-%m') AS month_id, {_COUNTS}, {_PRODUCTS}, {_RATING}, {_SCORE}
  FROM review_view GROUP BY 1""")
common_table("dws_matrix", """
  SELECT r.rating_value, l.pred_label, CAST(COALESCE(n, 0) AS BIGINT) AS review_count,
    CASE WHEN SUM(COALESCE(n, 0)) OVER (PARTITION BY r.rating_value) = 0 THEN 0.0::DOUBLE
         ELSE CAST(COALESCE(n, 0) AS DOUBLE) / CAST(SUM(COALESCE(n, 0)) OVER (PARTITION BY r.rating_value) AS DOUBLE) END AS rate_within_rating
  FROM (SELECT unnest([1, 2, 3, 4, 5]) AS rating_value) r
  CROSS JOIN (SELECT unnest(['negative', 'neutral', 'positive']) AS pred_label) l
  LEFT JOIN (SELECT rating, pred_label, COUNT(*) AS n FROM review_view GROUP BY ALL) c
    ON c.rating = r.rating_value AND c.pred_label = l.pred_label""")
common_table("dws_confidence", """
  SELECT b.bucket_code, b.bucket_order, b.minimum_score, b.maximum_score,
    CAST(COUNT(v.pred_score) AS BIGINT) AS review_count,
    CAST(COUNT(CASE WHEN pred_label = 'positive' THEN 1 END) AS BIGINT) AS positive_count,
    CAST(COUNT(CASE WHEN pred_label = 'neutral' THEN 1 END) AS BIGINT) AS neutral_count,
    CAST(COUNT(CASE WHEN pred_label = 'negative' THEN 1 END) AS BIGINT) AS negative_count,
    AVG(pred_score) AS average_prediction_score
  FROM (VALUES ('low', 1, 0.0::DOUBLE, 0.5::DOUBLE), ('medium', 2, 0.5::DOUBLE, 0.7::DOUBLE),
               ('high', 3, 0.7::DOUBLE, 0.9::DOUBLE), ('very_high', 4, 0.9::DOUBLE, 1.0::DOUBLE))
       b(bucket_code, bucket_order, minimum_score, maximum_score)
  LEFT JOIN review_view v ON v.pred_score >= b.minimum_score
    AND (v.pred_score < b.maximum_score OR (b.bucket_order = 4 AND v.pred_score = 1.0))
  GROUP BY ALL""")


def _alert_sql(table, entity, key, name, grain, min_reviews):
    rate = "negative_rate"
    return f"""
  SELECT sha256(concat_ws('|', '{entity}', {", ".join(f"COALESCE({c}, '')" for c in grain)}, 'negative_rate')) AS alert_id,
    '{entity}_negative_rate' AS alert_type,
    CASE WHEN {rate} >= 0.6 THEN 'CRITICAL' WHEN {rate} >= 0.5 THEN 'HIGH' WHEN {rate} >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level,
    '{entity}' AS entity_type, {key} AS entity_id, {name} AS entity_name, 'negative_rate' AS metric_name,
    {rate} AS metric_value,
    CASE WHEN {rate} >= 0.6 THEN 0.6::DOUBLE WHEN {rate} >= 0.5 THEN 0.5::DOUBLE WHEN {rate} >= 0.4 THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS threshold_value,
    review_count
  FROM {table} WHERE review_count >= {min_reviews} AND {rate} >= 0.3"""


common_table("dws_alerts", f"""
  SELECT *, concat_ws(' ', entity_type, entity_id, 'negative_rate reached', CAST(threshold_value AS VARCHAR)) AS alert_message FROM (
  {_alert_sql('dws_product', 'product', 'parent_asin', 'product_title', ('parent_asin', 'product_title', 'store_name', 'main_category'), 20)}
  UNION ALL {_alert_sql('dws_store', 'store', 'store_key', 'store_name', ('store_key',), 20)}
  UNION ALL {_alert_sql('dws_category', 'category', 'category_key', 'main_category', ('category_key',), 20)}) a""")

# The test prose has invented words; these rules use words that occur in it.
TEXT_ASPECTS = RuleSet(
    (
        KeywordRule("appearance", "Appearance", "(^| )(the|that)( |$)", ("the", "that")),
        KeywordRule("comfort", "Comfort", "(^| )(and|for)( |$)", ("and", "for")),
        KeywordRule("size_fit", "Size & Fit", "(^| )(le|la)( |$)", ("le", "la")),
        KeywordRule("material", "Material", "(^| )(in|it)( |$)", ("in", "it")),
        KeywordRule("price_value", "Price & Value", "(^| )(to|was)( |$)", ("to", "was")),
        KeywordRule("quality", "Quality", "(^| )(und|der)( |$)", ("und", "der")),
        KeywordRule("shipping_packaging", "Shipping & Packaging", "(^| )(de|los)( |$)", ("de", "los")),
        KeywordRule("durability", "Durability", "(^| )neverfound( |$)", ("neverfound",)),
    ),
    "test_aspects_v1", separator=" ",
)
TEXT_REASONS = RuleSet(
    (
        KeywordRule("wrong_size", "Wrong size", "(^| )(the|of) [a-z]+ (in|is)( |$)", needs=("the", "of")),
        KeywordRule("poor_quality", "Poor quality", "(^| )(erth|ent)( |$)", ("erth", "ent")),
        KeywordRule("return_issue", "Return issue", "(^| )(of|el)( |$)", ("of", "el")),
        KeywordRule("overpriced", "Overpriced", "(^| )(are|as)( |$)", ("are", "as")),
        KeywordRule("damaged_item", "Damaged item", "(^| )(by|be)( |$)", ("by", "be")),
        KeywordRule("uncomfortable", "Uncomfortable", "(^| )(with|from)( |$)", ("with", "from")),
        KeywordRule("color_mismatch", "Color mismatch", "(^| )(die|das)( |$)", ("die", "das")),
        KeywordRule("not_as_described", "Not as described", "(^| )(que|por)( |$)", ("que", "por")),
        KeywordRule("delivery_issue", "Delivery issue", "(^| )neverfound( |$)", ("neverfound",)),
    ),
    "test_reasons_v1", separator=" ",
)


def _rules_sql(rule_set):
    return " UNION ALL ".join(
        f"SELECT '{r.code}' AS code, '{r.name}' AS name, review_key FROM text_lower WHERE regexp_matches(t, '{r.pattern}')"
        for r in rule_set.rules
    )


def _names_sql(rule_set):
    return ", ".join(f"('{r.code}', '{r.name}')" for r in rule_set.rules)


common_table("text_lower", "SELECT review_key, lower(review_text_clean) AS t FROM text_view")
common_table("dws_aspects", f"""
  SELECT n.code AS aspect_code, n.name AS aspect_name, COUNT(v.review_key) AS mention_count,
    COUNT(DISTINCT v.parent_asin) AS product_count,
    COUNT(CASE WHEN pred_label = 'positive' THEN 1 END) AS positive_count,
    COUNT(CASE WHEN pred_label = 'neutral' THEN 1 END) AS neutral_count,
    COUNT(CASE WHEN pred_label = 'negative' THEN 1 END) AS negative_count,
    CASE WHEN COUNT(v.review_key) = 0 THEN 0.0::DOUBLE ELSE COUNT(CASE WHEN pred_label = 'positive' THEN 1 END)::DOUBLE / COUNT(v.review_key) END AS positive_rate,
    CASE WHEN COUNT(v.review_key) = 0 THEN 0.0::DOUBLE ELSE COUNT(CASE WHEN pred_label = 'neutral' THEN 1 END)::DOUBLE / COUNT(v.review_key) END AS neutral_rate,
    CASE WHEN COUNT(v.review_key) = 0 THEN 0.0::DOUBLE ELSE COUNT(CASE WHEN pred_label = 'negative' THEN 1 END)::DOUBLE / COUNT(v.review_key) END AS negative_rate,
    AVG(pred_score) AS average_prediction_score, 'keyword_rules_v1' AS extraction_method, 'test_aspects_v1' AS rule_version
  FROM (VALUES {_names_sql(TEXT_ASPECTS)}) n(code, name)
  LEFT JOIN ({_rules_sql(TEXT_ASPECTS)}) h ON h.code = n.code
  LEFT JOIN text_view v ON v.review_key = h.review_key
  GROUP BY n.code, n.name""")
common_table("dws_reasons", f"""
  SELECT n.code AS reason_code, n.name AS reason_name, COUNT(v.review_key) AS mention_count,
    COUNT(DISTINCT v.parent_asin) AS product_count,
    COUNT(v.review_key)::DOUBLE / (SELECT COUNT(*) FROM text_view WHERE pred_label = 'negative') AS share_of_negative_reviews,
    AVG(pred_score) AS average_prediction_score, 'keyword_rules_v1' AS extraction_method, 'test_reasons_v1' AS rule_version
  FROM (VALUES {_names_sql(TEXT_REASONS)}) n(code, name)
  LEFT JOIN ({_rules_sql(TEXT_REASONS)}) h ON h.code = n.code
  LEFT JOIN text_view v ON v.review_key = h.review_key AND v.pred_label = 'negative'
  GROUP BY n.code, n.name""")
common_table("dws_samples", """
  SELECT sample_id, parent_asin, product_title, main_category, rating, pred_label, pred_score,
    review_text_preview, text_length, strftime(review_time, '%Y-%m-%d %H:%M:%S') AS review_time, sample_rank
  FROM (SELECT *, sha256(concat_ws('|', load_batch_id, model_version, review_key)) AS sample_id,
          substring(review_text_clean, 1, 160) AS review_text_preview, length(review_text_clean) AS text_length,
          ROW_NUMBER() OVER (PARTITION BY pred_label ORDER BY pred_score DESC,
            sha256(concat_ws('|', load_batch_id, model_version, review_key))) AS sample_rank
        FROM text_view) ranked WHERE sample_rank <= 50""")


# -- serving tables as the queries below and the serving queries see them ----
def overview(spark, sf):
    return agg.sentiment_overview(review_view(spark, sf))


def daily(spark, sf):
    return agg.sentiment_daily(review_view(spark, sf))


def products(spark, sf):
    return agg.product_sentiment(review_view(spark, sf))


def categories(spark, sf):
    return agg.category_sentiment(review_view(spark, sf))


def stores(spark, sf):
    return agg.store_sentiment(review_view(spark, sf))


def verified(spark, sf):
    return agg.verified_sentiment(review_view(spark, sf))


def monthly(spark, sf):
    return agg.monthly_sentiment(review_view(spark, sf))


def matrix(spark, sf):
    return agg.rating_matrix(review_view(spark, sf))


def confidence(spark, sf):
    return agg.confidence_buckets(review_view(spark, sf))


def alert_table(spark, sf):
    return alerts.sentiment_alerts(products(spark, sf), stores(spark, sf), categories(spark, sf))


def aspects(spark, sf):
    return rules.aspect_summary(text_view(spark, sf), TEXT_ASPECTS)


def reasons(spark, sf):
    return rules.negative_reasons(text_view(spark, sf), TEXT_REASONS)


def samples(spark, sf):
    return review_samples(text_view(spark, sf))


query("sentiment_overview", "SELECT * FROM dws_overview")(overview)
query("sentiment_daily", "SELECT * FROM dws_daily")(daily)
query("product_sentiment", "SELECT * FROM dws_product")(products)
query("category_sentiment", "SELECT * FROM dws_category")(categories)
query("store_sentiment", "SELECT * FROM dws_store")(stores)
query("verified_sentiment", "SELECT * FROM dws_verified")(verified)
query("monthly_sentiment", "SELECT * FROM dws_monthly")(monthly)
query("rating_matrix", "SELECT * FROM dws_matrix")(matrix)
query("confidence_buckets", "SELECT * FROM dws_confidence")(confidence)
query("sentiment_alerts", "SELECT * FROM dws_alerts")(alert_table)
query("aspect_summary", "SELECT * FROM dws_aspects")(aspects)
query("negative_reasons", "SELECT * FROM dws_reasons")(reasons)


@query("review_samples", "SELECT * FROM dws_samples")
def _samples(spark, sf):
    from reviewmill.functions.serving_values import normalise

    return normalise(samples(spark, sf))


@query("count_distinct_keys", "SELECT COUNT(DISTINCT parent_asin) AS distinct_products FROM review_view WHERE parent_asin IS NOT NULL AND trim(parent_asin) <> ''")
def _distinct(spark, sf):
    return agg.distinct_products(review_view(spark, sf))


_SOURCE_KEY = "concat(l_orderkey, '-', l_linenumber)"


def _source_keys(spark, sf):
    from querybook.registry import load

    return load(spark, sf, "lineitem").selectExpr(f"{_SOURCE_KEY} AS source_key")


@query("duplicate_groups", f"SELECT COUNT(*) AS duplicate_groups FROM (SELECT {_SOURCE_KEY} FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) d")
def _dup_groups(spark, sf):
    return agg.duplicate_groups(_source_keys(spark, sf), "source_key")


@query("duplicate_excess", f"SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_excess FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY {_SOURCE_KEY} HAVING COUNT(*) > 1) d")
def _dup_excess(spark, sf):
    return agg.duplicate_excess(_source_keys(spark, sf), "source_key")


@query("distribution", "SELECT rating_label, COUNT(*) AS row_count FROM review_view GROUP BY 1 ORDER BY 1")
def _distribution(spark, sf):
    return agg.distribution(review_view(spark, sf), "rating_label")


@query("distribution_of_ratings", "SELECT rating, COUNT(*) AS row_count FROM raw_reviews GROUP BY 1 ORDER BY 1 NULLS FIRST")
def _distribution_rating(spark, sf):
    return agg.distribution(raw_reviews(spark, sf), "rating")


@query("non_null_counts", """SELECT COUNT(product_title) AS product_title_non_null, COUNT(store_name) AS store_name_non_null,
  COUNT(main_category) AS main_category_non_null FROM review_view""")
def _non_null(spark, sf):
    return agg.non_null_counts(review_view(spark, sf), "product_title", "store_name", "main_category")


@query("score_stats", "SELECT MIN(pred_score) AS score_minimum, MAX(pred_score) AS score_maximum, AVG(pred_score) AS score_mean FROM review_view")
def _score_stats(spark, sf):
    return agg.score_stats(review_view(spark, sf))


@query("label_distribution", """SELECT COUNT(CASE WHEN pred_label = 'negative' THEN 1 END) AS negative,
  COUNT(CASE WHEN pred_label = 'neutral' THEN 1 END) AS neutral, COUNT(CASE WHEN pred_label = 'positive' THEN 1 END) AS positive FROM predictions""")
def _label_distribution(spark, sf):
    return agg.label_distribution(predictions(spark, sf))


@query("rate_within_rating", "SELECT rating_value, pred_label, rate_within_rating FROM dws_matrix")
def _rate_within(spark, sf):
    return matrix(spark, sf).select("rating_value", "pred_label", "rate_within_rating")


@query("sample_rank", "SELECT sample_id, pred_label, sample_rank FROM dws_samples")
def _sample_rank(spark, sf):
    return samples(spark, sf).select("sample_id", "pred_label", "sample_rank")


@query("first_metadata_products", "SELECT COUNT(DISTINCT parent_asin) AS distinct_products FROM raw_metadata")
def _meta_products(spark, sf):
    return agg.distinct_products(raw_metadata(spark, sf))


# -- the same tables from one table of partials, with exact distinct counts that merge ----
def _partials(spark, sf):
    view = review_view(spark, sf)
    return partials.kept(partials.daily_partials(view, partials.product_numbers(view)), "daily-partials")


def _from_partials(name: str, sql: str, build):
    query(name, sql)(lambda spark, sf: build(_partials(spark, sf)))


_from_partials("partial_overview", "SELECT * FROM dws_overview", lambda p: partials.overview(partials.bitmaps(p)))
_from_partials("partial_categories", "SELECT * FROM dws_category", lambda p: partials.categories(partials.bitmaps(p, "main_category")))
_from_partials("partial_stores", "SELECT * FROM dws_store", partials.stores)
_from_partials("partial_months", "SELECT * FROM dws_monthly", lambda p: partials.monthly(partials.bitmaps(p, "month_id")))
_from_partials("partial_products", "SELECT * FROM dws_product", partials.products)


@query("merged_overview", "SELECT * FROM dws_overview")
def _merged_overview(spark, sf):
    """The overview of two halves of the time, delivered one after the other; products of the first keep their numbers."""
    view = review_view(spark, sf)
    early, late = view.filter("dt < '1995-06-01'"), view.filter("dt >= '1995-06-01'")
    first = partials.kept(partials.product_numbers(early), "product-numbers")
    both = partials.kept(partials.product_numbers(late, first), "product-numbers")
    halves = [partials.bitmaps(partials.daily_partials(rows, numbers)) for rows, numbers in ((early, first), (late, both))]
    return partials.overview(partials.merged(*halves))
