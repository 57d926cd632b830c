"""Serving queries and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook import warehouse as tables
from querybook.fixtures import BATCH, MODEL, predictions, review_view
from querybook.registry import common_table, query
from reviewmill.functions.labels import level_rank
from reviewmill.functions.serving_values import normalise
from reviewmill.functions.text import equals_ignore_case, looks_like_smoke_model
from reviewmill.operators.aggregates import scope
from reviewmill.plans import reports, serving_queries as serving

_NEG = "ORDER BY negative_rate DESC, negative_count DESC, review_count DESC"
_POS = "ORDER BY positive_rate DESC, positive_count DESC, review_count DESC"
_GRAIN = "parent_asin, product_title NULLS FIRST, store_name NULLS FIRST, main_category NULLS FIRST"
_RANK = "CASE lower(alert_level) WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END"
_ALERT_ORDER = f"ORDER BY {_RANK}, metric_value DESC, alert_id"

# ---- rankings and listings -------------------------------------------------


@query("top_negative_products", f"SELECT * FROM dws_product WHERE review_count >= 1 {_NEG}, {_GRAIN} LIMIT 10")
def _top_negative_products(spark, sf):
    return serving.top_negative_products(tables.products(spark, sf))


@query("top_positive_products", f"""SELECT parent_asin, product_title, store_name, main_category, review_count, average_rating,
  positive_count, positive_rate, neutral_rate, negative_rate, average_prediction_score
  FROM dws_product WHERE review_count >= 5 {_POS}, {_GRAIN} LIMIT 10""")
def _top_positive_products(spark, sf):
    return serving.top_positive_products(tables.products(spark, sf))


@query("top_negative_stores", f"SELECT * FROM dws_store WHERE review_count >= 20 {_NEG}, store_key LIMIT 10")
def _top_negative_stores(spark, sf):
    return serving.top_negative_stores(tables.stores(spark, sf))


@query("top_positive_stores", f"""SELECT store_key, store_name, review_count, product_count, average_rating, positive_count,
  positive_rate, neutral_rate, negative_rate, average_prediction_score FROM dws_store WHERE review_count >= 20 {_POS}, store_key LIMIT 10""")
def _top_positive_stores(spark, sf):
    return serving.top_positive_stores(tables.stores(spark, sf))


@query("trend_range", "SELECT * FROM dws_daily WHERE dt >= '1996-01-01' AND dt <= '1998-12-31' ORDER BY dt LIMIT 500")
def _trend_range(spark, sf):
    return serving.trend(tables.daily(spark, sf), "1996-01-01", "1998-12-31", limit=500)


@query("date_range", "SELECT review_key, dt FROM review_view WHERE dt >= '1997-03-01' AND dt <= '1997-06-30'")
def _date_range(spark, sf):
    return serving.between_dates(review_view(spark, sf), "1997-03-01", "1997-06-30").select("review_key", "dt")


@query("trend_recent", "SELECT * FROM (SELECT * FROM dws_daily ORDER BY dt DESC LIMIT 30) t ORDER BY dt")
def _trend_recent(spark, sf):
    return serving.trend(tables.daily(spark, sf), recent_days=30)


@query("monthly_trend", "SELECT * FROM (SELECT * FROM dws_monthly ORDER BY month_id DESC LIMIT 24) t ORDER BY month_id")
def _monthly_trend(spark, sf):
    return serving.monthly_trend(tables.monthly(spark, sf), last=24)


@query("categories", "SELECT * FROM dws_category ORDER BY review_count DESC, category_key")
def _categories(spark, sf):
    return serving.categories(tables.categories(spark, sf))


@query("verified_purchase", "SELECT * FROM dws_verified ORDER BY review_count DESC, purchase_status")
def _verified(spark, sf):
    return serving.verified_purchase(tables.verified(spark, sf))


@query("matrix_rows", "SELECT * FROM dws_matrix ORDER BY rating_value, pred_label")
def _matrix(spark, sf):
    return serving.rating_matrix_rows(tables.matrix(spark, sf))


@query("confidence_rows", "SELECT * FROM dws_confidence ORDER BY bucket_order")
def _confidence(spark, sf):
    return serving.confidence_rows(tables.confidence(spark, sf))


_ASPECT_COLUMNS = """aspect_code AS aspect, aspect_code AS reason_code, aspect_name AS reason_name, mention_count, product_count,
  positive_count, neutral_count, negative_count, positive_rate, neutral_rate, negative_rate,
  average_prediction_score AS average_confidence, average_prediction_score, rule_version AS extractor_version,
  extraction_method, rule_version"""


@query("aspect_rows", f"SELECT {_ASPECT_COLUMNS} FROM dws_aspects ORDER BY mention_count DESC, negative_rate DESC, aspect_code")
def _aspect_rows(spark, sf):
    return serving.aspect_rows(tables.aspects(spark, sf))


@query("aspect_rows_by_name", f"SELECT {_ASPECT_COLUMNS} FROM dws_aspects WHERE lower(aspect_code) = 'size & fit' OR lower(aspect_name) = 'size & fit'")
def _aspect_by_name(spark, sf):
    return serving.aspect_rows(tables.aspects(spark, sf), " Size & Fit ")


@query("reason_rows", """SELECT '' AS parent_asin, '' AS product_title, '' AS aspect, reason_code, reason_name,
  mention_count AS reason_count, share_of_negative_reviews AS reason_share, mention_count, product_count,
  share_of_negative_reviews, average_prediction_score, rule_version AS extractor_version, extraction_method, rule_version
  FROM dws_reasons ORDER BY mention_count DESC, share_of_negative_reviews DESC, reason_code LIMIT 20""")
def _reason_rows(spark, sf):
    return serving.reason_rows(tables.reasons(spark, sf))


@query("alert_rows", f"SELECT * FROM dws_alerts {_ALERT_ORDER} LIMIT 20")
def _alert_rows(spark, sf):
    return serving.alert_rows(tables.alert_table(spark, sf))


@query("sample_rows", "SELECT * FROM dws_samples WHERE pred_label = 'negative' ORDER BY sample_rank, pred_score DESC, sample_id LIMIT 20")
def _sample_rows(spark, sf):
    return normalise(serving.sample_rows(tables.samples(spark, sf), 20, "Negative"))


@query("kpi", "SELECT * FROM dws_overview")
def _kpi(spark, sf):
    return serving.kpi(tables.overview(spark, sf))


@query("concat_alerts", f"""SELECT * FROM (
  SELECT * FROM (SELECT * FROM dws_alerts WHERE alert_level = 'CRITICAL' {_ALERT_ORDER} LIMIT 20) c
  UNION ALL SELECT * FROM (SELECT * FROM dws_alerts WHERE alert_level = 'HIGH' {_ALERT_ORDER} LIMIT 20) h) a
  {_ALERT_ORDER} LIMIT 20""")
def _concat_alerts(spark, sf):
    return serving.high_and_critical(tables.alert_table(spark, sf))


@query("alerts_of_entity", f"""SELECT a.* FROM dws_alerts a
  WHERE a.entity_id IN (SELECT parent_asin FROM (SELECT * FROM dws_product WHERE review_count >= 20 {_NEG}, {_GRAIN} LIMIT 1) t)""")
def _alerts_of_entity(spark, sf):
    top = serving.top_negative_products(tables.products(spark, sf), 1, 20)
    return serving.alerts_of(tables.alert_table(spark, sf), top, "parent_asin")


@query("aspect_negatives_top8", """SELECT aspect_code, CAST(SUM(negative_count) AS BIGINT) AS negative_count FROM dws_aspects
  GROUP BY aspect_code ORDER BY negative_count DESC, aspect_code LIMIT 8""")
def _top_aspects(spark, sf):
    return serving.top_aspects(tables.aspects(spark, sf))


@query("min_reviews", "SELECT parent_asin, product_title, store_name, main_category, review_count FROM dws_product WHERE review_count >= 25")
def _min_reviews(spark, sf):
    return serving.min_reviews(tables.products(spark, sf), 25).select(
        "parent_asin", "product_title", "store_name", "main_category", "review_count")


@query("product_key_present", "SELECT COUNT(*) AS row_count FROM review_view WHERE parent_asin IS NOT NULL AND trim(parent_asin) <> ''")
def _product_present(spark, sf):
    return tables.products(spark, sf).agg(F.sum("review_count").alias("row_count"))


@query("batch_filter", f"SELECT COUNT(*) AS row_count, COUNT(DISTINCT review_key) AS key_count FROM predictions WHERE load_batch_id = '{BATCH}' AND model_version = '{MODEL}'")
def _batch_filter(spark, sf):
    rows = scope(predictions(spark, sf), BATCH, MODEL)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("review_key").alias("key_count"))


@query("alert_level_rank", f"SELECT alert_id, {_RANK} AS level_order FROM dws_alerts")
def _level_rank(spark, sf):
    return tables.alert_table(spark, sf).select("alert_id", level_rank("alert_level").alias("level_order"))


@query("lower_match", "SELECT doc_id FROM documents WHERE lower(lang) = 'en'")
def _lower_match(spark, sf):
    from querybook.registry import load

    return load(spark, sf, "documents").filter(equals_ignore_case("lang", " EN ")).select("doc_id")


@query("smoke_like", """SELECT model, COUNT(*) AS row_count FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'SMOKE_' || o_orderpriority WHEN 1 THEN 'contract_is_not_a_model'
    WHEN 2 THEN 'my_Synthetic' ELSE o_orderpriority END AS model FROM orders) m
  WHERE lower(model) LIKE '%smoke%' OR lower(model) LIKE '%synthetic%' OR lower(model) LIKE '%contract%not%a%model%' GROUP BY model""")
def _smoke(spark, sf):
    from querybook.registry import load

    models = load(spark, sf, "orders").selectExpr(
        "CASE o_orderkey % 4 WHEN 0 THEN concat('SMOKE_', o_orderpriority) WHEN 1 THEN 'contract_is_not_a_model' "
        "WHEN 2 THEN 'my_Synthetic' ELSE o_orderpriority END AS model")
    return models.filter(looks_like_smoke_model("model")).groupBy("model").agg(F.count(F.lit(1)).alias("row_count"))


@query("value_normalise", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at_time,
  strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS at_date, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price,
  o_orderpriority AS bytes FROM orders""")
def _normalise(spark, sf):
    from querybook.registry import load

    return normalise(load(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as timestamp) AS at_time", "cast(o_orderdate as date) AS at_date",
        "cast(o_totalprice as decimal(18, 2)) AS price", "cast(o_orderpriority as binary) AS bytes"))


@query("table_counts", """SELECT 'dws_sentiment_overview' AS table_name, COUNT(*) AS "rows" FROM dws_overview
  UNION ALL SELECT 'dws_sentiment_daily', COUNT(*) FROM dws_daily
  UNION ALL SELECT 'dws_product_sentiment', COUNT(*) FROM dws_product
  UNION ALL SELECT 'dws_category_sentiment', COUNT(*) FROM dws_category
  UNION ALL SELECT 'dws_store_sentiment', COUNT(*) FROM dws_store
  UNION ALL SELECT 'dws_verified_purchase_sentiment', COUNT(*) FROM dws_verified
  UNION ALL SELECT 'dws_rating_prediction_matrix', COUNT(*) FROM dws_matrix
  UNION ALL SELECT 'dws_prediction_confidence', COUNT(*) FROM dws_confidence
  UNION ALL SELECT 'dws_monthly_sentiment', COUNT(*) FROM dws_monthly
  UNION ALL SELECT 'dws_sentiment_alerts', COUNT(*) FROM dws_alerts
  UNION ALL SELECT 'dws_review_samples', COUNT(*) FROM dws_samples
  UNION ALL SELECT 'dws_aspect_summary', COUNT(*) FROM dws_aspects
  UNION ALL SELECT 'dws_negative_reasons', COUNT(*) FROM dws_reasons
  UNION ALL SELECT 'review_count', review_count FROM dws_overview""")
def _table_counts(spark, sf):
    return serving.health_counts({
        "dws_sentiment_overview": tables.overview(spark, sf),
        "dws_sentiment_daily": tables.daily(spark, sf),
        "dws_product_sentiment": tables.products(spark, sf),
        "dws_category_sentiment": tables.categories(spark, sf),
        "dws_store_sentiment": tables.stores(spark, sf),
        "dws_verified_purchase_sentiment": tables.verified(spark, sf),
        "dws_rating_prediction_matrix": tables.matrix(spark, sf),
        "dws_prediction_confidence": tables.confidence(spark, sf),
        "dws_monthly_sentiment": tables.monthly(spark, sf),
        "dws_sentiment_alerts": tables.alert_table(spark, sf),
        "dws_review_samples": tables.samples(spark, sf),
        "dws_aspect_summary": tables.aspects(spark, sf),
        "dws_negative_reasons": tables.reasons(spark, sf),
    })


# ---- derived reports -------------------------------------------------------


@query("weighted_confidence", """SELECT CAST(SUM(review_count) AS BIGINT) AS review_count,
  round(SUM(COALESCE(average_prediction_score, 0) * review_count) / SUM(review_count), 9) AS weighted_score,
  COUNT(*) AS bucket_count FROM dws_confidence""")
def _weighted(spark, sf):
    return serving.weighted_score(tables.confidence(spark, sf)).withColumn("weighted_score", F.round("weighted_score", 9))


@query("first_last_trend", """SELECT arg_min(negative_rate, dt) AS first_rate, arg_max(negative_rate, dt) AS last_rate,
  COUNT(*) AS points, arg_max(negative_rate, dt) - arg_min(negative_rate, dt) AS delta FROM dws_daily""")
def _first_last(spark, sf):
    return serving.first_last(tables.daily(spark, sf))


@query("latest_valid_point", "SELECT month_id, negative_rate FROM dws_monthly WHERE negative_rate IS NOT NULL ORDER BY month_id DESC LIMIT 1")
def _latest_point(spark, sf):
    return serving.latest_point(tables.monthly(spark, sf), "month_id")


@query("trend_report", """SELECT arg_min(negative_rate, dt) AS first_rate, arg_max(negative_rate, dt) AS last_rate, COUNT(*) AS points,
  (arg_max(negative_rate, dt) - arg_min(negative_rate, dt)) * 100 AS delta_points
  FROM (SELECT * FROM dws_daily ORDER BY dt DESC LIMIT 365) t""")
def _trend_report(spark, sf):
    return reports.trend_report(tables.daily(spark, sf))


@query("rating_agreement", """SELECT CAST(SUM(review_count) AS BIGINT) AS review_count,
  CAST(SUM(CASE WHEN pred_label = 'negative' THEN review_count END) AS BIGINT) AS negative_count,
  MAX(CASE WHEN pred_label = 'negative' THEN rate_within_rating END) AS agreement FROM dws_matrix WHERE rating_value = 1""")
def _agreement(spark, sf):
    return reports.rating_agreement(tables.matrix(spark, sf))


@query("health_index", f"""SELECT round(base, 9) AS base, round(alert_penalty, 9) AS alert_penalty, round(store_penalty, 9) AS store_penalty,
  round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, base - alert_penalty - store_penalty)), 9) AS health_index FROM (
  SELECT (1 - (SELECT negative_rate FROM dws_overview)) * 100 AS base,
    least(15.0::DOUBLE, 1.1::DOUBLE * (SELECT COUNT(*) FROM (SELECT * FROM dws_alerts {_ALERT_ORDER} LIMIT 12) a WHERE alert_level IN ('HIGH', 'CRITICAL'))) AS alert_penalty,
    least(12.0::DOUBLE, 25 * (SELECT AVG(negative_rate) FROM (SELECT * FROM dws_store WHERE review_count >= 20 {_NEG}, store_key LIMIT 3) s)) AS store_penalty) p""")
def _health(spark, sf):
    index = reports.health_index(tables.overview(spark, sf), tables.alert_table(spark, sf), tables.stores(spark, sf))
    return index.select([F.round(c, 9).alias(c) for c in index.columns])


def _metric_sql(source, names):
    return " UNION ALL ".join(
        f"SELECT 'metric' AS section, {i} AS position, '{n}' AS id, '{n}' AS name, CAST({n} AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS count FROM {source}"
        for i, n in enumerate(names, 1))


def _section_sql(section, source, order, key, name, value, count, first):
    return (f"SELECT '{section}' AS section, ROW_NUMBER() OVER ({order}) AS position, {key} AS id, {name} AS name, "
            f"CAST({value} AS DOUBLE) AS value, CAST({count} AS BIGINT) AS count FROM (SELECT * FROM {source} {order} LIMIT {first}) x")


_ASPECT_ORDER = "ORDER BY mention_count DESC, negative_rate DESC, aspect_code"
_REASON_ORDER = "ORDER BY mention_count DESC, share_of_negative_reviews DESC, reason_code"
common_table("top_product", f"SELECT * FROM dws_product WHERE review_count >= 5 {_NEG}, {_GRAIN} LIMIT 1")
common_table("top_store", f"SELECT * FROM dws_store WHERE review_count >= 20 {_NEG}, store_key LIMIT 1")


def _product_ranking():
    return _section_sql("ranking", "(SELECT *, COALESCE(product_title, parent_asin) AS shown FROM dws_product WHERE review_count >= 5) p",
                        f"{_NEG}, {_GRAIN}", "parent_asin", "shown", "negative_rate", "review_count", 3)


def _alert_sql(source, first):
    return _section_sql("alert", source, _ALERT_ORDER, "alert_id", "entity_name", "metric_value", "review_count", first)


def _aspect_sql(first):
    return _section_sql("aspect", "dws_aspects", _ASPECT_ORDER, "aspect_code", "aspect_name", "negative_rate", "mention_count", first)


def _reason_sql(first, section="reason"):
    return _section_sql(section, "dws_reasons", _REASON_ORDER, "reason_code", "reason_name", "share_of_negative_reviews", "mention_count", first)


_SAMPLE_SQL = _section_sql("sample", "(SELECT * FROM dws_samples WHERE pred_label = 'negative') s",
                           "ORDER BY sample_rank, pred_score DESC, sample_id", "sample_id", "review_text_preview", "pred_score", "text_length", 3)


def _joined(*parts):
    return " UNION ALL ".join(f"({p})" for p in parts)


@query("product_risk_report", _joined(
    _metric_sql("top_product", ["negative_rate", "negative_count", "review_count", "average_prediction_score"]),
    _product_ranking(), _alert_sql("(SELECT * FROM dws_alerts WHERE entity_id IN (SELECT parent_asin FROM top_product)) a", 20),
    _aspect_sql(5), _reason_sql(5), _SAMPLE_SQL))
def _product_risk(spark, sf):
    return reports.product_risk(tables.products(spark, sf), tables.alert_table(spark, sf), tables.aspects(spark, sf),
                                tables.reasons(spark, sf), tables.samples(spark, sf))


@query("store_risk_report", _joined(
    _metric_sql("top_store", ["negative_rate", "review_count", "product_count", "average_rating"]),
    _section_sql("ranking", "(SELECT * FROM dws_store WHERE review_count >= 20) s", f"{_NEG}, store_key", "store_key", "store_name", "negative_rate", "review_count", 3),
    _alert_sql("(SELECT * FROM dws_alerts WHERE entity_id IN (SELECT store_key FROM top_store)) a", 20)))
def _store_risk(spark, sf):
    return reports.store_risk(tables.stores(spark, sf), tables.alert_table(spark, sf))


@query("reason_report", _joined(_reason_sql(1, "metric"), _reason_sql(3, "ranking"), _reason_sql(8), _aspect_sql(8), _SAMPLE_SQL))
def _reason_report(spark, sf):
    return reports.reason_report(tables.reasons(spark, sf), tables.aspects(spark, sf), tables.samples(spark, sf))


@query("confidence_report", "SELECT section, position, id, name, round(value, 9) AS value, count FROM (" + _joined(
    _metric_sql("""(SELECT SUM(review_count) AS review_count, SUM(COALESCE(average_prediction_score, 0) * review_count) / SUM(review_count) AS weighted_score,
      COUNT(*) AS bucket_count FROM dws_confidence) w""", ["review_count", "weighted_score", "bucket_count"]),
    _section_sql("ranking", "dws_confidence", "ORDER BY bucket_order", "bucket_code", "bucket_code", "average_prediction_score", "review_count", 3)) + ") r")
def _confidence_report(spark, sf):
    return reports.confidence_report(tables.confidence(spark, sf)).withColumn("value", F.round("value", 9))


@query("batch_summary", _joined(
    _metric_sql("dws_overview", ["review_count", "positive_rate", "neutral_rate", "negative_rate"]),
    _product_ranking(), _alert_sql("dws_alerts", 5), _aspect_sql(5), _reason_sql(5), _SAMPLE_SQL))
def _batch_summary(spark, sf):
    return reports.batch_summary(tables.overview(spark, sf), tables.products(spark, sf), tables.alert_table(spark, sf),
                                 tables.aspects(spark, sf), tables.reasons(spark, sf), tables.samples(spark, sf))


@query("overview_vs_predictions", f"""SELECT '{BATCH}' AS load_batch_id, '{MODEL}' AS model_version, review_count AS overview_count,
  (SELECT COUNT(*) FROM predictions WHERE model_version = '{MODEL}') AS prediction_count FROM dws_overview""")
def _overview_vs(spark, sf):
    stamped = tables.overview(spark, sf).withColumns({"load_batch_id": F.lit(BATCH), "model_version": F.lit(MODEL)})
    return reports.reconcile_overview(stamped, predictions(spark, sf))
