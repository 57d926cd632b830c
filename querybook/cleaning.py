"""Expressions, filters, joins and deduplication of the cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.fixtures import _CLEAN_DUCK, BATCH, MODEL, predictions, raw_metadata, raw_reviews, review_view
from querybook.registry import common_table, load, query
from reviewmill.functions import labels, numbers, text, times
from reviewmill.functions.serving_values import normalise
from reviewmill.operators import clean, joins
from reviewmill.operators import predictions as pred
from reviewmill.operators.checks import bad_raw_values
from reviewmill.session import scratch_path
from reviewmill.sources import delimited, tables

_RAW_KEY = ("sha256(concat(COALESCE(user_id, ''), '|#|', COALESCE(asin, ''), '|#|', COALESCE(parent_asin, ''), '|#|', "
            "COALESCE(CAST(review_timestamp AS VARCHAR), ''), '|#|', COALESCE(title, ''), '|#|', COALESCE(review_text, '')))")
_HAS_TEXT = "review_text IS NOT NULL AND trim(review_text) <> ''"
_LABEL = "CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3 THEN 'neutral' WHEN rating >= 4 THEN 'positive' ELSE 'unknown' END"
_TIME = "make_timestamp((review_timestamp // 1000) * 1000000)"
_FORMAT = "'%Y-%m-%d %H:%M:%S'"
_FIRST_COPY = """ROW_NUMBER() OVER (PARTITION BY review_key ORDER BY review_timestamp NULLS FIRST, asin NULLS FIRST,
  parent_asin NULLS FIRST, rating NULLS FIRST, helpful_vote DESC NULLS LAST, verified_purchase NULLS FIRST,
  images_json NULLS FIRST, user_id NULLS FIRST, title NULLS FIRST)"""

common_table("keyed_reviews", f"SELECT *, {_RAW_KEY} AS review_key FROM raw_reviews WHERE {_HAS_TEXT}")
common_table("first_meta", """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY parent_asin ORDER BY line_no) AS place
  FROM raw_metadata) m WHERE place = 1""")
common_table("unique_reviews", f"SELECT * FROM (SELECT *, {_FIRST_COPY} AS place FROM keyed_reviews) k WHERE place = 1")
common_table("clean_table", f"""
  SELECT r.review_key, r.asin, r.parent_asin, r.user_id, r.rating, r.title, r.review_text,
    {_CLEAN_DUCK.format('r.review_text')} AS review_text_clean, r.review_timestamp,
    strftime({_TIME}, {_FORMAT}) AS review_time, strftime({_TIME}, '%Y-%m-%d') AS dt, r.helpful_vote, r.verified_purchase,
    m.product_title, m.store_name, m.main_category, {_LABEL} AS rating_label, 'rating_weak_label' AS label_source,
    length({_CLEAN_DUCK.format('r.review_text')}) AS text_length, m.parent_asin IS NOT NULL AS metadata_matched,
    r.load_batch_id, strftime({_TIME}, '%Y') AS review_year
  FROM unique_reviews r LEFT JOIN first_meta m ON r.parent_asin = m.parent_asin""")


def clean_table(spark, sf):
    return clean.clean_reviews(raw_reviews(spark, sf), raw_metadata(spark, sf), BATCH, metadata_order=[F.asc("line_no")])


@query("clean_reviews", "SELECT * FROM clean_table")
def _clean(spark, sf):
    return normalise(clean_table(spark, sf))


@query("clean_reviews_salted", "SELECT * FROM clean_table")
def _clean_salted(spark, sf):
    reviews = raw_reviews(spark, sf)
    hot = joins.hot_keys(reviews, "parent_asin", rows_per_split=5)
    return normalise(clean.clean_reviews(reviews, raw_metadata(spark, sf), BATCH, hot, [F.asc("line_no")]))


# ---- scalar expressions ------------------------------------------------------


@query("sanitize_string", "SELECT doc_id, translate(text, chr(1) || chr(13) || chr(10) || chr(9), '    ') AS sanitized FROM documents")
def _sanitize(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.sanitize("text").alias("sanitized"))


@query("review_text_clean", f"SELECT doc_id, {_CLEAN_DUCK.format('text')} AS cleaned FROM documents")
def _text_clean(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.clean_text("text").alias("cleaned"))


@query("text_length", f"SELECT doc_id, length({_CLEAN_DUCK.format('text')}) AS characters FROM documents")
def _text_length(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.text_length(text.clean_text("text")).alias("characters"))


@query("preview", f"SELECT doc_id, substring(sha256(text), 1, 12) AS key_prefix, substring({_CLEAN_DUCK.format('text')}, 1, 80) AS shown FROM documents")
def _preview(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", text.preview(F.sha2("text", 256), 12).alias("key_prefix"), text.preview(text.clean_text("text"), 80).alias("shown"))


@query("review_key", f"SELECT {_RAW_KEY} AS review_key, helpful_vote FROM raw_reviews")
def _review_key(spark, sf):
    return raw_reviews(spark, sf).select(text.review_key().alias("review_key"), "helpful_vote")


@query("review_time", f"SELECT helpful_vote, review_timestamp, strftime({_TIME}, {_FORMAT}) AS review_time FROM raw_reviews")
def _review_time(spark, sf):
    return normalise(raw_reviews(spark, sf).select(
        "helpful_vote", "review_timestamp", times.epoch_ms_to_time("review_timestamp").alias("review_time")))


@query("review_dt_year", f"SELECT strftime({_TIME}, '%Y-%m-%d') AS dt, strftime({_TIME}, '%Y') AS review_year, COUNT(*) AS row_count FROM raw_reviews GROUP BY ALL")
def _dt_year(spark, sf):
    at = times.epoch_ms_to_time("review_timestamp")
    rows = raw_reviews(spark, sf).select(times.date_text(at).alias("dt"), times.year_text(at).alias("review_year"))
    return rows.groupBy("dt", "review_year").agg(F.count(F.lit(1)).alias("row_count"))


@query("rating_label", f"SELECT rating, {_LABEL} AS rating_label, COUNT(*) AS row_count FROM raw_reviews GROUP BY ALL")
def _rating_label(spark, sf):
    rows = raw_reviews(spark, sf).select("rating", labels.weak_label("rating").alias("rating_label"))
    return rows.groupBy("rating", "rating_label").agg(F.count(F.lit(1)).alias("row_count"))


@query("rating_label_bounded", """SELECT rating, CASE WHEN rating < 1 OR rating > 5 THEN NULL WHEN rating <= 2 THEN 'negative'
  WHEN rating = 3 THEN 'neutral' WHEN rating >= 4 THEN 'positive' END AS label, COUNT(*) AS row_count
  FROM (SELECT (l_quantity - 3) / 4 AS rating FROM lineitem) r GROUP BY ALL""")
def _label_bounded(spark, sf):
    rows = load(spark, sf, "lineitem").select(((F.col("l_quantity") - 3) / 4).alias("rating"))
    labelled = rows.withColumn("label", labels.weak_label_in_range("rating"))
    return labelled.groupBy("rating", "label").agg(F.count(F.lit(1)).alias("row_count"))


@query("metadata_matched", "SELECT metadata_matched, COUNT(*) AS row_count FROM clean_table GROUP BY 1")
def _matched(spark, sf):
    return clean_table(spark, sf).groupBy("metadata_matched").agg(F.count(F.lit(1)).alias("row_count"))


@query("safe_rate", """SELECT l_orderkey, CASE WHEN COUNT(*) FILTER (l_linenumber > 3) = 0 THEN 0.0::DOUBLE
  ELSE CAST(COUNT(*) FILTER (l_linenumber > 5) AS DOUBLE) / COUNT(*) FILTER (l_linenumber > 3) END AS rate FROM lineitem GROUP BY l_orderkey""")
def _safe_rate(spark, sf):
    counted = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.when(F.col("l_linenumber") > 5, 1)).alias("a"), F.count(F.when(F.col("l_linenumber") > 3, 1)).alias("b"))
    return counted.select("l_orderkey", numbers.safe_rate("a", "b").alias("rate"))


common_table("model_names", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '.' WHEN 1 THEN '_Fit.' WHEN 2 THEN 'Model--' ELSE 'TFIDF_' END
  || o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN '..' WHEN o_orderkey % 5 = 1 THEN 'x' ELSE '' END AS raw FROM orders""")


@query("model_partition", """SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') THEN
  substring(CASE WHEN trim(regexp_replace(lower(raw), '[^a-z0-9_-]+', '_', 'g'), '_') = '' THEN 'model'
    ELSE trim(regexp_replace(lower(raw), '[^a-z0-9_-]+', '_', 'g'), '_') END, 1, 80) || '_' || substring(sha256(raw), 1, 12) END AS partition_name
  FROM model_names""")
def _model_partition(spark, sf):
    names = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat(CASE o_orderkey % 4 WHEN 0 THEN '.' WHEN 1 THEN '_Fit.' WHEN 2 THEN 'Model--' ELSE 'TFIDF_' END, "
        "o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN '..' WHEN o_orderkey % 5 = 1 THEN 'x' ELSE '' END) AS raw")
    return names.select("o_orderkey", text.model_partition("raw").alias("partition_name"))


_NUMBERS = """CASE o_orderkey % 10 WHEN 0 THEN concat('', o_custkey) WHEN 1 THEN concat('$', o_custkey, ',000') WHEN 2 THEN concat('  ', o_custkey, '.5 ')
  WHEN 3 THEN 'NaN' WHEN 4 THEN 'abc' WHEN 5 THEN ' ' WHEN 6 THEN concat('-', o_custkey, 'e2') WHEN 7 THEN NULL WHEN 8 THEN 'Infinity' ELSE concat(o_custkey, '.0') END"""
common_table("number_texts", f"SELECT o_orderkey, {_NUMBERS} AS raw FROM orders")
_FINITE = "CASE WHEN isfinite({0}) THEN {0} END"


def _number_texts(spark, sf):
    return load(spark, sf, "orders").selectExpr("o_orderkey", f"{_NUMBERS} AS raw")


@query("parse_number", f"SELECT o_orderkey, {_FINITE.format('n')} AS n FROM (SELECT o_orderkey, TRY_CAST(regexp_replace(trim(raw), '[,$]', '', 'g') AS DOUBLE) AS n FROM number_texts) p")
def _parse_number(spark, sf):
    return _number_texts(spark, sf).select("o_orderkey", numbers.parse_number("raw").alias("n"))


@query("number_value", f"SELECT o_orderkey, {_FINITE.format('n')} AS n FROM (SELECT o_orderkey, TRY_CAST(trim(raw) AS DOUBLE) AS n FROM number_texts) p")
def _number_value(spark, sf):
    return _number_texts(spark, sf).select("o_orderkey", numbers.text_to_number("raw").alias("n"))


@query("integer_value", "SELECT o_orderkey, CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN CAST(trim(raw) AS BIGINT) END AS n FROM number_texts")
def _integer_value(spark, sf):
    return _number_texts(spark, sf).select("o_orderkey", numbers.text_to_integer("raw").alias("n"))


@query("canonical_number", """SELECT o_orderkey, CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)
  ELSE CAST(o_totalprice AS VARCHAR) END AS price, CAST(CAST(o_custkey AS BIGINT) AS VARCHAR) AS customer FROM orders""")
def _canonical(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", numbers.canonical_number("o_totalprice").alias("price"),
        numbers.canonical_number(F.col("o_custkey").cast("double")).alias("customer"))


@query("missing_or_blank", "SELECT o_orderkey, raw IS NULL OR trim(raw) = '' AS missing FROM number_texts")
def _missing(spark, sf):
    return _number_texts(spark, sf).select("o_orderkey", text.missing_or_blank("raw").alias("missing"))


_TIMES = {
    0: ("concat('', unix_millis(t))", "CAST(epoch_ms(t) AS VARCHAR)"),
    1: ("concat('', unix_seconds(t))", "CAST(epoch_ms(t) // 1000 AS VARCHAR)"),
    2: ("concat(date_format(t, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z')", "strftime(t, '%Y-%m-%dT%H:%M:%SZ')"),
    3: ("date_format(t, 'yyyy-MM-dd HH:mm:ss')", "strftime(t, '%Y-%m-%d %H:%M:%S')"),
    4: ("concat(date_format(t, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00')", "strftime(t, '%Y-%m-%dT%H:%M:%S+02:00')"),
    5: ("'not a time'", "'not a time'"),
    6: ("concat(' ', date_format(t, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00 ')", "' ' || strftime(t, '%Y-%m-%dT%H:%M:%S+00:00 ')"),
    7: ("date_format(t, 'yyyy-MM-dd')", "strftime(t, '%Y-%m-%d')"),
}


def _time_texts(spark, sf):
    cases = " ".join(f"WHEN {k} THEN {s}" for k, (s, _) in _TIMES.items())
    rows = load(spark, sf, "orders").selectExpr("o_orderkey", "cast(o_orderdate as timestamp) AS t")
    return rows.selectExpr("o_orderkey", f"CASE o_orderkey % 9 {cases} END AS raw")


common_table("time_texts", "SELECT o_orderkey, CASE o_orderkey % 9 " + " ".join(f"WHEN {k} THEN {d}" for k, (_, d) in _TIMES.items())
             + " END AS raw, t FROM (SELECT o_orderkey, o_orderdate AS t FROM orders) o")


@query("parse_timestamp", f"""SELECT o_orderkey, raw, strftime(CASE WHEN o_orderkey % 9 IN (5, 8) THEN NULL WHEN o_orderkey % 9 = 4 THEN t - INTERVAL 2 HOUR
  WHEN o_orderkey % 9 = 7 THEN date_trunc('day', t) ELSE t END, {_FORMAT}) AS at_time FROM time_texts""")
def _parse_timestamp(spark, sf):
    return normalise(_time_texts(spark, sf).select("o_orderkey", "raw", times.parse_timestamp("raw").alias("at_time")))


@query("parse_utc_timestamp", f"SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 9 IN (2, 6) THEN t END, {_FORMAT}) AS at_time FROM time_texts")
def _parse_utc(spark, sf):
    return normalise(_time_texts(spark, sf).select("o_orderkey", times.parse_utc("raw").alias("at_time")))


@query("load_timestamps", f"SELECT dt, true AS stamped_now, '{BATCH}' AS load_batch_id, '{MODEL}' AS model_version FROM dws_daily")
def _load_timestamps(spark, sf):
    from reviewmill.operators.aggregates import sentiment_daily, stamp

    now = (F.col("generated_at") == F.current_timestamp()).alias("stamped_now")
    return stamp(sentiment_daily(review_view(spark, sf)), BATCH, MODEL).select("dt", now, "load_batch_id", "model_version")


# ---- filters -----------------------------------------------------------------


@query("nonblank_text", f"SELECT asin, helpful_vote, review_timestamp FROM raw_reviews WHERE {_HAS_TEXT}")
def _nonblank(spark, sf):
    return clean.with_text(raw_reviews(spark, sf)).select("asin", "helpful_vote", "review_timestamp")


@query("nlp_eligible", """SELECT review_key, rating_label FROM clean_table WHERE review_text_clean IS NOT NULL AND trim(review_text_clean) <> ''
  AND review_key IS NOT NULL AND trim(review_key) <> '' AND rating_label IN ('negative', 'neutral', 'positive')""")
def _eligible(spark, sf):
    return clean.eligible(clean_table(spark, sf)).select("review_key", "rating_label")


_VALID = f"""review_key IS NOT NULL AND trim(review_key) <> '' AND pred_label IN ('negative', 'neutral', 'positive')
  AND pred_score BETWEEN 0.0 AND 1.0 AND (negative_score IS NULL OR negative_score BETWEEN 0.0 AND 1.0)
  AND (neutral_score IS NULL OR neutral_score BETWEEN 0.0 AND 1.0) AND (positive_score IS NULL OR positive_score BETWEEN 0.0 AND 1.0)
  AND model_version = '{MODEL}' AND trim(model_version) <> '' AND inferred_at IS NOT NULL"""
common_table("valid_predictions", f"SELECT * FROM predictions WHERE {_VALID}")
common_table("imported", "SELECT p.* FROM valid_predictions p JOIN review_view d ON p.review_key = d.review_key AND p.load_batch_id = d.load_batch_id")


@query("valid_prediction", "SELECT review_key, pred_label, pred_score FROM valid_predictions")
def _valid(spark, sf):
    return pred.valid_predictions(predictions(spark, sf), MODEL).select("review_key", "pred_label", "pred_score")


@query("bad_values", """SELECT rating, helpful_vote, COUNT(*) AS row_count FROM raw_reviews
  WHERE rating IS NULL OR rating < 1 OR rating > 5 OR helpful_vote IS NULL OR helpful_vote < 0 OR verified_purchase IS NULL GROUP BY ALL""")
def _bad_values(spark, sf):
    bad = raw_reviews(spark, sf).filter(bad_raw_values())
    return bad.groupBy("rating", "helpful_vote").agg(F.count(F.lit(1)).alias("row_count"))


# ---- joins -------------------------------------------------------------------
_ENRICHED = ("review_key", "parent_asin", "product_title", "store_name", "main_category", "metadata_matched")


@query("reviews_left_meta", """SELECT k.review_key, k.parent_asin, k.helpful_vote, m.product_title, m.store_name, m.main_category,
  m.parent_asin IS NOT NULL AS metadata_matched FROM keyed_reviews k LEFT JOIN first_meta m ON k.parent_asin = m.parent_asin""")
def _left_meta(spark, sf):
    keyed = clean.with_text(raw_reviews(spark, sf)).withColumn("review_key", text.review_key())
    metadata = clean.unique_metadata(raw_metadata(spark, sf), [F.asc("line_no")])
    return clean.enrich(keyed, metadata).select(*_ENRICHED, "helpful_vote")


@query("import_inner_join", f"SELECT review_key, pred_label, pred_score, negative_score, neutral_score, positive_score, model_version, 'm1_' || substring(sha256('{MODEL}'), 1, 12) AS model_version_partition FROM imported")
def _import(spark, sf):
    return pred.import_predictions(predictions(spark, sf), review_view(spark, sf, keyed=True), MODEL).select(
        "review_key", "pred_label", "pred_score", "negative_score", "neutral_score", "positive_score", "model_version", "model_version_partition")


@query("sentiment_view", f"""SELECT d.review_key, d.asin, d.parent_asin, d.rating, d.rating_label, strftime(d.review_time, {_FORMAT}) AS review_time, d.dt,
  d.verified_purchase, d.helpful_vote, d.product_title, d.store_name, d.main_category, p.pred_label, p.pred_score, p.model_version,
  strftime(p.inferred_at, {_FORMAT}) AS inferred_at, d.load_batch_id
  FROM review_view d JOIN imported p ON d.review_key = p.review_key AND d.load_batch_id = p.load_batch_id""")
def _view(spark, sf):
    reviews = review_view(spark, sf, keyed=True)
    imported = pred.import_predictions(predictions(spark, sf), reviews, MODEL, packed=True)
    return normalise(pred.sentiment_view(reviews.drop("pred_label", "pred_score", "model_version", "inferred_at"), imported))


@query("unknown_keys", "SELECT p.review_key, p.pred_label FROM predictions p LEFT JOIN review_view d ON p.review_key = d.review_key WHERE d.review_key IS NULL")
def _unknown(spark, sf):
    return joins.unknown_keys(predictions(spark, sf), review_view(spark, sf, keyed=True)).select("review_key", "pred_label")


@query("missing_keys", "SELECT d.review_key FROM review_view d LEFT JOIN predictions p ON p.review_key = d.review_key WHERE p.review_key IS NULL")
def _missing_keys(spark, sf):
    return joins.missing_keys(review_view(spark, sf, keyed=True), predictions(spark, sf)).select("review_key")


@query("matched_keys", "SELECT COUNT(DISTINCT p.review_key) AS matched_key_count FROM predictions p JOIN review_view d ON p.review_key = d.review_key")
def _matched_keys(spark, sf):
    return joins.matched_keys(predictions(spark, sf), review_view(spark, sf, keyed=True)).agg(F.count(F.lit(1)).alias("matched_key_count"))


@query("coverage", """SELECT CAST(COUNT(p.review_key) AS DOUBLE) / COUNT(d.review_key) AS prediction_coverage
  FROM review_view d LEFT JOIN predictions p ON p.review_key = d.review_key""")
def _coverage(spark, sf):
    return joins.coverage(review_view(spark, sf, keyed=True), predictions(spark, sf))


_MATCH = "SELECT {0} FROM raw_reviews r LEFT JOIN raw_metadata m ON r.parent_asin = m.parent_asin"


def _match(spark, sf):
    return joins.metadata_match(raw_reviews(spark, sf), raw_metadata(spark, sf))


@query("meta_match_inner", _MATCH.format("COUNT(m.parent_asin) AS reviews_with_metadata"))
def _match_inner(spark, sf):
    return _match(spark, sf).select("reviews_with_metadata")


@query("meta_match_anti", _MATCH.format("COUNT(*) FILTER (m.parent_asin IS NULL) AS reviews_without_metadata"))
def _match_anti(spark, sf):
    return _match(spark, sf).select("reviews_without_metadata")


@query("meta_match_rate", _MATCH.format("CAST(COUNT(m.parent_asin) AS DOUBLE) / COUNT(*) AS metadata_match_rate"))
def _match_rate(spark, sf):
    return _match(spark, sf).select("metadata_match_rate")


@query("bounded_join_check", """SELECT COUNT(*) FILTER (trim(parent_asin) <> '') AS reviews_with_parent_asin,
  COUNT(*) FILTER (trim(parent_asin) IN (SELECT parent_asin FROM raw_metadata)) AS matched_parent_asin_rows,
  COUNT(*) FILTER (trim(parent_asin) <> '' AND trim(parent_asin) NOT IN (SELECT parent_asin FROM raw_metadata)) AS unmatched_parent_asin_rows,
  COUNT(*) FILTER (parent_asin IS NULL OR trim(parent_asin) = '') AS missing_or_blank_parent_asin_rows,
  CAST(COUNT(*) FILTER (trim(parent_asin) IN (SELECT parent_asin FROM raw_metadata)) AS DOUBLE) / COUNT(*) FILTER (trim(parent_asin) <> '') AS sample_parent_asin_join_rate
  FROM review_view""")
def _join_rate(spark, sf):
    return joins.join_rate(review_view(spark, sf), raw_metadata(spark, sf))


@query("metadata_for_keys", """SELECT m.parent_asin, m.line_no, m.product_title FROM first_meta m
  WHERE m.parent_asin IN (SELECT parent_asin FROM raw_reviews WHERE trim(parent_asin) <> '')""")
def _metadata_for(spark, sf):
    return joins.metadata_for(raw_reviews(spark, sf), raw_metadata(spark, sf), [F.asc("line_no")]).select("parent_asin", "line_no", "product_title")


@query("first_metadata", "SELECT parent_asin, line_no, product_title, store_name, main_category FROM first_meta")
def _first_metadata(spark, sf):
    return joins.first_per_key(raw_metadata(spark, sf), "parent_asin", [F.asc("line_no")]).select(
        "parent_asin", "line_no", "product_title", "store_name", "main_category")


_MISSING = "SELECT DISTINCT parent_asin FROM raw_reviews WHERE trim(parent_asin) <> '' AND parent_asin NOT IN (SELECT parent_asin FROM raw_metadata) ORDER BY 1"


@query("missing_parent_sink", _MISSING)
def _missing_parents(spark, sf):
    path = scratch_path(spark, "missing-parents")
    delimited.write_keys(joins.missing_parents(raw_reviews(spark, sf), raw_metadata(spark, sf)), path)
    return delimited.read_keys(spark, path, "parent_asin")


@query("set_difference", "SELECT DISTINCT parent_asin FROM review_view WHERE trim(parent_asin) <> '' EXCEPT SELECT parent_asin FROM raw_metadata")
def _set_difference(spark, sf):
    return joins.missing_parents(review_view(spark, sf), raw_metadata(spark, sf))


# ---- deduplication and order ---------------------------------------------------


@query("dedupe_by_key", "SELECT review_key, rating, helpful_vote, verified_purchase, user_id, title FROM unique_reviews")
def _dedupe(spark, sf):
    keyed = clean.with_text(raw_reviews(spark, sf)).withColumn("review_key", text.review_key())
    return clean.dedupe(keyed).select("review_key", "rating", "helpful_vote", "verified_purchase", "user_id", "title")


@query("expected_dedup_count", "SELECT COUNT(DISTINCT review_key) AS expected_unique FROM keyed_reviews")
def _expected_unique(spark, sf):
    keyed = clean.with_text(raw_reviews(spark, sf)).select(text.review_key().alias("review_key"))
    return keyed.agg(F.count_distinct("review_key").alias("expected_unique"))


@query("duplicate_prediction_flag", """SELECT review_key, model_version, at_row, at_row > MIN(at_row) OVER (PARTITION BY review_key, model_version) AS is_duplicate
  FROM (SELECT concat(l_orderkey, '-', l_linenumber) AS review_key, l_returnflag AS model_version,
    l_partkey * 1000000 + epoch_ms(l_shipdate) // 86400000 AS at_row FROM lineitem) p""")
def _duplicate_flag(spark, sf):
    rows = load(spark, sf, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS review_key", "l_returnflag AS model_version",
        "l_partkey * 1000000 + unix_date(cast(l_shipdate as date)) AS at_row")
    return pred.flag_duplicates(rows, [F.col("at_row")])


@query("export_ordering", "SELECT review_key, to_base64(encode(review_key)) AS export_key FROM clean_table ORDER BY export_key")
def _export_order(spark, sf):
    ordered = clean.in_key_order(clean_table(spark, sf).select("review_key"))
    return ordered.withColumn("export_key", text.base64_text("review_key"))


@query("spot_check", """SELECT substring(review_key, 1, 12) AS review_key_prefix, asin, parent_asin, rating, rating_label, dt, metadata_matched,
  product_title, store_name, substring(review_text_clean, 1, 80) AS review_text_preview FROM clean_table ORDER BY review_key LIMIT 10""")
def _spot_check(spark, sf):
    return clean.spot_check(clean_table(spark, sf))


@query("list_partitions", "SELECT DISTINCT load_batch_id, review_year FROM clean_table")
def _partitions(spark, sf):
    path = scratch_path(spark, "clean")
    tables.write_clean(clean_table(spark, sf), path)
    return normalise(tables.partitions(spark.read.parquet(path), "load_batch_id", "review_year"))


@query("uniform_sample", "SELECT doc_id, lang FROM documents ORDER BY sha256('42:' || doc_id), doc_id LIMIT 100")
def _uniform(spark, sf):
    from reviewmill.operators.ranking import uniform_sample

    return uniform_sample(load(spark, sf, "documents"), 100, "doc_id").select("doc_id", "lang")
