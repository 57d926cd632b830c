"""Warehouse-shaped views over the test tables, for Spark and for DuckDB.

Scores are multiples of 1/16 and ratings are whole, so sums of doubles are
exact in any order and both engines return the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook.registry import common_table, load
from reviewmill.functions.once import computed_once
from reviewmill.functions.text import clean_text, sanitize

BATCH = "b1"
MODEL = "m1"

# --------------------------------------------------------------------------
# review_view: the joined review/prediction view at full scale, without text
# --------------------------------------------------------------------------
_KEY_SPARK = (
    "sha2(concat('U', l_orderkey, '|#|', 'A', l_partkey, '-', l_linenumber, '|#|', "
    "unix_millis(cast(l_shipdate as timestamp))), 256)"
)
_KEY_DUCK = (
    "sha256(concat('U', l_orderkey, '|#|', 'A', l_partkey, '-', l_linenumber, '|#|', epoch_ms(l_shipdate)))"
)
_SCORE = "0.375D + cast(round(l_discount * 100) as int) / 16.0D"
_SCORE_DUCK = "0.375::DOUBLE + cast(round(l_discount * 100) AS INTEGER) / 16.0::DOUBLE"


def review_view(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """``keyed`` is for queries that filter or join on the key, which is then hashed once."""
    lines = load(spark, sf_dir, "lineitem")
    products = load(spark, sf_dir, "part").filter("p_size <= 45")
    joined = lines.join(products, lines.l_partkey == products.p_partkey, "left")
    if keyed:
        # After the join, which would have to move the hash.
        joined = computed_once(joined, "_key", F.expr(_KEY_SPARK))
    return joined.selectExpr(
        f"{'_key' if keyed else _KEY_SPARK} AS review_key",
        "concat('A', l_partkey, '-', l_linenumber) AS asin",
        "CASE WHEN l_orderkey % 501 = 0 THEN NULL WHEN l_orderkey % 503 = 0 THEN ' ' ELSE concat('P', l_partkey) END AS parent_asin",
        "cast(floor((l_quantity - 1) / 10) + 1 as double) AS rating",
        "CASE WHEN l_quantity <= 20 THEN 'negative' WHEN l_quantity <= 30 THEN 'neutral' ELSE 'positive' END AS rating_label",
        "cast(l_shipdate as timestamp) AS review_time",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS dt",
        "l_linestatus = 'F' AS verified_purchase",
        "cast(l_linenumber as bigint) AS helpful_vote",
        "p_name AS product_title",
        "concat(p_brand, ' ', p_type) AS store_name",
        "p_type AS main_category",
        "CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END AS pred_label",
        f"{_SCORE} AS pred_score",
        f"'{MODEL}' AS model_version",
        "timestamp'2024-05-01 00:00:00' AS inferred_at",
        f"'{BATCH}' AS load_batch_id",
    )


common_table("review_view", f"""
  SELECT {_KEY_DUCK} AS review_key,
    concat('A', l_partkey, '-', l_linenumber) AS asin,
    CASE WHEN l_orderkey % 501 = 0 THEN NULL WHEN l_orderkey % 503 = 0 THEN ' ' ELSE concat('P', l_partkey) END AS parent_asin,
    CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE) AS rating,
    CASE WHEN l_quantity <= 20 THEN 'negative' WHEN l_quantity <= 30 THEN 'neutral' ELSE 'positive' END AS rating_label,
    l_shipdate AS review_time,
    strftime(l_shipdate, '%Y-%m-%d') AS dt,
    l_linestatus = 'F' AS verified_purchase,
    CAST(l_linenumber AS BIGINT) AS helpful_vote,
    p_name AS product_title,
    p_brand || ' ' || p_type AS store_name,
    p_type AS main_category,
    CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END AS pred_label,
    {_SCORE_DUCK} AS pred_score,
    '{MODEL}' AS model_version,
    TIMESTAMP '2024-05-01 00:00:00' AS inferred_at,
    '{BATCH}' AS load_batch_id
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size <= 45""")

# --------------------------------------------------------------------------
# text_view: the same shape over whole documents, with the cleaned text
# --------------------------------------------------------------------------


def text_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(
        F.expr("sha2(concat('D', doc_id), 256) AS review_key"),
        F.expr("concat('A', doc_id) AS asin"),
        F.expr("concat('P', doc_id % 200) AS parent_asin"),
        F.expr("cast(doc_id % 5 + 1 as double) AS rating"),
        F.expr("CASE WHEN doc_id % 5 < 2 THEN 'negative' WHEN doc_id % 5 = 2 THEN 'neutral' ELSE 'positive' END AS rating_label"),
        F.expr("timestamp_seconds(1500000000 + doc_id * 3600) AS review_time"),
        F.expr("concat('title ', doc_id % 200) AS product_title"),
        F.expr("source AS store_name"),
        F.expr("lang AS main_category"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS pred_label"),
        F.expr("0.375D + cast(doc_id % 11 as int) / 16.0D AS pred_score"),
        F.lit(MODEL).alias("model_version"),
        F.lit(BATCH).alias("load_batch_id"),
        clean_text("text").alias("review_text_clean"),
    )


_CLEAN_DUCK = r"regexp_replace(regexp_replace(trim({0}), '[\r\n\t]+', ' ', 'g'), '[\s\x0B]+', ' ', 'g')"

common_table("text_view", f"""
  SELECT sha256(concat('D', doc_id)) AS review_key, concat('A', doc_id) AS asin,
    concat('P', doc_id % 200) AS parent_asin, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating,
    CASE WHEN doc_id % 5 < 2 THEN 'negative' WHEN doc_id % 5 = 2 THEN 'neutral' ELSE 'positive' END AS rating_label,
    make_timestamp((1500000000 + doc_id * 3600) * 1000000) AS review_time,
    concat('title ', doc_id % 200) AS product_title, source AS store_name, lang AS main_category,
    CASE doc_id % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS pred_label,
    0.375::DOUBLE + CAST(doc_id % 11 AS INTEGER) / 16.0::DOUBLE AS pred_score,
    '{MODEL}' AS model_version, '{BATCH}' AS load_batch_id,
    {_CLEAN_DUCK.format('text')} AS review_text_clean
  FROM documents""")

# --------------------------------------------------------------------------
# raw_reviews / raw_metadata: the raw layer, with copies, blanks and gaps
# --------------------------------------------------------------------------


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.expr("doc_id % 97 = 0"), None).when(F.expr("doc_id % 89 = 0"), "   ").otherwise(sanitize("text"))
    return computed_once(load(spark, sf_dir, "documents"), "review_text", text).select(
        F.expr("CASE WHEN doc_id % 53 = 0 THEN 2.5D WHEN doc_id % 59 = 0 THEN NULL ELSE cast(doc_id % 5 + 1 as double) END AS rating"),
        F.expr("CASE WHEN doc_id % 31 = 0 THEN NULL ELSE concat('title ', lang) END AS title"),
        "review_text",
        F.lit("[]").alias("images_json"),
        F.expr("concat('A', n_chars % 20) AS asin"),
        F.expr("CASE WHEN n_chars % 41 = 0 THEN NULL ELSE concat('P', n_chars % 100) END AS parent_asin"),
        F.expr("concat('U', lang) AS user_id"),
        F.expr("1300000000123 + (n_chars % 3000) * 86400000 AS review_timestamp"),
        F.expr("doc_id % 7 AS helpful_vote"),
        F.expr("doc_id % 2 = 0 AS verified_purchase"),
        F.lit(BATCH).alias("load_batch_id"),
    )


common_table("raw_reviews", f"""
  SELECT CASE WHEN doc_id % 53 = 0 THEN 2.5 WHEN doc_id % 59 = 0 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating,
    CASE WHEN doc_id % 31 = 0 THEN NULL ELSE concat('title ', lang) END AS title,
    CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 89 = 0 THEN '   '
         ELSE translate(text, chr(1) || chr(13) || chr(10) || chr(9), '    ') END AS review_text,
    '[]' AS images_json,
    concat('A', n_chars % 20) AS asin,
    CASE WHEN n_chars % 41 = 0 THEN NULL ELSE concat('P', n_chars % 100) END AS parent_asin,
    concat('U', lang) AS user_id,
    1300000000123 + (n_chars % 3000) * 86400000 AS review_timestamp,
    doc_id % 7 AS helpful_vote,
    doc_id % 2 = 0 AS verified_purchase,
    '{BATCH}' AS load_batch_id
  FROM documents""")


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey AS line_no",
        "p_type AS main_category",
        "p_name AS product_title",
        "cast(p_size % 5 as double) + 0.5D AS average_rating",
        "cast(p_size as bigint) AS rating_number",
        "'[]' AS features_json", "'[]' AS description_json",
        "concat('$', p_size) AS price_raw",
        "'[]' AS images_json", "'[]' AS videos_json",
        "CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS store_name",
        "'[]' AS categories_json", "'{}' AS details_json",
        "concat('P', p_partkey % 80) AS parent_asin",
        "cast(NULL as string) AS bought_together_json",
        f"'{BATCH}' AS load_batch_id",
    )


common_table("raw_metadata", f"""
  SELECT p_partkey AS line_no, p_type AS main_category, p_name AS product_title,
    CAST(p_size % 5 AS DOUBLE) + 0.5 AS average_rating, CAST(p_size AS BIGINT) AS rating_number,
    '[]' AS features_json, '[]' AS description_json, concat('$', p_size) AS price_raw,
    '[]' AS images_json, '[]' AS videos_json,
    CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS store_name,
    '[]' AS categories_json, '{{}}' AS details_json,
    concat('P', p_partkey % 80) AS parent_asin, CAST(NULL AS VARCHAR) AS bought_together_json,
    '{BATCH}' AS load_batch_id
  FROM part""")

# --------------------------------------------------------------------------
# predictions: returned predictions of review_view, with every kind of fault
# --------------------------------------------------------------------------


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = load(spark, sf_dir, "lineitem").selectExpr(
        f"{_KEY_SPARK} AS k", "l_orderkey % 20 AS g", "l_linenumber AS n", f"{_SCORE} AS s",
        "CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END AS label",
    ).filter("g <> 0")
    copies = base.withColumn("copy", F.expr("explode(sequence(1, IF(g = 3, 2, 1)))"))
    columns = (
        "CASE WHEN g = 4 THEN sha2(concat('x', k), 256) WHEN g = 8 AND n = 3 THEN '  ' ELSE k END AS review_key",
        "CASE WHEN g = 2 AND n = 1 THEN 'unknown' WHEN g = 9 AND n = 1 THEN NULL ELSE label END AS pred_label",
        "CASE WHEN g = 1 AND n = 1 THEN 1.1D ELSE s END AS pred_score",
        "CASE WHEN g % 2 = 0 THEN NULL WHEN label = 'negative' THEN s ELSE (1.0D - s) / 2 END AS negative_score",
        "CASE WHEN g % 2 = 0 THEN NULL WHEN n = 7 THEN 1.25D WHEN label = 'neutral' THEN s ELSE (1.0D - s) / 2 END AS neutral_score",
        "CASE WHEN g % 2 = 0 THEN NULL WHEN label = 'positive' THEN s ELSE (1.0D - s) / 2 END AS positive_score",
        f"CASE WHEN g = 6 AND n = 2 THEN ' ' WHEN g = 7 AND n = 2 THEN 'm0' WHEN g = 10 AND n = 2 THEN 'm/1' ELSE '{MODEL}' END AS model_version",
        "CASE WHEN g = 5 AND n = 2 THEN NULL ELSE timestamp'2024-05-01 00:00:00' END AS inferred_at",
        f"'{BATCH}' AS load_batch_id",
    )
    # Generated rows: filters on these columns stay above the generator instead
    # of repeating the expressions below it.
    return copies.select(F.inline(F.array(F.struct(*[F.expr(c) for c in columns]))))


common_table("predictions", f"""
  SELECT CASE WHEN g = 4 THEN sha256('x' || k) WHEN g = 8 AND n = 3 THEN '  ' ELSE k END AS review_key,
    CASE WHEN g = 2 AND n = 1 THEN 'unknown' WHEN g = 9 AND n = 1 THEN NULL ELSE label END AS pred_label,
    CASE WHEN g = 1 AND n = 1 THEN 1.1 ELSE s END AS pred_score,
    CASE WHEN g % 2 = 0 THEN NULL WHEN label = 'negative' THEN s ELSE (1.0::DOUBLE - s) / 2 END AS negative_score,
    CASE WHEN g % 2 = 0 THEN NULL WHEN n = 7 THEN 1.25 WHEN label = 'neutral' THEN s ELSE (1.0::DOUBLE - s) / 2 END AS neutral_score,
    CASE WHEN g % 2 = 0 THEN NULL WHEN label = 'positive' THEN s ELSE (1.0::DOUBLE - s) / 2 END AS positive_score,
    CASE WHEN g = 6 AND n = 2 THEN ' ' WHEN g = 7 AND n = 2 THEN 'm0' WHEN g = 10 AND n = 2 THEN 'm/1' ELSE '{MODEL}' END AS model_version,
    CASE WHEN g = 5 AND n = 2 THEN NULL ELSE TIMESTAMP '2024-05-01 00:00:00' END AS inferred_at,
    '{BATCH}' AS load_batch_id
  FROM (SELECT {_KEY_DUCK} AS k, l_orderkey % 20 AS g, l_linenumber AS n, {_SCORE_DUCK} AS s,
          CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END AS label
        FROM lineitem WHERE l_orderkey % 20 <> 0) base,
       LATERAL (SELECT unnest(range(0, CASE WHEN g = 3 THEN 2 ELSE 1 END)) AS copy) copies""")
