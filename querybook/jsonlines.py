"""JSON-lines input, conversion, profiles and prediction files."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.fixtures import BATCH, MODEL
from querybook.registry import common_table, load, query
from reviewmill.functions.once import computed_once
from reviewmill.functions.serving_values import normalise
from reviewmill.functions.variants import JsonField, open_fields
from reviewmill.operators import predictions as pred
from reviewmill.operators import profile
from reviewmill.schemas import REVIEW_JSON_FIELDS
from reviewmill.session import scratch_path
from reviewmill.sources import lines, prediction_files, records

# One JSON review per order, with every kind of value and fault. `k` is the order key.
_FIELDS = {
    "rating": """CASE k % 47 WHEN 3 THEN 'NaN' WHEN 5 THEN '-Infinity' WHEN 6 THEN '1e400' WHEN 8 THEN '2,"rating":4.5' ELSE CASE k % 8 WHEN 0 THEN '5' WHEN 1 THEN '5.0' WHEN 2 THEN '"4"' WHEN 3 THEN 'null' WHEN 4 THEN 'true'
        WHEN 5 THEN '3.5' WHEN 6 THEN '0' ELSE '"$1,234.50"' END END""",
    "title": """CASE WHEN k % 47 = 6 THEN '1e400' WHEN k % 47 = 8 THEN '7,"title":8.0' ELSE CASE k % 5 WHEN 0 THEN 'null' WHEN 1 THEN NULL WHEN 2 THEN concat('"a', chr(92), 'tb ', k, '"')
        WHEN 3 THEN '7.0' ELSE concat('"tïtle ', k, '"') END END""",
    "text": """CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '"  "' WHEN 3 THEN concat('["x', chr(92), 'ny"]')
        ELSE concat('"review text ', k, '"') END""",
    "images": """CASE WHEN k % 47 = 8 THEN '["a"],"images":["b"]' ELSE CASE k % 3 WHEN 0 THEN '[]' WHEN 1 THEN concat('[{"url":"u', chr(92), 'n', k, '","a":1.0}]') ELSE '"img"' END END""",
    "asin": "concat('\"A', k, '\"')",
    "parent_asin": "CASE k % 9 WHEN 0 THEN '\" \"' WHEN 1 THEN '12' ELSE concat('\"P', k % 300, '\"') END",
    "user_id": "CASE WHEN k % 11 = 0 THEN 'null' ELSE concat('\"U', c, '\"') END",
    "timestamp": """CASE k % 7 WHEN 0 THEN concat('', ms) WHEN 1 THEN concat('', ms div 1000) WHEN 2 THEN '"bad"' WHEN 3 THEN '"2020-02-03T04:05:06Z"'
        WHEN 4 THEN concat(ms, '.0') WHEN 5 THEN concat('"', ms, '"') ELSE 'true' END""",
    "helpful_vote": "CASE k % 4 WHEN 0 THEN concat('', k % 10) WHEN 1 THEN '-1' WHEN 2 THEN '\"3\"' ELSE '\"x\"' END",
    "verified_purchase": "CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '\"true\"' END",
}
_OBJECT = "k % 50 NOT IN (7, 11, 13, 17)"
common_table("json_rows", f"""SELECT * FROM (SELECT o_orderkey AS k, o_custkey AS c, epoch_ms(o_orderdate) AS ms,
  o_orderdate AS t FROM orders) o WHERE {_OBJECT}""")


def raw_lines(spark, sf):
    """Lines of a review file, in blocks of a thousand orders."""
    members = ", ".join(f"concat('\"{name}\":', {sql})" for name, sql in _FIELDS.items())
    base = load(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c", "unix_millis(cast(o_orderdate as timestamp)) AS ms")
    value = F.expr(
        f"""CASE k % 50 WHEN 7 THEN '   ' WHEN 11 THEN '{{bad json' WHEN 13 THEN '["x"]' WHEN 17 THEN '"text"'
            ELSE concat('{{', concat_ws(',', {members}), '}}') END""")
    return computed_once(base, "value", value).selectExpr("value", "'orders' AS file", "k div 1000 AS block", "k AS place")


def _as_files(table, name, order):
    """Path of a folder of text files that hold ``value`` in the order of a column."""
    path = scratch_path(table.sparkSession, name)
    table.repartitionByRange(order).sortWithinPartitions(order).select("value").write.option("maxRecordsPerFile", 4000).text(path)
    return path


def _review_files(spark, sf):
    return _as_files(raw_lines(spark, sf), "review-lines", "place")


def _key_in_line():
    """The order key in the asin of a line; null where the line is no review."""
    return F.nullif(F.regexp_extract("value", '"asin":"A([0-9]+)"', 1), F.lit("")).cast("bigint").alias("k")


def review_objects(spark, sf):
    return lines.objects(lines.classify(raw_lines(spark, sf)))


@query("jsonl_scan", f"""SELECT COUNT(*) AS physical_lines, COUNT(*) FILTER (k % 50 = 7) AS blank_lines,
  COUNT(*) FILTER (k % 50 = 11) AS malformed_json_count, COUNT(*) FILTER (k % 50 IN (13, 17)) AS non_object_json_count,
  COUNT(*) FILTER ({_OBJECT}) AS valid_object_count FROM (SELECT o_orderkey AS k FROM orders) o""")
def _scan(spark, sf):
    return lines.status_counts(lines.read_jsonl(spark, _review_files(spark, sf)))


@query("bounded_lines", f"""SELECT line_no, CASE WHEN {_OBJECT} THEN k END AS k FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS line_no, o_orderkey AS k FROM orders ORDER BY o_orderkey LIMIT 1200) o""")
def _bounded(spark, sf):
    return lines.first_lines(lines.stored_lines(lines.read_lines(spark, _review_files(spark, sf))), 1200).select("line_no", _key_in_line())


@query("first_n_valid", "SELECT ROW_NUMBER() OVER (ORDER BY k) AS line_no, k FROM json_rows ORDER BY k LIMIT 1200")
def _first_valid(spark, sf):
    return lines.first_valid(lines.classify(lines.stored_lines(lines.read_lines(spark, _review_files(spark, sf)))), 1200).select("line_no", _key_in_line())


@query("malformed_examples", """SELECT line_no, 'invalid_json' AS error FROM (SELECT o_orderkey AS k, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS line_no FROM orders) o
  WHERE k % 50 = 11 ORDER BY line_no LIMIT 5""")
def _malformed(spark, sf):
    return lines.malformed_examples(lines.classify(lines.number_lines(lines.read_lines(spark, _review_files(spark, sf)))))


_TEXT_SQL = "CASE k % 6 WHEN 3 THEN '[\"x y\"]' WHEN 2 THEN '  ' WHEN 4 THEN 'review text ' || k WHEN 5 THEN 'review text ' || k END"
# Numbers that are not finite count as missing, a repeated field has its last value.
_ODD_RATING_SQL = "CASE WHEN k % 47 IN (3, 5, 6) THEN NULL WHEN k % 47 = 8 THEN 4.5::DOUBLE ELSE {0} END"
_TITLE_SQL = "CASE WHEN k % 47 = 6 THEN 'inf' WHEN k % 47 = 8 THEN '8.0' ELSE CASE k % 5 WHEN 2 THEN 'a b ' || k WHEN 3 THEN '7.0' WHEN 4 THEN 'tïtle ' || k END END"
_IMAGES_SQL = """CASE WHEN k % 47 = 8 THEN '["b"]' ELSE CASE k % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[{"url":"u ' || k || '","a":1.0}]' ELSE '"img"' END END"""
_RATING_SQL = _ODD_RATING_SQL.format("CASE k % 8 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 5.0 WHEN 2 THEN 4.0 WHEN 5 THEN 3.5 WHEN 6 THEN 0.0 END")
_TIME_SQL = "CASE k % 7 WHEN 0 THEN ms WHEN 1 THEN ms // 1000 WHEN 4 THEN ms WHEN 5 THEN ms END"
_PARENT_SQL = "CASE k % 9 WHEN 0 THEN ' ' WHEN 1 THEN '12' ELSE 'P' || (k % 300) END"
_VOTE_SQL = "CASE k % 4 WHEN 0 THEN k % 10 WHEN 1 THEN -1 WHEN 2 THEN 3 END"


@query("convert_review", f"""SELECT {_RATING_SQL} AS rating, {_TITLE_SQL} AS title, {_TEXT_SQL} AS review_text, {_IMAGES_SQL} AS images_json,
  'A' || k AS asin, {_PARENT_SQL} AS parent_asin, CASE WHEN k % 11 <> 0 THEN 'U' || c END AS user_id, {_TIME_SQL} AS review_timestamp,
  {_VOTE_SQL} AS helpful_vote, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS verified_purchase FROM json_rows""")
def _convert_review(spark, sf):
    return records.to_reviews(review_objects(spark, sf))


_KINDS_SQL = {
    "rating": "CASE WHEN k % 47 IN (3, 5, 6, 8) THEN 'number' ELSE CASE k % 8 WHEN 0 THEN 'integer' WHEN 1 THEN 'number' WHEN 2 THEN 'string' WHEN 3 THEN 'null' WHEN 4 THEN 'boolean' WHEN 5 THEN 'number' WHEN 6 THEN 'integer' ELSE 'string' END END",
    "title": "CASE WHEN k % 47 IN (6, 8) THEN 'number' ELSE CASE k % 5 WHEN 0 THEN 'null' WHEN 1 THEN NULL WHEN 3 THEN 'number' ELSE 'string' END END",
    "text": "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 3 THEN 'array' ELSE 'string' END",
    "images": "CASE WHEN k % 3 = 2 AND k % 47 <> 8 THEN 'string' ELSE 'array' END",
    "asin": "'string'",
    "parent_asin": "CASE k % 9 WHEN 1 THEN 'integer' ELSE 'string' END",
    "user_id": "CASE WHEN k % 11 = 0 THEN 'null' ELSE 'string' END",
    "timestamp": "CASE k % 7 WHEN 0 THEN 'integer' WHEN 1 THEN 'integer' WHEN 4 THEN 'number' WHEN 6 THEN 'boolean' ELSE 'string' END",
    "helpful_vote": "CASE WHEN k % 4 < 2 THEN 'integer' ELSE 'string' END",
    "verified_purchase": "CASE k % 3 WHEN 2 THEN 'string' ELSE 'boolean' END",
}
_BLANK_SQL = {"text": "k % 6 = 2", "parent_asin": "k % 9 = 0"}
common_table("field_kinds", " UNION ALL ".join(
    f"SELECT '{name}' AS field, {kind} AS kind, {_BLANK_SQL.get(name, 'false')} AS blank FROM json_rows" for name, kind in _KINDS_SQL.items()))


@query("value_type", "SELECT field, kind, COUNT(*) AS row_count FROM field_kinds WHERE kind IS NOT NULL GROUP BY ALL")
def _value_type(spark, sf):
    return profile.field_shapes(review_objects(spark, sf)).groupBy("field", "kind").agg(F.sum("row_count").alias("row_count"))


_PROFILE_SQL = ("SELECT field, COUNT(kind) AS occurrences, COUNT(*) FILTER (kind = 'null') AS nulls, COUNT(*) FILTER (blank) AS blank_strings, "
                + ", ".join(f"COUNT(*) FILTER (kind = '{k}') AS {k}_count" for k in profile.KINDS) + " FROM field_kinds GROUP BY field")
common_table("field_profiles", _PROFILE_SQL)


@query("field_profile", "SELECT * FROM field_profiles")
def _field_profile(spark, sf):
    return profile.field_profile(review_objects(spark, sf))


_TYPE_SQL = """CASE WHEN n_kinds = 1 AND integer_count > 0 THEN 'BIGINT' WHEN n_kinds > 0 AND n_kinds = (integer_count > 0)::INT + (number_count > 0)::INT THEN 'DOUBLE'
  WHEN n_kinds = 1 AND boolean_count > 0 THEN 'BOOLEAN' WHEN n_kinds = 1 AND array_count > 0 THEN 'ARRAY<STRING>' ELSE 'STRING' END"""
common_table("typed_fields", f"""SELECT *, {_TYPE_SQL} AS proposed_type FROM (SELECT *, (boolean_count > 0)::INT + (integer_count > 0)::INT + (number_count > 0)::INT
  + (string_count > 0)::INT + (array_count > 0)::INT + (object_count > 0)::INT AS n_kinds FROM field_profiles) p""")


@query("hive_type_proposal", "SELECT field, proposed_type FROM typed_fields")
def _type_proposal(spark, sf):
    kinds = profile.field_shapes(review_objects(spark, sf)).groupBy("field").agg(F.collect_set("kind").alias("kinds"))
    return kinds.select("field", profile.proposed_type(F.col("kinds")).alias("proposed_type"))


# The dictionary is asked for one field too few and two too many.
_EXPECTED = tuple(f for f in REVIEW_JSON_FIELDS if f != "user_id") + ("price", "store")


_MEANINGS_SQL = ", ".join(f"('{k}', '{v}')" for k, v in profile.FIELD_MEANINGS.items())


@query("data_dictionary", f"""SELECT 'review' AS dataset, COALESCE(t.field, e.field) AS field, COALESCE(occurrences, 0) AS presence,
  COALESCE(concat_ws(',', {", ".join(f"CASE WHEN {k}_count > 0 THEN '{k}' END" for k in sorted(profile.KINDS))}), '') AS kinds,
  COALESCE(occurrences, 0) < (SELECT COUNT(*) FROM json_rows) OR COALESCE(nulls, 0) > 0 AS nullable,
  COALESCE(m.meaning, 'Meaning requires team confirmation') AS meaning, COALESCE(proposed_type, 'STRING') AS proposed_type,
  CASE WHEN t.field IS NULL THEN 'missing' WHEN e.field IS NULL THEN 'unexpected'
    WHEN occurrences < (SELECT COUNT(*) FROM json_rows) THEN 'optional' ELSE 'observed' END AS status
  FROM typed_fields t FULL JOIN (SELECT unnest([{", ".join(f"'{f}'" for f in _EXPECTED)}]) AS field) e ON t.field = e.field
  LEFT JOIN (VALUES {_MEANINGS_SQL}) m(field, meaning) ON m.field = COALESCE(t.field, e.field)""")
def _dictionary(spark, sf):
    return profile.data_dictionary(review_objects(spark, sf), _EXPECTED, "review")


@query("set_union", f"""SELECT COALESCE(t.field, e.field) AS field, t.field IS NOT NULL AS is_observed FROM typed_fields t
  FULL JOIN (SELECT unnest([{", ".join(f"'{f}'" for f in _EXPECTED)}]) AS field) e ON t.field = e.field""")
def _set_union(spark, sf):
    dictionary = profile.data_dictionary(review_objects(spark, sf), _EXPECTED, "review")
    return dictionary.select("field", (F.col("status") != "missing").alias("is_observed"))


_LENIENT_SQL = _ODD_RATING_SQL.format("CASE k % 8 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 5.0 WHEN 2 THEN 4.0 WHEN 5 THEN 3.5 WHEN 6 THEN 0.0 WHEN 7 THEN 1234.5 END")
_MOMENT_SQL = """CASE k % 7 WHEN 0 THEN t WHEN 1 THEN t WHEN 3 THEN TIMESTAMP '2020-02-03 04:05:06' WHEN 4 THEN t WHEN 5 THEN t END"""
_RAW_TIME_SQL = "CASE k % 7 WHEN 0 THEN ms::DOUBLE WHEN 1 THEN (ms // 1000)::DOUBLE WHEN 3 THEN 1580702706.0 WHEN 4 THEN ms::DOUBLE WHEN 5 THEN ms::DOUBLE END"
common_table("review_facts", f"""SELECT k, {_LENIENT_SQL} AS rating, {_MOMENT_SQL} AS moment, {_RAW_TIME_SQL} AS raw_time,
  CASE k % 4 WHEN 0 THEN (k % 10)::DOUBLE WHEN 2 THEN 3.0 END AS votes, CASE WHEN k % 9 NOT IN (0, 1) THEN 'P' || (k % 300) END AS parent FROM json_rows""")


def _metadata_lines(spark, sf):
    base = load(spark, sf, "part").selectExpr("p_partkey AS k", "p_name", "p_type", "p_size")
    value = """concat('{', concat_ws(',', concat('"main_category":"', p_type, '"'), concat('"title":"', p_name, chr(92), 't', k, '"'),
      concat('"average_rating":', p_size % 5, '.5'), concat('"rating_number":', p_size), '"features":["soft",2]',
      concat('"price":', CASE k % 4 WHEN 0 THEN 'null' WHEN 1 THEN concat('"$', p_size, '"') WHEN 2 THEN concat(p_size, '.0') ELSE '{"from":1}' END),
      '"videos":[]', concat('"store":', IF(k % 6 = 0, 'null', concat('"S', k % 7, '"'))),
      concat('"details":{"z":"', chr(92), 'n","b":', k, '}'), concat('"parent_asin":', IF(k % 10 = 0, '""', concat('"P', k % 160, '"'))), '"bought_together":null'), '}')"""
    return computed_once(base, "value", F.expr(value)).selectExpr("value", "'part' AS file", "0 AS block", "k AS place")


def metadata_objects(spark, sf):
    return lines.objects(lines.classify(_metadata_lines(spark, sf)))


@query("convert_metadata", """SELECT p_type AS main_category, p_name || ' ' || k AS product_title, (p_size % 5)::DOUBLE + 0.5 AS average_rating,
  CAST(p_size AS BIGINT) AS rating_number, '["soft",2]' AS features_json, CAST(NULL AS VARCHAR) AS description_json,
  CASE k % 4 WHEN 1 THEN '$' || p_size WHEN 2 THEN p_size || '.0' WHEN 3 THEN '{"from":1}' END AS price_raw, CAST(NULL AS VARCHAR) AS images_json,
  '[]' AS videos_json, CASE WHEN k % 6 <> 0 THEN 'S' || (k % 7) END AS store_name, CAST(NULL AS VARCHAR) AS categories_json,
  '{"z":" ","b":' || k || '}' AS details_json, CASE WHEN k % 10 = 0 THEN '' ELSE 'P' || (k % 160) END AS parent_asin,
  CAST(NULL AS VARCHAR) AS bought_together_json FROM (SELECT *, p_partkey AS k FROM part) p""")
def _convert_metadata(spark, sf):
    return records.to_metadata(metadata_objects(spark, sf))


@query("raw_price_value", """SELECT CASE k % 4 WHEN 1 THEN '$' || p_size WHEN 2 THEN p_size || '.0' WHEN 3 THEN '{"from":1}' END AS price_raw, COUNT(*) AS row_count
  FROM (SELECT *, p_partkey AS k FROM part) p GROUP BY 1""")
def _raw_price(spark, sf):
    prices = open_fields(metadata_objects(spark, sf), "price").select(JsonField("price").as_raw_price().alias("price_raw"))
    return prices.groupBy("price_raw").agg(F.count(F.lit(1)).alias("row_count"))


@query("sanitize_nested", f"SELECT k, {_IMAGES_SQL} AS images_json, {_TEXT_SQL} AS review_text FROM json_rows")
def _sanitize_nested(spark, sf):
    return open_fields(review_objects(spark, sf), "images", "text").select(
        F.col("place").alias("k"), JsonField("images").as_json().alias("images_json"), JsonField("text").as_string().alias("review_text"))


@query("nested_json", f"SELECT k, {_IMAGES_SQL} AS images_json FROM json_rows")
def _nested_json(spark, sf):
    return open_fields(review_objects(spark, sf), "images").select(F.col("place").alias("k"), JsonField("images").as_json().alias("images_json"))


@query("string_value", f"SELECT k, {_TITLE_SQL} AS title, CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'true' END AS verified_text FROM json_rows")
def _string_value(spark, sf):
    return open_fields(review_objects(spark, sf), "title", "verified_purchase").select(
        F.col("place").alias("k"), JsonField("title").as_string().alias("title"), JsonField("verified_purchase").as_string().alias("verified_text"))


@query("boolean_value", "SELECT k, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS verified FROM json_rows")
def _boolean_value(spark, sf):
    return open_fields(review_objects(spark, sf), "verified_purchase").select(F.col("place").alias("k"), JsonField("verified_purchase").as_boolean().alias("verified"))


_PARENTS_SQL = "SELECT DISTINCT 'P' || (p_partkey % 160) AS parent FROM part WHERE p_partkey % 10 <> 0"
common_table("meta_parents", _PARENTS_SQL)


@query("review_profile", f"""SELECT COUNT(*) AS valid_object_count, COUNT(*) FILTER (k % 6 = 0) AS missing_review_text_count,
  COUNT(*) FILTER (k % 6 = 1) AS null_review_text_count, COUNT(*) FILTER (k % 6 = 2) AS blank_review_text_count,
  COUNT(*) FILTER (rating IS NULL) AS invalid_rating_count, COUNT(*) FILTER (rating < 1 OR rating > 5) AS rating_outside_1_to_5_count,
  COUNT(*) FILTER (rating BETWEEN 1 AND 2) AS weak_negative_count, COUNT(*) FILTER (rating = 3) AS weak_neutral_count,
  COUNT(*) FILTER (rating BETWEEN 4 AND 5) AS weak_positive_count, COUNT(moment) AS timestamp_valid_count,
  COUNT(*) FILTER (moment IS NULL) AS timestamp_invalid_or_missing_count, MIN(raw_time) AS timestamp_minimum_raw, MAX(raw_time) AS timestamp_maximum_raw,
  strftime(MIN(moment), '%Y-%m-%d %H:%M:%S') AS timestamp_minimum_utc, strftime(MAX(moment), '%Y-%m-%d %H:%M:%S') AS timestamp_maximum_utc,
  COUNT(votes) AS helpful_vote_valid_count, COUNT(*) FILTER (votes IS NULL) AS helpful_vote_invalid_or_missing_count,
  MIN(votes) AS helpful_vote_minimum, MAX(votes) AS helpful_vote_maximum, AVG(votes) AS helpful_vote_mean, COUNT(*) FILTER (votes = 0) AS helpful_vote_zero_count,
  COUNT(parent) AS reviews_with_parent_asin, COUNT(*) FILTER (parent IS NULL) AS missing_or_blank_parent_asin_rows,
  COUNT(*) FILTER (parent IN (SELECT parent FROM meta_parents)) AS matched_parent_asin_rows,
  COUNT(*) FILTER (parent NOT IN (SELECT parent FROM meta_parents)) AS unmatched_parent_asin_rows,
  CAST(COUNT(*) FILTER (parent IN (SELECT parent FROM meta_parents)) AS DOUBLE) / COUNT(parent) AS sample_parent_asin_join_rate FROM review_facts""")
def _review_profile(spark, sf):
    return normalise(profile.review_profile(review_objects(spark, sf), profile.metadata_parents(metadata_objects(spark, sf))))


@query("rating_distribution", "SELECT CASE rating WHEN 5 THEN '5' WHEN 4.5 THEN '4.5' WHEN 4 THEN '4' WHEN 3.5 THEN '3.5' WHEN 0 THEN '0' ELSE '1234.5' END AS rating, COUNT(*) AS row_count FROM review_facts WHERE rating IS NOT NULL GROUP BY 1")
def _rating_distribution(spark, sf):
    return profile.rating_distribution(review_objects(spark, sf))


@query("verified_distribution", "SELECT CASE k % 3 WHEN 0 THEN 'boolean:true' WHEN 1 THEN 'boolean:false' ELSE 'string:true' END AS verified, COUNT(*) AS row_count FROM json_rows GROUP BY 1")
def _verified_distribution(spark, sf):
    return profile.verified_distribution(review_objects(spark, sf))


@query("metadata_profile", "SELECT (SELECT COUNT(*) FROM part) AS valid_object_count, COUNT(*) AS distinct_parent_asin_within_sample FROM meta_parents")
def _metadata_profile(spark, sf):
    return profile.metadata_profile(metadata_objects(spark, sf))


# ---- prediction files ----------------------------------------------------------
# One line per order; the order key modulo 40 chooses the fault, if any.
_SCORE = "0.375D + cast(k % 11 as int) / 16.0D"


def prediction_lines(spark, sf):
    base = load(spark, sf, "orders").selectExpr("o_orderkey AS k", "o_orderkey % 40 AS g")
    record = """concat('{', concat_ws(',',
      CASE g WHEN 3 THEN NULL WHEN 18 THEN concat('"review_key":"', sha2(concat('K', k - 1), 256), '"') WHEN 19 THEN concat('"review_key":"', sha2(concat('X', k), 256), '"')
        WHEN 20 THEN '"review_key":"  "' WHEN 21 THEN concat('"review_key":"a', chr(92), 'tb"') ELSE concat('"review_key":"', sha2(concat('K', k), 256), '"') END,
      CASE g WHEN 4 THEN '"pred_label":"unknown"' ELSE concat('"pred_label":"', element_at(array('negative', 'neutral', 'positive'), cast(k % 3 + 1 as int)), '"') END,
      CASE g WHEN 5 THEN '"pred_score":1.1' WHEN 6 THEN '"pred_score":"0.5"' ELSE concat('"pred_score":', 0.375D + cast(k % 11 as int) / 16.0D) END,
      CASE g WHEN 15 THEN '"negative_score":1.5' WHEN 16 THEN '"negative_score":null' WHEN 17 THEN '"negative_score":0.25,"neutral_score":0.25,"positive_score":0.5' END,
      CASE g WHEN 7 THEN '"model_version":""' WHEN 8 THEN '"model_version":"m/1"' WHEN 9 THEN '"model_version":"m0"' ELSE '"model_version":"m1"' END,
      CASE g WHEN 10 THEN '"inferred_at":"2024-05-01 00:00:00"' WHEN 11 THEN '"inferred_at":"2024-05-01T00:00:00+02:00"' ELSE '"inferred_at":"2024-05-01T00:00:00Z"' END,
      CASE g WHEN 12 THEN '"user_id":"u"' WHEN 13 THEN '"Review_Text":"t"' WHEN 14 THEN '"note":1' END), '}')"""
    value = F.expr(f"CASE g WHEN 0 THEN ' ' WHEN 1 THEN '{{bad' WHEN 2 THEN '[1]' ELSE {record} END")
    return computed_once(base, "value", value).selectExpr("value", "k AS line_no")


def checked_predictions(spark, sf):
    return prediction_files.check_records(lines.classify(prediction_lines(spark, sf)), MODEL)


_CODES = {
    0: ("blank_line",), 1: ("malformed_json",), 2: ("non_object",), 3: ("missing_required_field", "invalid_review_key"), 4: ("invalid_label",),
    5: ("invalid_score",), 6: ("invalid_score",), 7: ("blank_model_version",), 8: ("unsafe_model_version",), 9: ("model_version_mismatch",),
    10: ("invalid_timestamp",), 11: ("invalid_timestamp",), 12: ("forbidden_field", "unexpected_field"), 13: ("forbidden_field", "unexpected_field"),
    14: ("unexpected_field",), 15: ("invalid_optional_score",), 20: ("invalid_review_key",), 21: ("invalid_review_key",),
}
common_table("fault_codes", "SELECT * FROM (VALUES " + ", ".join(f"({g}, '{c}')" for g, cs in _CODES.items() for c in cs) + ") f(g, error)")
common_table("prediction_rows", """SELECT o_orderkey AS k, o_orderkey % 40 AS g, 0.375::DOUBLE + CAST(o_orderkey % 11 AS INTEGER) / 16.0::DOUBLE AS score,
  CASE o_orderkey % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS label FROM orders""")
common_table("kept_rows", "SELECT * FROM prediction_rows WHERE g NOT IN (SELECT g FROM fault_codes) AND g <> 18")


@query("prediction_jsonl_scan", """SELECT COUNT(*) AS physical_lines, COUNT(*) FILTER (g = 0) AS blank_lines, COUNT(*) FILTER (g = 1) AS malformed_json_count,
  COUNT(*) FILTER (g = 2) AS non_object_json_count, COUNT(*) FILTER (g > 2) AS valid_object_count FROM prediction_rows""")
def _prediction_scan(spark, sf):
    return lines.status_counts(prediction_files.read_predictions(spark, _as_files(prediction_lines(spark, sf), "prediction-lines", "line_no")))


@query("prediction_record_check", """SELECT k AS line_no, COALESCE((SELECT string_agg(error, ',' ORDER BY error) FROM fault_codes f WHERE f.g = p.g), '') AS error_codes
  FROM prediction_rows p""")
def _record_check(spark, sf):
    return checked_predictions(spark, sf).select("line_no", F.concat_ws(",", F.array_sort("errors")).alias("error_codes"))


@query("error_counts", "SELECT error, COUNT(*) AS row_count FROM prediction_rows p JOIN fault_codes f ON f.g = p.g GROUP BY error")
def _error_counts(spark, sf):
    return pred.error_counts(checked_predictions(spark, sf))


@query("set_intersection", "SELECT 'review_text' AS name, COUNT(*) AS row_count FROM prediction_rows WHERE g = 13 UNION ALL SELECT 'user_id', COUNT(*) FROM prediction_rows WHERE g = 12")
def _intersection(spark, sf):
    from reviewmill.schemas import PREDICTION_FORBIDDEN

    objects = lines.objects(lines.classify(prediction_lines(spark, sf)))
    names = F.transform(F.json_object_keys("value"), F.lower)
    hits = objects.select(F.explode(F.array_intersect(names, F.array(*[F.lit(n) for n in PREDICTION_FORBIDDEN]))).alias("name"))
    return hits.groupBy("name").agg(F.count(F.lit(1)).alias("row_count"))


def _count_of(code):
    if code == "invalid_score":  # takes in the optional scores
        return "(SELECT COUNT(*) FROM prediction_rows p JOIN fault_codes f ON f.g = p.g WHERE error IN ('invalid_score', 'invalid_optional_score')) AS invalid_score_count"
    return f"(SELECT COUNT(*) FROM prediction_rows p JOIN fault_codes f ON f.g = p.g WHERE error = '{code}') AS {code}_count"


_DUPLICATES = "(SELECT COUNT(*) FROM prediction_rows WHERE g = 18)"
_KEPT = "(SELECT COUNT(*) FROM kept_rows)"
_MATCHED = "(SELECT COUNT(*) FROM kept_rows WHERE g <> 19)"
_ALL_ROWS = "(SELECT COUNT(*) FROM prediction_rows)"
_FAILED = sorted({c for cs in _CODES.values() for c in cs} | {"duplicate_key_model_version", "unknown_review_key", "partial_file_not_allowed", "coverage_below_minimum"})


@query("prediction_file_check", f"""SELECT {_ALL_ROWS} AS physical_line_count, {", ".join(_count_of(c) for c in (*pred.LINE_CODES, *pred.RECORD_CODES))},
  {_KEPT} AS valid_prediction_row_count, {_KEPT} AS unique_review_key_count, {_MATCHED} AS matched_key_count, {_ALL_ROWS} AS dwd_key_count,
  {_KEPT} - {_MATCHED} AS unknown_key_count, {_ALL_ROWS} - {_MATCHED} AS missing_key_count,
  {", ".join(f"(SELECT COUNT(*) FROM kept_rows WHERE label = '{x}') AS {x}_count" for x in ("negative", "neutral", "positive"))},
  (SELECT MIN(score) FROM kept_rows) AS score_minimum, (SELECT MAX(score) FROM kept_rows) AS score_maximum, (SELECT AVG(score) FROM kept_rows) AS score_mean,
  {_DUPLICATES} AS duplicate_count, (SELECT COUNT(*) FROM prediction_rows WHERE g <> 0) AS prediction_row_count,
  CAST({_MATCHED} AS DOUBLE) / {_ALL_ROWS} AS coverage_rate, (SELECT COUNT(*) FROM prediction_rows WHERE g > 2) AS parsed_object_count,
  (SELECT COUNT(*) FROM prediction_rows WHERE g <> 0) - {_KEPT} AS invalid_record_count,
  '{{"{MODEL}":' || {_KEPT} || '}}' AS model_version_distribution,
  '{",".join(_FAILED)}' AS failure_reasons, 'FAIL' AS validation_status, '{BATCH}' AS batch_id, '{MODEL}' AS expected_model_version,
  'm1_' || substring(sha256('{MODEL}'), 1, 12) AS model_version_partition, false AS allow_partial, 1.0::DOUBLE AS minimum_coverage""")
def _file_check(spark, sf):
    known = load(spark, sf, "orders").selectExpr("sha2(concat('K', o_orderkey), 256) AS review_key")
    return pred.validate_predictions(checked_predictions(spark, sf), known, BATCH, MODEL)
