"""JSON-lines input, conversion and profiles on literal records."""

import json

import pytest
from pyspark.sql import functions as F

from reviewmill.functions.variants import JsonField, open_fields
from reviewmill.operators import profile
from reviewmill.schemas import METADATA_JSON_FIELDS, RAW_METADATA, REVIEW_JSON_FIELDS
from reviewmill.sources import delimited, lines, records

FULL = {"rating": 4, "title": "Warm", "text": "A coat for cold days", "asin": "Q7", "parent_asin": "F7", "user_id": "W3",
        "timestamp": 1500000000000, "helpful_vote": 2, "verified_purchase": False}
POOR = {"rating": 9, "title": None, "text": " \t", "asin": "Q8", "parent_asin": "F8", "user_id": None, "timestamp": "soon",
        "helpful_vote": "many", "verified_purchase": True}


def write(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture
def review_file(tmp_path):
    return write(tmp_path / "reviews.jsonl", [FULL, "  ", POOR, "[3]", FULL, "{\"rating\":"])


def read(spark, path):
    return lines.read_jsonl(spark, path)


def test_line_classes(spark, review_file):
    counts = lines.status_counts(read(spark, review_file)).first()
    assert counts.asDict() == {"physical_lines": 6, "blank_lines": 1, "malformed_json_count": 1,
                               "non_object_json_count": 1, "valid_object_count": 3}


def test_profile_of_values(spark, review_file):
    objects = lines.objects(read(spark, review_file))
    parents = spark.createDataFrame([("F7",)], "parent string")
    row = profile.review_profile(objects, parents).first()
    assert row.blank_review_text_count == 1
    assert row.rating_outside_1_to_5_count == 1
    assert row.timestamp_invalid_or_missing_count == 1
    assert row.helpful_vote_invalid_or_missing_count == 1
    assert (row.matched_parent_asin_rows, row.unmatched_parent_asin_rows) == (2, 1)
    assert row.sample_parent_asin_join_rate == pytest.approx(2 / 3)
    fields = {r.field: r for r in profile.field_profile(objects).collect()}
    assert fields["title"].nulls == 1 and fields["user_id"].nulls == 1 and fields["text"].blank_strings == 1
    assert "images" not in fields


def test_shapes_equal_single_fields(spark):
    rows = ['{"a":1,"b":"x","b":" "}', '{"a":1.0}', '{"a":12345678901234567890123,"c":{"a":1.5}}', '{"a":1e3,"b":null}', '{}', '{"a":[],"b":true,"a":7.25}',
            '{"a":5.0,"text":"a 5.0 b"}', '{"a":NaN,"d e":""}', '{"a":5,"b":"12345678901234567890"}'] * 3
    objects = lines.objects(lines.classify(spark.createDataFrame([(r,) for r in rows], "value string")))
    found = {(r.field, r.kind): r.n for r in profile.field_shapes(objects).groupBy("field", "kind").agg(F.sum("row_count").alias("n")).collect()}
    single = {(r.field, r.kind): r.n for r in profile.exploded_fields(objects).groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {k: n for k, n in single.items() if k[0] is not None} and found["a", "integer"] == 9 and found["a", "number"] == 15
    assert {r.field: r.blank_strings for r in profile.field_profile(objects).collect()} == {"a": 0, "b": 3, "c": 0, "d e": 3, "text": 0}
    plan = profile.field_shapes(objects)._jdf.queryExecution().optimizedPlan().toString()
    # Fields are unfolded above the count of shapes, not for every line.
    assert plan.index("Generate inline") < plan.index("Aggregate [shape") and "variant_explode" not in plan


def test_dictionary_statuses(spark, review_file):
    objects = lines.objects(read(spark, review_file))
    rows = {r.field: r for r in profile.data_dictionary(objects, REVIEW_JSON_FIELDS[1:], "review").collect()}
    assert rows["images"].status == "missing" and rows["rating"].status == "unexpected" and rows["asin"].status == "observed"
    assert rows["rating"].proposed_type == "BIGINT" and rows["title"].nullable


def test_first_lines_and_numbers(spark, tmp_path):
    path = write(tmp_path / "many.jsonl", [f'{{"n":{i}}}' if i % 3 else "" for i in range(1, 101)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        numbered = {r.line_no: r.value for r in lines.number_lines(lines.read_lines(spark, path)).collect()}
        assert len(numbered) == 100 and numbered[1] == '{"n":1}' and numbered[99] == "" and numbered[100] == '{"n":100}'
        first = lines.first_lines(lines.read_lines(spark, path), 10)
        assert [r.value for r in first.orderBy("line_no").collect()] == [numbered[i] for i in range(1, 11)]
        valid = lines.first_valid(read(spark, path), 5)
        assert [json.loads(r.value)["n"] for r in valid.orderBy("line_no").collect()] == [1, 2, 4, 5, 7]
        with pytest.raises(ValueError, match="67 are required|67 valid"):
            lines.first_valid(read(spark, path), 68)
        with pytest.raises(ValueError):
            lines.first_lines(read(spark, path), 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbers_do_not_depend_on_later_cuts(spark, tmp_path):
    rows = [f'{{"n":{i}}}' for i in range(1, 301)]
    for name, part in (("a", rows[:140]), ("b", rows[140:])):
        write(tmp_path / f"{name}.jsonl", part)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        numbered = lines.number_lines(lines.read_lines(spark, str(tmp_path)))
        first = lines.first_lines(lines.stored_lines(lines.read_lines(spark, str(tmp_path))), 150)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1300")
        assert {r.line_no: r.value for r in numbered.collect()} == dict(enumerate(rows, 1))
        assert {r.line_no: r.value for r in first.collect()} == dict(enumerate(rows[:150], 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_malformed_examples(spark, review_file):
    numbered = lines.classify(lines.number_lines(lines.read_lines(spark, review_file)))
    assert [tuple(r) for r in lines.malformed_examples(numbered).collect()] == [(6, "invalid_json")]


def test_sanitised_conversion_round_trip(spark, tmp_path):
    rows = [
        {**FULL, "title": "a\u0001b", "text": "line1\nline2\tend", "images": ["x\ny"], "user_id": None},
        {**FULL, "title": 'say "hi" \\ back', "text": "  尺码合适，面料舒适  ", "images": None, "rating": "3.5", "asin": ""},
    ]
    objects = lines.objects(read(spark, write(tmp_path / "r.jsonl", rows)))
    delimited.write_raw(records.to_reviews(objects), str(tmp_path / "ods"), "b9")
    first, second = delimited.read_raw_reviews(spark, str(tmp_path / "ods")).orderBy(F.desc("rating")).collect()
    assert (first.title, first.review_text, first.images_json, first.user_id) == ("a b", "line1 line2 end", '["x y"]', None)
    assert (second.title, second.review_text, second.images_json) == ('say "hi" \\ back', "  尺码合适，面料舒适  ", None)
    assert (second.rating, second.asin, second.load_batch_id) == (3.5, "", "b9")
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "ods").rglob("*.txt"))
    assert all(line.count("\u0001") == 9 for line in text.splitlines()) and "\\N" in text


def test_metadata_has_fourteen_fields(spark, tmp_path):
    row = {"main_category": "C", "title": "T", "average_rating": 4.5, "rating_number": 2, "features": ["é"], "description": [],
           "price": 12.5, "images": [], "videos": [], "store": None, "categories": [], "details": {"a": "b\t c"},
           "parent_asin": "P1", "bought_together": None}
    assert set(row) == set(METADATA_JSON_FIELDS)
    objects = lines.objects(read(spark, write(tmp_path / "m.jsonl", [row])))
    delimited.write_raw(records.to_metadata(objects), str(tmp_path / "ods"), "b", RAW_METADATA)
    got = delimited.read_raw_metadata(spark, str(tmp_path / "ods")).first()
    assert (got.details_json, got.features_json, got.price_raw, got.store_name) == ('{"a":"b  c"}', '["é"]', "12.5", None)
    [file] = (tmp_path / "ods").rglob("*.txt")
    assert file.read_text(encoding="utf-8").splitlines()[0].count("\u0001") == 13


@pytest.mark.parametrize("value, number, integer", [
    ("5", 5.0, 5), ("5.0", 5.0, 5), ('"5"', 5.0, 5), ('" 5.0 "', 5.0, None), ("true", None, None), ("null", None, None),
    ('"abc"', None, None), ('"NaN"', None, None), ("1e400", None, None), ("2.5", 2.5, None), ('"1e2"', 100.0, None),
    ("9007199254740993", 9007199254740992.0, 9007199254740993), ("[1]", None, None),
])
def test_number_reads(spark, value, number, integer):
    source = spark.createDataFrame([('{"x":%s}' % value,)], "value string")
    row = open_fields(lines.classify(source), "x").select(
        JsonField("x").as_number().alias("n"), JsonField("x").as_integer().alias("i")).first()
    assert (row.n, row.i) == (number, integer)


@pytest.mark.parametrize("value, kind", [
    ("null", "null"), ("true", "boolean"), ("7", "integer"), ("7.0", "number"), ("7.5", "number"), ("1e3", "number"),
    ("12345678901234567890123", "integer"), ('"s"', "string"), ("[]", "array"), ("{}", "object"),
])
def test_kinds(spark, value, kind):
    source = spark.createDataFrame([('{"x":%s}' % value,)], "value string")
    assert open_fields(lines.classify(source), "x").select(JsonField("x").kind).first()[0] == kind
    assert profile.exploded_fields(lines.classify(source)).first().kind == kind


def test_escaped_backslash_is_not_a_line_break(spark):
    source = spark.createDataFrame([(json.dumps({"x": ["a\\nb", "c\n\nd", "e\\\nf"]}),)], "value string")
    got = open_fields(lines.classify(source), "x").select(JsonField("x").as_json()).first()[0]
    assert json.loads(got) == ["a\\nb", "c  d", "e\\ f"]


def test_repeated_fields_keep_the_last_value(spark):
    line = '{"rating":1,"rating":5,"images":["a"],"images":["b"],"title":7,"title":8,"price":{"a":1},"price":2.0,"text":"x","text":null}'
    objects = lines.objects(lines.classify(spark.createDataFrame([(line,)], "value string")))
    row = records.to_reviews(objects).first()
    assert (row.rating, row.images_json, row.title, row.review_text) == (5.0, '["b"]', "8", None)
    assert records.to_metadata(objects).first().price_raw == "2.0"
    assert [tuple(r) for r in profile.rating_distribution(objects).collect()] == [("5", 1)]


@pytest.mark.parametrize("value, text, price", [
    ("NaN", "nan", "NaN"), ("Infinity", "inf", "Infinity"), ("-Infinity", "-inf", "-Infinity"), ("1e400", "inf", "Infinity"), ("-2.50", "-2.5", "-2.5")])
def test_numbers_that_are_not_finite_leave_the_record_whole(spark, value, text, price):
    line = '{"rating":%s,"title":%s,"price":%s,"text":"NaN, Infinity","asin":"A"}' % (value, value, value)
    objects = lines.objects(lines.classify(spark.createDataFrame([(line,), ('{"a":NaN',), ('{"a":NaN,}',)], "value string")))
    [row] = records.to_reviews(objects).collect()
    assert (row.rating, row.title, row.review_text, row.asin) == (None if text.endswith(("n", "f")) else -2.5, text, "NaN, Infinity", "A")
    assert records.to_metadata(objects).first().price_raw == price
    assert profile.exploded_fields(objects).filter("field = 'rating'").first().kind == "number"
