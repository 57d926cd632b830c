"""Written tables: partitions, guards, export files, streams."""

import json

import pytest
from pyspark.sql import functions as F

from querybook import aggregates as fixtures
from querybook.cleaning import clean_table
from querybook.fixtures import BATCH, MODEL
from reviewmill.operators.clean import handoff
from reviewmill.sources import handoff_files, tables
from reviewmill.sources.lines import objects, read_jsonl
from reviewmill.sources.records import to_reviews
from reviewmill.streaming.ingest import stream_reviews, write_available


def test_overwrite_touches_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    for model, values in (("m1", [1, 2]), ("m2", [3]), ("m1", [9])):
        tables.overwrite_partition(spark.createDataFrame([(v,) for v in values], "v int"), path, {"load_batch_id": "b", "model_version": model})
    assert sorted((r.model_version, r.v) for r in spark.read.parquet(path).collect()) == [("m1", 9), ("m2", 3)]


def test_clean_table_keeps_other_batches_and_text_years(spark, sf_dir, tmp_path):
    path = str(tmp_path / "clean")
    table = clean_table(spark, sf_dir)
    tables.write_clean(table, path)
    tables.write_clean(table.withColumn("load_batch_id", F.lit("b2")), path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["review_year"] == "string"
    assert {r.load_batch_id: r["count"] for r in back.groupBy("load_batch_id").count().collect()} == {BATCH: table.count(), "b2": table.count()}


def test_a_small_year_is_one_file(spark, sf_dir, tmp_path):
    tables.write_clean(clean_table(spark, sf_dir).repartition(7), str(tmp_path / "clean"))
    files = [p.parent for p in (tmp_path / "clean").rglob("*.parquet")]
    assert len(files) == len(set(files)) > 1


def test_stamp(spark, sf_dir):
    from datetime import datetime, timedelta

    row = fixtures.agg.stamp(fixtures.overview(spark, sf_dir), BATCH, MODEL).first()
    assert abs(row.generated_at - datetime.now()) < timedelta(days=1) and (row.load_batch_id, row.model_version) == (BATCH, MODEL)


def test_guard(spark, tmp_path):
    path, spec = str(tmp_path / "t"), {"load_batch_id": "b", "model_version": "m"}
    tables.guard_version(spark, path, spec)
    tables.overwrite_partition(spark.range(1), path, spec)
    with pytest.raises(ValueError, match="force"):
        tables.guard_version(spark, path, spec)
    tables.guard_version(spark, path, spec, force=True)
    tables.guard_version(spark, path, {**spec, "model_version": "other"})


def test_unknown_serving_table_is_refused(spark):
    with pytest.raises(ValueError):
        tables.serving_table(spark, "/nowhere", "dws_other; DROP", BATCH, MODEL)


def test_serving_read_is_pruned(spark, sf_dir, tmp_path):
    for model in (MODEL, "m2"):
        stamped = fixtures.agg.stamp(fixtures.daily(spark, sf_dir), BATCH, model)
        tables.overwrite_partition(stamped, f"{tmp_path}/dws_sentiment_daily", {"load_batch_id": BATCH, "model_version": model})
    read = tables.serving_table(spark, str(tmp_path), "dws_sentiment_daily", BATCH, MODEL)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_batch_id" in plan
    assert read.count() * 2 == spark.read.parquet(f"{tmp_path}/dws_sentiment_daily").count()


def test_export_files(spark, sf_dir, tmp_path):
    table = handoff(clean_table(spark, sf_dir))
    handoff_files.export(table, str(tmp_path), BATCH)
    lines = [line for p in sorted((tmp_path / "data").glob("part-*")) for line in p.read_text(encoding="utf-8").splitlines()]
    first = json.loads(lines[0])
    assert list(first) == list(handoff_files.HANDOFF_FIELDS) and len(lines) == table.count()
    assert any(json.loads(line)["main_category"] is None for line in lines)
    assert any(ord(c) > 127 for line in lines for c in line) and "\\u00" not in "".join(lines)
    import base64

    keys = [base64.b64encode(json.loads(line)["review_key"].encode()) for line in lines]
    assert keys == sorted(keys)
    assert handoff_files.revalidate(spark, str(tmp_path), BATCH).count() == 0


def test_changed_export_is_noticed(spark, sf_dir, tmp_path):
    handoff_files.export(handoff(clean_table(spark, sf_dir)), str(tmp_path), BATCH)
    file = next(p for p in sorted((tmp_path / "data").glob("part-*")) if p.stat().st_size)
    file.write_text("\n".join(file.read_text(encoding="utf-8").splitlines()[1:]), encoding="utf-8")
    (file.parent / f".{file.name}.crc").unlink()
    facts = {r.fact for r in handoff_files.revalidate(spark, str(tmp_path), BATCH).collect()}
    assert {"export_row_count", "unique_review_key_count", "content_hash"} <= facts


def test_invalid_export_is_refused(spark, sf_dir, tmp_path):
    table = handoff(clean_table(spark, sf_dir))
    with pytest.raises(ValueError, match="columns"):
        handoff_files.export(table.withColumn("user_id", F.lit("u")), str(tmp_path / "a"), BATCH)
    with pytest.raises(ValueError, match="invalid"):
        handoff_files.export(table.withColumn("rating", F.lit(7.0)), str(tmp_path / "b"), BATCH)
    with pytest.raises(ValueError, match="duplicate"):
        handoff_files.export(table.unionByName(table), str(tmp_path / "c"), BATCH)
    assert not (tmp_path / "b").exists()


def test_content_hash_ignores_order_but_not_copies(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, s string")
    hashes = [handoff_files.content_hash(t).first()[0] for t in (rows, rows.orderBy(F.desc("i")), rows.distinct())]
    assert hashes[0] == hashes[1] != hashes[2]


def test_stream_gives_the_rows_of_the_batch_load(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    record = {"rating": 5, "title": "t", "text": "x\ny", "asin": "A", "parent_asin": "P", "user_id": "U",
              "timestamp": 1, "helpful_vote": 0, "verified_purchase": True}

    def add(name, *lines):
        (source / name).write_text("".join(line + "\n" for line in lines))

    def run():
        write_available(stream_reviews(spark, str(source), "b"), target, str(tmp_path / "progress"), "load_batch_id").awaitTermination()
        return spark.read.parquet(target)

    add("1.jsonl", json.dumps(record), "", "{bad", "[1]")
    assert run().count() == 1
    add("2.jsonl", json.dumps({**record, "rating": "4"}))
    got = run()
    batch = to_reviews(objects(read_jsonl(spark, str(source)))).withColumn("load_batch_id", F.lit("b"))
    assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
