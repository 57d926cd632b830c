"""Exact reloads of a batch, and digests that name what differs."""

import pytest
from pyspark.sql import functions as F

from reviewmill.sources import batches, digests


def reviews(spark, rows):
    return spark.createDataFrame(rows, "review_key string, load_batch_id string, review_year int")


def keys(table):
    return sorted(r.review_key for r in table.collect())


def test_a_reload_of_fewer_years(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError):
        batches.read_batches(spark, path)
    first = reviews(spark, [("a", "b1", 2001), ("b", "b1", 2002), ("c", "b2", 2001)])
    for batch in ("b1", "b2"):
        batches.replace_batch(first, path, batch)
    assert keys(batches.read_batches(spark, path)) == ["a", "b", "c"]
    batches.replace_batch(reviews(spark, [("d", "b1", 2002)]), path, "b1")
    assert keys(batches.read_batches(spark, path)) == ["c", "d"] and keys(batches.read_batches(spark, path, "b2")) == ["c"]
    assert [tuple(r) for r in batches.partitions(spark, path).collect()] == [("b1", 2002, 1), ("b2", 2001, 1)]
    assert len(list((tmp_path / "data" / "load_batch_id=b1").iterdir())) == 1
    batches.replace_batch(reviews(spark, []), path, "b1")
    assert keys(batches.read_batches(spark, path)) == ["c"]


def test_a_write_that_was_broken_off_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    batches.replace_batch(reviews(spark, [("a", "b1", 2001)]), path, "b1")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(batches, "overwrite_partition", fails)
        with pytest.raises(RuntimeError):
            batches.replace_batch(reviews(spark, [("x", "b1", 2001), ("y", "b1", 2009)]), path, "b1")
    assert len(list((tmp_path / "data" / "load_batch_id=b1").iterdir())) == 2
    assert keys(batches.read_batches(spark, path)) == ["a"]
    batches.replace_batch(reviews(spark, [("z", "b1", 2003)]), path, "b1")
    assert keys(batches.read_batches(spark, path)) == ["z"] and len(list((tmp_path / "data" / "load_batch_id=b1").iterdir())) == 1


def test_reads_prune_to_the_listed_version(spark, tmp_path):
    batches.replace_batch(reviews(spark, [("a", "b1", 2001)]), str(tmp_path), "b1")
    plan = batches.read_batches(spark, str(tmp_path)).filter("review_year = 2001")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "version" in filters and "review_year" in filters
    plan = batches.listed(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "/data" not in plan and "Location" in plan


def test_a_changed_row_is_named(spark):
    table = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"), F.lit("").alias("w"))
    odd = table.withColumn("v", F.when(F.col("k") == "k77", 99).otherwise(F.col("v"))).withColumn("w", F.when(F.col("k") == "k88", None).otherwise(F.col("w")))
    odd = odd.filter("k <> 'k99'").unionByName(table.filter("k in ('k11', 'k12')"))
    stated, found = digests.digests(table, "k"), digests.digests(odd, "k")
    ranges = digests.differing_ranges(stated, found).collect()
    assert 4 <= len(ranges) <= 5 and sum(r.found_rows - r.stated_rows for r in ranges) == 1
    rows = sorted((r.k, r.stated_copies, r.found_copies) for r in digests.differing_rows(table, odd, "k").collect())
    assert rows == [("k11", 1, 2), ("k12", 1, 2), ("k77", 0, 1), ("k77", 1, 0), ("k88", 0, 1), ("k88", 1, 0), ("k99", 1, 0)]
    assert digests.differing_rows(table, table.orderBy(F.desc("k")), "k").count() == 0
    untouched = {tuple(r) for r in stated.filter("level = 3").collect()} & {tuple(r) for r in found.filter("level = 3").collect()}
    assert len(untouched) == stated.filter("level = 3").count() - len(ranges)


def test_empty_and_null(spark):
    table = spark.createDataFrame([(None, 1), (None, 1), ("a", None)], "k string, v int")
    assert digests.differing_rows(table, table, "k").count() == 0
    gone = sorted(map(str, (tuple(r) for r in digests.differing_rows(table, table.limit(0), "k").collect())))
    assert gone == ["('a', 1, 0)", "(None, 2, 0)"]


def test_only_fingerprints_are_moved_for_rows_that_agree(spark):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), (F.col("id") % 7).alias("v"))
    extra = spark.createDataFrame([(None, 1), ("x", None)], "key string, v bigint")
    stated, found = rows.union(extra).union(extra), rows.filter("v <> 3 or key > 'f8'").union(extra).union(rows.filter("key > 'fd'"))
    table = digests.differing_rows(stated, found, "key")
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "key_range" not in plan
    got = {r.key: (r.stated_copies, r.found_copies) for r in table.collect()}
    expected = {None: (2, 1), "x": (2, 1)}
    for r in rows.collect():
        copies = (r.v != 3 or r.key > "f8") + (r.key > "fd")
        if copies != 1:
            expected[r.key] = (1, copies)
    assert got == expected


def test_a_batch_is_written_by_the_tasks_that_hold_it(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("review_key"), F.lit("b1").alias("load_batch_id"), (2000 + F.col("id") % 2).cast("int").alias("review_year"))
    batches.replace_batch(rows, str(tmp_path), "b1")
    files = list((tmp_path / "data").rglob("*.parquet"))
    assert len(files) == 8 and all(f.name.endswith(".zstd.parquet") for f in files)
    assert keys(batches.read_batches(spark, str(tmp_path), "b1")) == keys(rows)
