"""Cleaned reviews by batch, where a reload replaces exactly its batch and a half-written one is never read."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.sources.tables import overwrite_partition

DATA, LIST = "data", "batches"
_LIST_SCHEMA = "version STRING, review_year INT, row_count BIGINT, load_batch_id STRING"


def replace_batch(reviews: DataFrame, path: str, batch: str) -> str:
    """Store the rows of ``batch`` anew and return the version they have.

    The rows go to a folder of their own version, by year. Only then the list of the batch's years is replaced, which
    is what readers follow: until then they see the version before, and years that the reload no longer has are
    gone with it. The folders of earlier versions are deleted last.
    """
    spark = reviews.sparkSession
    version, folder = uuid.uuid4().hex, f"{path}/{DATA}/load_batch_id={batch}"
    rows = reviews.filter(F.col("load_batch_id") == batch).drop("load_batch_id")
    # Every task writes a file for each year it holds. Dealing the rows by year first would move all of them, keys that do not compress among them.
    rows.write.partitionBy("review_year").option("compression", "zstd").parquet(f"{folder}/version={version}")
    # A folder without any row has no file that tells its columns.
    years = [f for f in _folders(spark, f"{folder}/version={version}") if f.startswith("review_year=")]
    found = spark.read.schema("review_year INT").parquet(f"{folder}/version={version}") if years else spark.createDataFrame([], "review_year INT")
    counted = found.groupBy("review_year").agg(F.count(F.lit(1)).alias("row_count"))
    # A batch without rows has one line in the list, so that its earlier version is replaced too.
    listed = counted.unionByName(spark.range(0 if years else 1).select(F.lit(None).cast("int").alias("review_year"), F.lit(0).cast("long").alias("row_count")))
    overwrite_partition(listed.coalesce(1).withColumn("version", F.lit(version)), f"{path}/{LIST}", {"load_batch_id": batch})
    for old in _folders(spark, folder):
        if old != f"version={version}":
            _delete(spark, f"{folder}/{old}")
    return version


def listed(spark: SparkSession, path: str) -> DataFrame:
    """``load_batch_id, version, review_year, row_count`` of what readers see, from the list: no data file is opened."""
    try:
        rows = spark.read.schema(_LIST_SCHEMA).parquet(f"{path}/{LIST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _LIST_SCHEMA)
    return rows.select("load_batch_id", "version", "review_year", "row_count")


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """Batches and years that have rows, in order."""
    return listed(spark, path).filter("row_count > 0").select("load_batch_id", "review_year", "row_count").orderBy("load_batch_id", "review_year")


def read_batches(spark: SparkSession, path: str, *batches: str) -> DataFrame:
    """The stored reviews of the named batches, of all if none is named; folders that are not in the list are left out."""
    known = listed(spark, path).filter("row_count > 0").select("load_batch_id", "version").distinct()
    if batches:
        known = known.filter(F.col("load_batch_id").isin(*batches))
    versions = [r.version for r in known.collect()]  # one for each batch
    if not versions:
        raise ValueError(f"no batch of {list(batches) or 'any name'} is stored")
    rows = spark.read.parquet(f"{path}/{DATA}").filter(F.col("version").isin(versions)).drop("version")
    return rows.withColumn("review_year", F.col("review_year").cast("int"))


def _folders(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()] if system.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
