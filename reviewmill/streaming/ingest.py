"""The raw-layer load and the scoring of unseen reviews as file streams.

New files are taken up once each; the rows are those of the batch load. No
state is kept, so the streams need neither watermarks nor shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewmill.classifier.training import SentimentModel, prediction_output
from reviewmill.sources.lines import classify, objects
from reviewmill.sources.records import to_metadata, to_reviews


def stream_objects(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """JSON objects of the lines of a folder that grows."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return objects(classify(lines))


def stream_reviews(spark: SparkSession, path: str, batch: str) -> DataFrame:
    return to_reviews(stream_objects(spark, path)).withColumn("load_batch_id", F.lit(batch))


def stream_metadata(spark: SparkSession, path: str, batch: str) -> DataFrame:
    return to_metadata(stream_objects(spark, path)).withColumn("load_batch_id", F.lit(batch))


def write_available(rows: DataFrame, path: str, progress: str, *partition_by: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet table and stop.

    ``progress`` is the folder that keeps what has been taken up: a restarted job
    that names the same one goes on where the last ended. On a cluster it must be shared.
    """
    writer = rows.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True)
    return writer.partitionBy(*partition_by).start(path)


def score_stream(model: SentimentModel, reviews: DataFrame, model_version: str) -> DataFrame:
    """Predictions of a stream of unseen cleaned reviews, in the contract form."""
    return prediction_output(model.score(reviews), model_version)
