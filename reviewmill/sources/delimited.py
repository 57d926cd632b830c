"""Control-A delimited text: the raw layer and the prediction staging area.

Lines are split and joined with plain text functions: quoting rules of a CSV
reader do not apply to this format, and empty text must stay apart from null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.once import computed_once
from reviewmill.schemas import FIELD_DELIMITER, NULL_TEXT, PREDICTION_STAGING, RAW_METADATA, RAW_REVIEW

_CONTROL = "[\\x01\\r\\n\\t]"
_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat schema."""
    return [tuple(part.split()) for part in ddl.split(",")]


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One partitioned folder; ``load_batch_id`` comes from the directory names.

    Missing trailing fields are null, surplus ones are ignored, and so is text
    that does not fit its type.
    """
    lines = spark.read.schema("value STRING, load_batch_id STRING").text(path)
    split = computed_once(lines, "_fields", F.split("value", FIELD_DELIMITER, -1))
    columns = []
    for position, (name, data_type) in enumerate(_fields(ddl)):
        text = F.nullif(F.get("_fields", F.lit(position)), F.lit(NULL_TEXT))
        columns.append((text if data_type == "STRING" else text.try_cast(data_type)).alias(name))
    return split.select(*columns, "load_batch_id")


def read_raw_reviews(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, RAW_REVIEW)


def read_raw_metadata(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, RAW_METADATA)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """Staged predictions. Files repeat the batch as a ninth field, which is not read."""
    return _read(spark, path, PREDICTION_STAGING)


def _text_of(name: str, data_type: str) -> Column:
    if data_type == "TIMESTAMP":
        return F.date_format(name, _TIME_FORMAT)
    return F.col(name).cast("string")


def _write(table: DataFrame, path: str, batch: str, ddl: str, *more: Column) -> None:
    """Replace the folder of one batch. The job fails when a value still holds a control character."""
    fields = _fields(ddl)
    missing = [name for name, _ in fields if name not in table.columns]
    if missing:
        raise ValueError(f"columns missing from the table: {', '.join(missing)}")
    strings = [name for name, data_type in fields if data_type == "STRING"]
    unsafe = reduce(Column.__or__, [F.coalesce(F.col(c).rlike(_CONTROL), F.lit(False)) for c in strings])
    stop = F.raise_error(F.lit("a control character remains after conversion")).cast("string")
    values = [F.coalesce(_text_of(name, data_type), F.lit(NULL_TEXT)) for name, data_type in fields]
    line = F.when(unsafe, stop).otherwise(F.concat_ws(FIELD_DELIMITER, *values, *more))
    rows = table.select(line.alias("value"), F.lit(batch).alias("load_batch_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_batch_id").text(path)


def write_raw(table: DataFrame, path: str, batch: str, columns: str = RAW_REVIEW) -> None:
    """Write raw-layer rows of one batch; other batches stay as they are."""
    _write(table, path, batch, columns)


def write_keys(keys: DataFrame, path: str) -> None:
    """One key per line, in the order given."""
    keys.write.mode("overwrite").text(path)


def read_keys(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", name)


def write_staging(predictions: DataFrame, path: str, batch: str) -> None:
    """Write checked predictions of one batch as nine fields, the last one being the batch."""
    _write(predictions, path, batch, PREDICTION_STAGING, F.lit(batch))
