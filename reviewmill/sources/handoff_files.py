"""JSON-lines export of the classifier input with its summary and manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.serving_values import normalise
from reviewmill.functions.text import missing_or_blank
from reviewmill.operators.checks import check_export, export_metrics
from reviewmill.operators.clean import in_key_order
from reviewmill.schemas import (
    HANDOFF_FIELDS,
    HANDOFF_MEANINGS,
    HANDOFF_SCHEMA_VERSION,
    HANDOFF_TYPES,
    WEAK_LABEL_MAPPING,
    WEAK_LABEL_STATEMENT,
)
from reviewmill.session import scratch_path
from reviewmill.sources.tables import build_export

SOURCE_TABLE = "clean_reviews"
#: Folder of the data below that of an export.
DATA = "data"

_JSON_SCHEMA = (
    "review_key STRING, review_text_clean STRING, rating_label STRING, rating DOUBLE, "
    "parent_asin STRING, main_category STRING, review_time STRING, load_batch_id STRING"
)


def content_hash(table: DataFrame) -> DataFrame:
    """Hash of the rows that does not depend on their order or on files.

    Hashes are added, not combined by XOR, so that equal rows do not cancel out.
    """
    total = F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))
    return table.agg(F.coalesce(total, F.lit(0)).cast("string").alias("content_hash"))


def with_content_hash(metrics: DataFrame, table: DataFrame) -> DataFrame:
    """Metrics and hash of a table as one row, brought together by an aggregate."""
    merged = metrics.unionByName(content_hash(table), allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def summary(handoff: DataFrame, batch: str, source_table: str = SOURCE_TABLE) -> DataFrame:
    """One row: all export counts, the content hash, and what was exported when."""
    plain = normalise(handoff)
    return with_content_hash(export_metrics(plain), plain).withColumns({
        "batch_id": F.lit(batch), "schema_version": F.lit(HANDOFF_SCHEMA_VERSION),
        "source_table": F.lit(source_table), "output_name": F.lit(DATA),
        "export_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    })


def manifest(export_summary: DataFrame) -> DataFrame:
    """One row that describes the export: fields, meanings, types, labels, source, hash, time."""
    def mapped(values: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])

    return export_summary.select(
        "schema_version", F.array(*[F.lit(f) for f in HANDOFF_FIELDS]).alias("field_order"),
        mapped(HANDOFF_MEANINGS).alias("field_meanings"), mapped(HANDOFF_TYPES).alias("expected_types"),
        "batch_id", "source_table", mapped(WEAK_LABEL_MAPPING).alias("label_mapping"),
        F.lit(True).alias("rating_label_is_weak_label"), F.lit(WEAK_LABEL_STATEMENT).alias("rating_label_statement"),
        "output_name", "content_hash", F.col("export_timestamp").alias("generated_timestamp"),
    )


def write_jsonl(handoff: DataFrame, path: str) -> None:
    """UTF-8 JSON lines in key order, fields in contract order, nulls written out."""
    rows = normalise(in_key_order(handoff.select(*HANDOFF_FIELDS)))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export(handoff: DataFrame, root: str, batch: str, source_table: str = SOURCE_TABLE) -> None:
    """Write data, summary and manifest; refuse to write anything when a row breaks the rules.

    ``handoff`` is evaluated once, into the shared folder; everything else reads that copy.
    """
    spark = handoff.sparkSession
    check_export(handoff, batch)  # the columns, before anything runs
    once = build_export(handoff, scratch_path(spark, "export-input"))
    if check_export(once, batch).filter(F.size("errors") > 0).limit(1).count():
        raise ValueError("the classifier input has invalid rows")
    facts = summary(once, batch, source_table)
    facts = spark.createDataFrame([facts.first()], facts.schema)
    if facts.filter("duplicate_review_key_count > 0").count():
        raise ValueError("the classifier input has duplicate keys")
    write_jsonl(once, f"{root}/{DATA}")
    facts.write.mode("overwrite").json(f"{root}/summary")
    manifest(facts).write.mode("overwrite").json(f"{root}/manifest")


def read_export(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_JSON_SCHEMA).json(f"{root}/{DATA}", mode="FAILFAST")


def _facts(frame: DataFrame, name: str, prefix: str = "", skip: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a one-row frame as (fact, value) rows of text."""
    def text(c: str, kind: str) -> Column:
        return F.to_json(c) if kind.startswith(("array", "map")) else F.col(c).cast("string")

    cells = [F.struct(F.lit(prefix + c).alias("fact"), text(c, kind).alias(name)) for c, kind in frame.dtypes if c not in skip]
    return frame.select(F.inline(F.array(*cells)))


def revalidate(spark: SparkSession, root: str, batch: str, expected_rows: int | None = None) -> DataFrame:
    """Recheck a written export; one row ``fact, stated, found`` per fact that does not agree.

    The summary is compared with the data, the manifest with the summary. Records
    that break the rules, blank lines, lines with other fields than the contract's
    and a row count other than ``expected_rows`` are facts of their own. Lines that
    are no JSON make the job fail.
    """
    read = read_export(spark, root)
    found = summary(read, batch)
    stated = spark.read.schema(found.schema).json(f"{root}/summary")
    described = manifest(stated)
    written = spark.read.schema(described.schema).json(f"{root}/manifest")
    blank = missing_or_blank("value")
    other = F.coalesce(F.json_object_keys("value") != F.array(*[F.lit(f) for f in HANDOFF_FIELDS]), F.lit(True))
    lines = spark.read.text(f"{root}/{DATA}").agg(
        F.count(F.when(blank, 1)).alias("blank_lines"), F.count(F.when(~blank & other, 1)).alias("lines_with_other_fields"))
    broken = check_export(read, batch).agg(F.count(F.when(F.size("errors") > 0, 1)).alias("invalid_records"))

    # Source and time can be read nowhere else.
    skip = ("source_table", "export_timestamp")
    claims = _facts(stated, "stated", skip=skip).unionByName(_facts(written, "stated", "manifest."))
    truth = _facts(found, "found", skip=skip).unionByName(_facts(described, "found", "manifest."))
    for counted in (lines, broken):
        truth = truth.unionByName(_facts(counted, "found"))
        claims = claims.unionByName(_facts(counted.select(*[F.lit("0").alias(c) for c in counted.columns]), "stated"))
    if expected_rows is not None:
        claims = claims.unionByName(_facts(found.select(F.lit(str(expected_rows)).alias("expected_row_count")), "stated"))
        truth = truth.unionByName(_facts(found.select(F.col("export_row_count").alias("expected_row_count")), "found"))
    return claims.join(truth, "fact", "full").filter(~F.col("stated").eqNullSafe(F.col("found")))
