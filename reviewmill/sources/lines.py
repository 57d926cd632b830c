"""JSON-lines input: physical lines, their order and their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.functions.once import computed_once
from reviewmill.functions.text import missing_or_blank
from reviewmill.session import scratch_path

#: Lists of blocks up to this many rows are sent to all tasks; longer ones are joined.
BROADCAST_BLOCKS = 500_000
OBJECT, BLANK, MALFORMED, NON_OBJECT = "object", "blank", "malformed", "non_object"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the place each one holds: file, block and place in the block.

    The place is the row counter of the scan task, which grows along a block;
    it is exact as long as nothing is filtered before it is taken.
    """
    lines = spark.read.text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def classify(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add the parsed value ``v`` and the ``status`` of each line.

    Text that is no JSON at all is malformed; JSON that is not an object is
    counted apart. Lines that fail for the bare literals NaN and Infinity are parsed
    once more by a reader that knows these numbers.
    """
    text = F.col(value)
    may_hold = text.rlike("NaN|Infinity") & text.rlike(r"(NaN|Infinity|[\]}])\s*$")
    again = F.when(may_hold, F.from_json(text, "variant", {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}))
    parsed = computed_once(lines, "v", F.coalesce(F.try_parse_json(text), again))
    status = (
        F.when(missing_or_blank(text), F.lit(BLANK))
        .when(F.col("v").isNull(), F.lit(MALFORMED))
        .when(text.rlike(r"(?U)^\s*\{"), F.lit(OBJECT))
        .otherwise(F.lit(NON_OBJECT))
    )
    return parsed.withColumn("status", status)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return classify(read_lines(spark, path))


def objects(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("status") == OBJECT)


def status_counts(classified: DataFrame) -> DataFrame:
    """One row: physical, blank, malformed, non-object and object lines."""
    def of(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1))

    return classified.agg(
        F.count(F.lit(1)).alias("physical_lines"), of(BLANK).alias("blank_lines"),
        of(MALFORMED).alias("malformed_json_count"), of(NON_OBJECT).alias("non_object_json_count"),
        of(OBJECT).alias("valid_object_count"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """Rows, first place and rows before, of each block; one pass over the lines, written once.

    Offsets are summed up within each file; across files one row per file is
    summed, and the driver lists the files of an input anyway.
    """
    counted = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("start"))
    counted = _kept(counted, "blocks")
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("file").orderBy("block").rowsBetween(*earlier)
    files = counted.groupBy("file").agg(F.sum("rows").alias("rows"))
    files = files.select("file", F.coalesce(F.sum("rows").over(Window.orderBy("file").rowsBetween(*earlier)), F.lit(0)).alias("before_file"))
    placed = counted.withColumn("before_block", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(files, "file")
    return _kept(placed.select("file", "block", "rows", "start", (F.col("before_file") + F.col("before_block")).alias("before")), "block-offsets")


def _kept(table: DataFrame, name: str) -> DataFrame:
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _with_blocks(lines: DataFrame, blocks: DataFrame, how: str) -> DataFrame:
    return lines.join(F.broadcast(blocks) if blocks.count() <= BROADCAST_BLOCKS else blocks, ["file", "block"], how)


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in physical order, numbered from 1 in ``line_no``.

    Only blocks that start before row ``n`` are kept. The lines are read twice, so lines of files
    should come from :func:`stored_lines`.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    needed = _blocks(lines).filter(F.col("before") < n).select("file", "block", "before")
    inside = Window.partitionBy("file", "block").orderBy("place")
    numbered = _with_blocks(lines, needed, "inner").withColumn("line_no", F.col("before") + F.row_number().over(inside))
    return numbered.filter(F.col("line_no") <= n).drop("before")


def stored_lines(lines: DataFrame) -> DataFrame:
    """The lines with their places, written once: every later reading has the same blocks and places, however
    the session cuts files by then."""
    return _kept(lines, "lines")


def number_lines(lines: DataFrame) -> DataFrame:
    """All physical lines with their line number.

    Only for unfiltered lines: inside a block the places are then consecutive,
    so a line's number follows from the first place of its block. The lines are written once and
    numbered from that copy, so their number does not depend on how often, or in what blocks, the input is cut later. The table of
    blocks is sent to the lines where its measured size allows it.
    """
    kept = stored_lines(lines)
    line_no = F.col("before") + F.col("place") - F.col("start") + 1
    return _with_blocks(kept, _blocks(kept), "inner").withColumn("line_no", line_no).drop("before", "start", "rows")


def first_valid(classified: DataFrame, n: int) -> DataFrame:
    """The first ``n`` object lines; fails when the input has fewer."""
    found = first_lines(objects(classified), n)
    total = found.count()
    if total != n:
        raise ValueError(f"the source has {total} valid objects, {n} are required")
    return found


def malformed_examples(numbered: DataFrame, n: int = 5) -> DataFrame:
    """Line numbers of the first malformed lines, with the class of the error."""
    bad = numbered.filter(F.col("status") == MALFORMED)
    return bad.orderBy("line_no").limit(n).select("line_no", F.lit("invalid_json").alias("error"))
