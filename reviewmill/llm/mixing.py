"""Mixing sources to target weights by hash thresholds; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import WORD, stored

#: Weights of the sources in code-point order, repeated as needed.
WEIGHTS = (1, 2, 3)
#: A target is at most this many times the words of its source, and a document is taken as often at most.
MOST_COPIES = 3
#: Hexadecimal digits of the hash that one level of the histogram tells apart, and levels.
DIGITS = 3
LEVELS = 4


def sized(documents: DataFrame, id_col: str, text_col: str, source_col: str, carried: list[str] | None = None) -> DataFrame:
    """``id, source, size, code`` of every row; the code is a hash of identifier and text. ``row`` holds carried columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text))).alias("code"),
        *([F.struct(*carried).alias("row")] if carried else []))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` of every source.

    Targets share the words of all sources by weight; a target stops at ``most``
    times its source, and the excess is shared anew by weight until none is above.
    The end of this resharing has a closed form: in the order of limit by weight,
    the first sources stand at their limits, the others share the rest. One row
    per source is all that the two windows over sources see.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")).cast("long")
    ranked = totals.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("limit"))
    order = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    shares = ranked.withColumn("left", left).withColumn("heavy", F.sum("weight").over(after))
    capped = F.col("left") * F.col("weight") >= F.col("limit") * F.col("heavy")
    shares = shares.withColumn("capped", capped)
    # The first source below its limit fixes the share of all that follow.
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "left", "heavy"))).over(everything)
    shares = shares.withColumn("first", first)
    share = F.col("first.left").cast("double") * F.col("weight") / F.col("first.heavy")
    return shares.select("source", "source_size", F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``id_col, size, source_size, target, taken`` of every row of ``documents``.

    Every document of a source is taken as often as the target holds the whole
    source; the rest of the target takes one more copy of the documents whose hash
    lies below a threshold. Thresholds come from histograms: words are summed by
    source and hash bucket, running sums find the bucket in which the rest ends,
    and only that bucket is divided again by further digits. After the last level
    the bucket, which holds one document or rows equal in identifier and text, is
    taken if that brings the sum nearer to the target. No row is sorted, no source
    is gathered in one task, and the same input always gives the same mix.

    A null text has size 0; sources sort by code point with null last, as a
    source of its own; a source without words has target 0; repeated rows are
    taken alike; extra columns are not carried; an empty table gives no rows.
    """
    rows = stored(sized(documents, id_col, text_col, source_col), "mix-sizes")
    return _taken(rows, thresholds(rows, weights, most)).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``documents`` that ``mix`` takes, all columns, with ``taken_words`` and ``taken_copies``.

    Columns of these two names are replaced. Texts without words are never taken.
    """
    limits = thresholds(stored(sized(documents, id_col, text_col, source_col), "mix-sizes"), weights, most)
    carried = [c for c in documents.columns if c not in ("taken_words", "taken_copies")]
    rows = sized(documents, id_col, text_col, source_col, carried)
    return _taken(rows, limits).filter("taken > 0").select(
        *[F.col(f"row.{c}") for c in carried], F.col("taken").alias("taken_words"), (F.col("taken") / F.col("size")).cast("int").alias("taken_copies"))


def thresholds(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: its target, the copies taken of all its documents, and the hash up to which one more is."""
    goals = stored(targets(rows, weights, most), "mix-targets")
    whole = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(most)).cast("long")
    state = goals.select("*", whole.alias("whole")).select(
        "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"), F.lit("").alias("edge"))
    for level in range(1, LEVELS + 1):
        state = stored(_refined(rows, state, level), f"mix-level-{level}")
    return state.select("source", "source_size", "target", "whole", "edge", "take_edge")


def _taken(rows: DataFrame, limits: DataFrame) -> DataFrame:
    digits = F.substring("code", 1, DIGITS * LEVELS)
    extra = (digits < F.col("edge")) | (F.col("take_edge") & (digits == F.col("edge")))
    return _by_source(rows, limits).withColumn("taken", F.col("size") * (F.col("whole") + extra.cast("long")))


def _by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Null-safe join on the source; its small side is broadcast where its measured size allows it."""
    other = table.withColumnRenamed("source", "__source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def _refined(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """One more level of the histogram within the edge bucket of every source.

    ``rest`` is what the target still holds at the start of the edge bucket;
    ``edge`` gets the digits of the bucket in which it ends, or of the last one.
    """
    begun = DIGITS * (level - 1)
    inside = _by_source(rows, state.select("source", "edge")).filter(F.substring("code", 1, begun) == F.col("edge"))
    sums = inside.groupBy("source", F.substring("code", 1, DIGITS * level).alias("bucket")).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket")
    upto = sums.withColumn("upto", F.sum("words").over(run))
    known = state.select("source", "source_size", "target", "whole", "rest")
    joined = _by_source(upto, known)
    crossing = F.col("upto") > F.col("rest")
    ends = joined.groupBy("source").agg(
        F.min(F.when(crossing, F.struct("bucket", "words", "upto"))).alias("cross"),
        F.max(F.struct("bucket", "words", "upto")).alias("last"),
        *[F.first(c).alias(c) for c in ("source_size", "target", "whole", "rest")])
    ends = ends.withColumn("at", F.coalesce("cross", "last"))
    rest = F.col("rest") - (F.col("at.upto") - F.col("at.words"))
    return ends.select("source", "source_size", "target", "whole", F.col("at.bucket").alias("edge"), rest.alias("rest"),
                       (F.col("at.words") <= 2 * rest).alias("take_edge"))
