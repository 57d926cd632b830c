"""Ranks and samples that no single task has to hold whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.text import preview
from reviewmill.settings import PREVIEW_CHARACTERS, SAMPLES_PER_LABEL


def top_n_per_group(table: DataFrame, group: str, order: list[Column], n: int, spread_by: str,
                    rank: str = "rank", buckets: int = 64) -> DataFrame:
    """First ``n`` rows of every group with their rank.

    Groups may hold most of the table, so each is first cut to ``n`` rows in
    ``buckets`` independent parts; the final rank sees ``n * buckets`` rows at
    most. The result is exact.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(buckets))
    parted = table.withColumn("_part", part)
    within = Window.partitionBy(group, "_part").orderBy(*order)
    kept = parted.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= n).drop(rank, "_part")
    ranked = kept.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def review_samples(view: DataFrame, n: int = SAMPLES_PER_LABEL, characters: int = PREVIEW_CHARACTERS,
                   text: str = "review_text_clean") -> DataFrame:
    """Most confident reviews of every label as short previews, without user or full text."""
    shown = view.select(
        F.sha2(F.concat_ws("|", "load_batch_id", "model_version", "review_key"), 256).alias("sample_id"),
        "parent_asin", "product_title", "main_category", "rating", "pred_label", "pred_score",
        preview(text, characters).alias("review_text_preview"),
        F.length(text).cast("bigint").alias("text_length"),
        "review_time",
    )
    order = [F.col("pred_score").desc(), F.col("sample_id").asc()]
    return top_n_per_group(shown, "pred_label", order, n, spread_by="sample_id", rank="sample_rank")


def distributed_rank(table: DataFrame, group: str, key: str, seed: int, rank: str = "rank",
                     total: str | None = None, slices: int = 65_536) -> DataFrame:
    """Exact 1-based rank inside each group in the order of a seeded hash.

    The hash space is cut into ``slices``; a row's rank is the number of rows in
    the lower slices plus its place in its own slice, so a group of any size is
    shared by all tasks. Only the slice counts, at most ``slices`` rows per
    group value, are ordered and joined back. A null group ranks like any other.
    ``total`` names a column for the
    size of the group.
    """
    hashed = table.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))).withColumn("_slice", _slice(slices))
    counts = hashed.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_size")
    )
    place = F.row_number().over(Window.partitionBy(group, "_slice").orderBy("_h", key))
    offsets = offsets.withColumnsRenamed({group: "_group", "_slice": "_of_slice"})
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of_slice"))
    joined = hashed.withColumn("_place", place).join(offsets, same).drop("_group", "_of_slice")
    ranked = joined.withColumn(rank, (F.col("_before") + F.col("_place")).cast("bigint"))
    if total is not None:
        ranked = ranked.withColumn(total, F.col("_size"))
    return ranked.drop("_h", "_slice", "_place", "_before", "_size")


def _slice(slices: int) -> Column:
    """Slice number that grows with the hash, so that slices are ordered like it."""
    bits = slices.bit_length() - 1
    if slices != 1 << bits:
        raise ValueError("slices must be a power of two")
    return F.shiftright("_h", 64 - bits)


def uniform_sample(table: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash: uniform, and the same on every run."""
    return table.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)
