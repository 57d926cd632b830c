"""Digests of a table by ranges of its key, so that a recheck names what differs and rereads no more than that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.joins import by_merge
from reviewmill.session import scratch_path

#: Hexadecimal digits of the key's hash that make a range, from the coarse level to the fine one.
LEVELS = (1, 3)
#: Differing fingerprints, of 16 bytes each, up to which they are sent to the rows.
BROADCAST_ROWS = 1_000_000


def _hash(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def row_digest(table: DataFrame) -> Column:
    """Number of 60 bits that stands for all columns of a row, by name; null and empty differ."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in sorted(table.columns)]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cells).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def _fingerprints(table: DataFrame, key: str, levels: tuple[int, ...]) -> DataFrame:
    """``key_range, h, d`` for every row: its finest range, a hash of the key and the row's digest; none as wide as the key itself."""
    return table.select(F.substring(_hash(key), 1, levels[-1]).alias("key_range"), F.xxhash64(F.col(key).cast("string")).alias("h"), row_digest(table).cast("long").alias("d"))


def _summed(rows: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    fine = rows.groupBy("key_range").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("d").cast("decimal(38,0)")).alias("digest"))
    cut = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.substring("key_range", 1, n).alias("key_range")) for n in levels]))
    rows = fine.select(cut.alias("at"), "row_count", "digest").groupBy("at.level", "at.key_range")
    return rows.agg(F.sum("row_count").alias("row_count"), F.sum("digest").cast("string").alias("digest"))


def digests(table: DataFrame, key: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``level, key_range, row_count, digest`` for every range of every level.

    The digest of a range is the sum of its rows' digests, so it does not depend on their order and sees
    copies. One pass makes the finest level; the coarser ones are sums of it.
    """
    return _summed(_fingerprints(table, key, levels), levels)


def differing_ranges(stated: DataFrame, found: DataFrame) -> DataFrame:
    """Ranges of the finest level whose count or digest differs; only below coarse ranges that differ are they compared."""
    finest = stated.agg(F.max("level")).first()[0] or found.agg(F.max("level")).first()[0] or LEVELS[-1]
    coarsest = stated.agg(F.min("level")).first()[0] or finest

    def differing(level: int, a: DataFrame, b: DataFrame) -> DataFrame:
        sides = [t.filter(F.col("level") == level).select("key_range", F.struct("row_count", "digest").alias(n)) for t, n in ((a, "stated"), (b, "found"))]
        return sides[0].join(sides[1], "key_range", "full").filter(~F.col("stated").eqNullSafe(F.col("found")))

    above = differing(coarsest, stated, found).select(F.col("key_range").alias("coarse"))
    inside = [t.join(above, F.substring("key_range", 1, coarsest) == F.col("coarse"), "left_semi") for t in (stated, found)]
    return differing(finest, *inside).select(
        "key_range", F.coalesce("stated.row_count", F.lit(0)).alias("stated_rows"), F.coalesce("found.row_count", F.lit(0)).alias("found_rows"))


def differing_rows(stated: DataFrame, found: DataFrame, key: str, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``key, stated_copies, found_copies`` of rows that one table has more often than the other.

    Only rows in ranges whose digests differ are compared, by digest. Fingerprints of the rows are written once; the digests are summed
    from them, and in ranges that differ they are counted. Only rows whose fingerprint one table has more often are read again with their keys.
    """
    prints = []
    for table in (stated, found):
        path = scratch_path(table.sparkSession, "fingerprints")
        _fingerprints(table, key, levels).write.parquet(path)
        prints.append(table.sparkSession.read.schema("key_range STRING, h BIGINT, d BIGINT").parquet(path))
    # One row for each finest range at most.
    ranges = F.broadcast(differing_ranges(*[_summed(p, levels) for p in prints]).select("key_range"))
    inside = [p.join(ranges, "key_range", "left_semi").select("h", "d", F.lit(n).alias("n")) for p, n in zip(prints, (1, -1))]
    more = inside[0].union(inside[1]).groupBy("h", "d").agg(F.sum("n").alias("n")).filter("n <> 0").select("h", "d")
    path = scratch_path(stated.sparkSession, "differing")
    more.write.parquet(path)
    more = stated.sparkSession.read.schema("h BIGINT, d BIGINT").parquet(path)
    more = F.broadcast(more) if more.count() <= BROADCAST_ROWS else by_merge(more)

    def counted(table: DataFrame, name: str) -> DataFrame:
        rows = table.select(F.col(key).alias("key"), F.xxhash64(F.col(key).cast("string")).alias("h"), row_digest(table).cast("long").alias("d"))
        return rows.join(more, ["h", "d"], "left_semi").groupBy("key", "d").agg(F.count(F.lit(1)).alias(name))

    a, b = counted(stated, "stated_copies"), counted(found, "found_copies").withColumnsRenamed({"key": "other", "d": "e"})
    joined = a.join(b, F.col("key").eqNullSafe(F.col("other")) & (F.col("d") == F.col("e")), "full")
    copies = [F.coalesce(c, F.lit(0)).alias(c) for c in ("stated_copies", "found_copies")]
    return joined.filter("stated_copies is null or found_copies is null or stated_copies <> found_copies") \
        .select(F.when(F.col("d").isNull(), F.col("other")).otherwise(F.col("key")).alias(key), *copies)
