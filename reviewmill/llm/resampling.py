"""Importance resampling towards a target: hashed n-gram counts of both sides give every document a weight to be drawn by."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from reviewmill.llm.common import stored

#: Longest run of words that is a feature, and number of hash buckets.
LONGEST = 1
BUCKETS = 10_000
#: Fewest words of a document that may be drawn, and the share of those that is.
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: The byte set between texts; no word holds it.
SENTINEL = b"\x00"
#: In UTF-8: digits, a-z and all bytes of characters beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words whose places and hashes are held at a time.
STEP = 1 << 18
#: Columns that ``weighed`` adds to the struct ``row`` of carried columns.
ADDED = ("n_words", "n_features", "weight", "score")


def features(texts: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text, features of every text, and the buckets of all features, text by text.

    The texts are joined with sentinels and A-Z is lower-cased; one pass of the pattern finds all
    words of the batch. ``searchsorted`` of their places in the offsets of the texts
    tells the text of a word, and runs whose first and last word differ in it are masked.
    """
    joined = SENTINEL.join(texts).lower()
    offsets = np.cumsum([0] + [len(x) + len(SENTINEL) for x in texts[:-1]]) if texts else np.zeros(0, np.int64)
    n_words, n_features = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    found, owners = [], []
    matches = WORD.finditer(joined)
    words, owner = [], np.zeros(0, np.int64)
    while chunk := list(islice(matches, STEP)):
        kept = len(words)  # the last words of the chunk before, which runs into this one may begin with
        words += [m[0] for m in chunk]
        places = np.fromiter((m.start() for m in chunk), np.int64, len(chunk))
        owner = np.r_[owner, np.searchsorted(offsets, places, side="right") - 1]
        n_words += np.bincount(owner[kept:], minlength=len(texts))
        sums = [0] * len(words)
        for run in range(1, longest + 1):
            # Bucket of the run that ends at each word: that of the run one shorter, continued.
            if run == 1:
                sums = list(map(zlib.crc32, words))
            else:
                sums = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(sums[:-1], words[run - 1:])]
            ends = np.arange(run - 1, len(words))
            fresh = (ends >= kept) & (owner[ends] == owner[ends - run + 1])
            found.append((np.array(sums, np.uint32)[fresh] % np.uint32(buckets)).astype(np.int32))
            owners.append(owner[ends][fresh])
        words, owner = (words[1 - longest:], owner[1 - longest:]) if longest > 1 else ([], owner[:0])
    if not found:
        return n_words, n_features, np.zeros(0, np.int32)
    buckets_found, owners_found = np.concatenate(found), np.concatenate(owners)
    if len(found) > 1:
        order = np.argsort(owners_found, kind="stable")
        buckets_found, owners_found = buckets_found[order], owners_found[order]
    return n_words, np.bincount(owners_found, minlength=len(texts)).astype(np.int64), buckets_found


def hashed(table: DataFrame, carried: tuple[str, ...], text_col: str, longest: int, buckets: int) -> DataFrame:
    """``row`` (a struct of the carried columns), ``n_words`` and ``features`` (array of buckets) of every row."""
    cut = table.select(F.struct(*carried).alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    schema = StructType([cut.schema["row"], StructField("n_words", LongType()), StructField("features", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, found = features(batch.column(1).to_pylist(), longest, buckets)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_features)], pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), lists], schema.names)

    return cut.mapInArrow(run, schema)


def counted(rows: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n`` over all ``features`` of ``rows``; a task adds its own up first and hands on one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(held[met])], ["bucket", "n"])

    return rows.select("features").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For every bucket, a thousand times the log of how much likelier the target has it than the source, floored.

    Both sides are ``bucket, n``; every bucket counts one more than it was met.
    The list has ``buckets`` numbers, which is all that ever reaches the driver.
    """
    sides = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), F.col("n")))
    met = sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    rows = np.array([(r.bucket, r.s, r.t) for r in met.collect()], np.int64).reshape(-1, 3)
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[rows[:, 0]], t[rows[:, 0]] = rows[:, 1], rows[:, 2]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def chance(id_col: Column, seed: str) -> Column:
    """Floored thousandfold Gumbel number of an identifier; a null one counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighed(documents: DataFrame, target: DataFrame, carried: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text",
            longest: int = LONGEST, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """``row`` (a struct of the ``carried`` columns), ``n_words, n_features, weight, score`` of every document.

    ``weight`` is the floored mean of the gains of its features (0 without any), ``score`` adds its chance,
    so that the highest scores are a draw without replacement by weight. Counts cover
    all rows and whole texts of both tables. Null and empty texts have no features;
    repeated rows count and are scored as often as they occur; names of other columns do not matter.
    """
    rows = stored(hashed(documents, tuple(dict.fromkeys((*carried, id_col))), text_col, longest, buckets), "resample-features")
    aims = counted(hashed(target, (target.columns[0],), text_col, longest, buckets), buckets)
    values = gains(counted(rows, buckets), aims, buckets)
    schema = StructType([rows.schema["row"], *[StructField(c, LongType()) for c in ADDED[:3]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(values, np.int64)
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.r_[0, np.cumsum(gain[batch.column(2).flatten().to_numpy(zero_copy_only=False)])]
            ends = np.cumsum(sizes)
            weight = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(weight)], schema.names)

    return rows.mapInArrow(run, schema).withColumn("score", F.col("weight") + chance(F.col("row")[id_col], seed))


def drawn(scored: DataFrame, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 in descending order of score for the drawn rows, null for the others.

    Drawn are ``percent`` of 100, rounded down, of the rows with ``least_words`` or more, ties
    to the smaller identifier, null ones last. A count of rows by score gives the score that the draw ends at;
    only rows from there on are sorted, over all tasks. A row's rank is its place in
    its range plus the rows of the ranges before, so no group of equal scores or rows is in one task.
    """
    table = stored(scored, "resample-scores")
    fit = F.col("n_words") >= least_words
    # Scores are whole numbers of a bounded range, so the count by score is small whatever the input.
    tally = table.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    upto = tally.select("score", F.sum("n").over(Window.orderBy(F.col("score").desc())).alias("upto"))
    quota = (table.filter(fit).count() * percent) // 100
    last = upto.filter(F.col("upto") >= quota).agg(F.max("score")).first()[0] if quota else None
    if last is None:
        return table.withColumn("rank", F.lit(None).cast("long"))
    inside = fit & (F.col("score") >= last)
    order = [F.col("score").desc(), F.col("row")[id_col].asc_nulls_last()]
    dealt = table.filter(inside).repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "resample-order")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each range.
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = placed.withColumn("part", part).join(sizes.select("part", ahead.alias("ahead")), "part")
    rank = F.col("ahead") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    chosen = ranks.select(*table.columns, F.when(rank <= quota, rank).alias("rank"))
    return chosen.union(table.filter(~inside).withColumn("rank", F.lit(None).cast("long")))


def resampled(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST,
              buckets: int = BUCKETS, seed: str = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The drawn rows of ``documents`` with all their columns, then ``resample_weight, resample_score, resample_rank``.

    Columns of these names are replaced. An empty target or an empty table of documents is valid: the former
    leaves the draw to the counts of the source, the latter gives no row.
    """
    added = ("resample_weight", "resample_score", "resample_rank")
    carried = tuple(c for c in documents.columns if c not in added)
    scored = weighed(documents, target, carried, id_col, text_col, longest, buckets, seed)
    taken = drawn(scored, id_col, percent, least_words).filter("rank is not null")
    return taken.select(*[F.col("row")[c].alias(c) for c in carried], *[F.col(c.removeprefix("resample_")).alias(c) for c in added])
