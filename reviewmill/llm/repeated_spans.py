"""Removal of long repeated byte strings, by bucket-pointer refinement of sampled suffixes.

A suffix array over all bytes would shuffle many times the corpus. Here only
suffixes at anchors are bucketed: the anchor of a window of ``length`` bytes is
its leftmost q-gram of least hash, so equal windows, wherever they are, have
their anchor at the same place and fall into the same q-gram bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import stored

#: Bytes of a string that counts as repeated, and of the q-grams that the first buckets go by.
LENGTH = 400
GRAM = 64
#: Bytes of the first bucket identifiers within a bucket; each refinement doubles what they cover.
FIRST = 8
#: Bytes of a text handled at a time; parts overlap by a window.
SEGMENT = 1 << 19
#: Bytes refined at a time by one task, and bytes up to which a bucket is refined as a whole: some hundred MB of
#: memory. The windows of larger buckets are grouped across tasks.
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 3 << 20
#: Parts that all rows make when repeats are looked up: a class of windows with more rows than one of them is cut, fewer than ``HOT`` classes in all.
HOT = 1_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value of every byte; powers of the base and of its inverse."""
    values = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    n = SEGMENT + (1 << 13)
    with np.errstate(over="ignore"):
        return values, np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)]), np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _sums(data: np.ndarray) -> np.ndarray:
    values, powers, _ = _tables()
    return np.r_[np.uint64(0), np.cumsum(values[data] * powers[:len(data)])]


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]``, the same wherever the bytes stand."""
    return _mixed((sums[end] - sums[start]) * _tables()[2][start])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays ``low, at, high, bucket, whole`` by part of ``data``.

    The windows that start from ``low`` to ``high`` have their anchor at ``at``;
    ``bucket`` hashes its q-gram, ``whole`` all bytes of these windows and the place
    of the anchor in them.
    """
    everything = np.frombuffer(data, dtype=np.uint8)
    width = length - gram + 1
    for begin in range(0, len(everything) - length + 1, SEGMENT):
        part = everything[begin:begin + SEGMENT + length - 1]
        sums = _sums(part)
        grams = _hash(sums, np.arange(len(part) - gram + 1), np.arange(gram, len(part) + 1))
        # The place stands in the low bits, so that the least key is the leftmost of equal hashes.
        key = grams & ~np.uint64((1 << 20) - 1) | np.arange(len(grams), dtype=np.uint64)
        blocks = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max)
        blocks[:len(key)] = key
        blocks = blocks.reshape(-1, width)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - length + 1
        place = (np.minimum(after[:n], before[width - 1:width - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        low = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        high = np.r_[low[1:], n] - 1
        at = place[low]
        whole = _hash(sums, low, high + length) ^ _mixed(((at - low) << 32 | (high - low)).astype(np.uint64))
        yield begin + low, begin + at, begin + high, grams[at].view(np.int64), whole.view(np.int64)


def refined(members: list[bytes], buckets: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window start of every member whether another one of its bucket begins the same ``length`` bytes.

    ``starts`` counts the windows of each member, which begin at its first bytes.
    Bucket identifiers cover ``FIRST`` bytes and the bucket at the outset. A
    refinement sorts places by their own identifier and that of the place just
    behind what it covers, and numbers the pairs anew; the new identifiers serve
    the next one, until they cover all ``length`` bytes.
    """
    data = np.frombuffer(b"".join(members), dtype=np.uint8)
    sizes = np.array([len(m) for m in members])
    ends = np.cumsum(sizes)
    left = (np.repeat(ends, sizes) - np.arange(len(data))).astype(np.int32)
    owner = np.repeat(np.unique(buckets, return_inverse=True)[1], sizes)
    cover = min(FIRST, length)
    places = np.flatnonzero(left >= cover)
    value = np.zeros(len(places), dtype=np.uint64)
    for i in range(cover):
        value = value << np.uint64(8) | data[places + i]
    ids = np.zeros(len(data), dtype=np.int32)
    ids[places] = np.unique(owner[places] * (len(places) + 1) + np.unique(value, return_inverse=True)[1], return_inverse=True)[1]
    del value, owner
    while cover < length:
        step = min(cover, length - cover)
        places = np.flatnonzero(left >= cover + step)
        pairs = ids[places] * np.int64(len(data) + 1) + ids[places + step]
        ids = np.zeros(len(data), dtype=np.int32)
        ids[places] = np.unique(pairs, return_inverse=True)[1]
        cover += step
    firsts = np.repeat(ends - sizes, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    final = ids[firsts]
    return np.bincount(final, minlength=1)[final] > 1


def _runs(flags: np.ndarray, low: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(low + int(a), low + int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def _repeated(rows: DataFrame, counts: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose key ``on`` has ``n`` beyond one in ``counts``.

    A key that would fill a task by itself, as a passage in most documents gives, is cut into parts of about as many
    rows each; the few such keys go out by broadcast to the rows.
    """
    size = max(1, (counts.agg(F.sum("n")).first()[0] or 0) // HOT)
    repeated = counts.filter("n > 1").select(*on, F.ceil(F.col("n") / size).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("row", "low"), F.col("parts")), F.lit(0))
    parted = rows.join(F.broadcast(repeated.filter("parts > 1")), on, "left").withColumn("part", part).drop("parts")
    every = repeated.select(*on, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return parted.join(every, [*on, "part"])


def _contexts(documents: DataFrame, open_classes: DataFrame, length: int) -> DataFrame:
    """Bytes of all windows of one member of every open class, with its bucket."""
    wanted = open_classes.groupBy("row").agg(F.collect_list(F.struct("low", "at", "high", "bucket", "size", "single")).alias("wanted"))
    table = documents.join(wanted, "row").select("row", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode("utf-8", "surrogatepass")
                rows += [(w["bucket"], w["size"], w["single"], row, w["low"], w["at"], data[w["low"]:w["high"] + length]) for w in wanted]
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                             ["bucket", "size", "single", "row", "low", "at", "bytes"])

    return table.mapInArrow(run, "bucket long, size long, single boolean, row long, low long, at long, bytes binary")


def _refined_spans(contexts: DataFrame, length: int) -> DataFrame:
    """``row, low, high`` of repeated window starts of single members; a task refines whole buckets, many at a time."""
    def spans(held: list[tuple]) -> pa.RecordBatch:
        starts = np.array([len(h[4]) - length + 1 for h in held])
        flags = refined([h[4] for h in held], np.array([h[0] for h in held]), starts, length)
        found, at = [], 0
        for (_, single, row, low, _), n in zip(held, starts):
            if single:
                found += [(row, *run) for run in _runs(flags[at:at + n], low)]
            at += n
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["row", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for member in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size > CHUNK_BYTES and member[0] != held[-1][0]:
                    yield spans(held)
                    held, size = [], 0
                held.append(member)
                size += len(member[4])
        if held:
            yield spans(held)

    dealt = contexts.select("bucket", "single", "row", "low", "bytes").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "row long, low long, high long")


def _grouped_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for buckets of any size: a row per window, grouped by bucket, place of the anchor and hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, single, row, low, at, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                part = np.frombuffer(data, dtype=np.uint8)
                first = np.arange(len(part) - length + 1)
                marks = _hash(_sums(part), first, first + length).view(np.int64)
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, bucket)), pa.array(at - low - first), pa.array(marks), pa.array([single] * n), pa.array(np.full(n, row)), pa.array(low + first)],
                    ["bucket", "ahead", "mark", "single", "row", "low"])

    rows = contexts.select("bucket", "single", "row", "low", "at", "bytes").mapInArrow(
        run, "bucket long, ahead long, mark long, single boolean, row long, low long")
    rows = stored(rows, "large-bucket-windows")
    window = ["bucket", "ahead", "mark"]
    counts = stored(rows.groupBy(*window).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "large-bucket-repeats")
    return _repeated(rows.filter("single"), counts, window).select("row", "low", F.col("low").alias("high"))


def repeated_starts(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row, low, high``: where strings of ``length`` bytes begin that also begin elsewhere; ``rows`` has ``row, text``."""
    names = ["row", "low", "at", "high", "bucket", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in anchors(text.encode("utf-8", "surrogatepass"), length, gram):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), row)), *map(pa.array, part)], names)

    found = stored(rows.mapInArrow(_gathered(run), ", ".join(f"{n} long" for n in names)), "anchors")
    place = F.struct("row", "low", "at", "high")
    classes = stored(found.groupBy("bucket", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")), "anchor-classes")
    closed = _repeated(found, classes, ["bucket", "whole"]).select("row", "low", "high")
    kinds = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("first.high") - F.col("first.low") + length).alias("size")).filter("members > 1")
    still_open = classes.join(kinds, "bucket").select("bucket", "size", (F.col("n") == 1).alias("single"), "first.*")
    contexts = stored(_contexts(rows, still_open, length), "contexts")
    small = _refined_spans(contexts.filter(F.col("size") <= BUCKET_BYTES), length)
    large = _grouped_spans(contexts.filter(F.col("size") > BUCKET_BYTES), length)
    return closed.union(small).union(large)


def _gathered(run, rows: int = 20_000):
    """Joins the many small batches that ``run`` yields."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if n:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return wrapped


def cut(data: bytes, spans: list[tuple[int, int]], length: int) -> tuple[bytes, int, int]:
    """What is left of ``data``, the number of bytes removed, and of maximal removed runs."""
    merged: list[list[int]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high + length)
        else:
            merged.append([low, high + length])
    edges = [0, *(e for m in merged for e in m), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return kept, len(data) - len(kept), len(merged)


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All rows as ``id_col, n_bytes, n_removed, n_spans, kept`` (bytes).

    A byte is removed if a string of ``length`` bytes that covers it also begins
    anywhere else, in the same document or another; strings are judged on the
    input. Classes of anchors whose windows have all bytes in common are settled by
    counting. The others in buckets of several classes are refined on their bytes:
    only those are shuffled, one member of each class, and a bucket of very many is
    grouped window by window instead, so no task ever holds a bucket of any size.

    A null text has no bytes; texts shorter than ``length`` lose nothing; a row that
    is repeated counts as another document, so both lose their long texts; null
    identifiers are no matter; extra columns are not carried; an empty table gives
    no rows. ``gram`` is at most ``length``.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram must lie between 1 and length")
    row = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    rows = documents.select(F.col(id_col), row.alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = repeated_starts(rows.select("row", "text").filter(F.octet_length("text") >= length), length, gram)
    spans = spans.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    table = rows.join(stored(spans, "repeated-spans"), "row", "left").select(id_col, "text", "spans")
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            done = [cut(t, [(s["low"], s["high"]) for s in spans or ()], length) for t, spans in zip(texts, batch.column(2).to_pylist())]
            columns = [pa.array([len(t) for t in texts], pa.int64()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)), pa.array([d[0] for d in done], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind_of_id = table.schema[0].dataType.simpleString()
    return table.mapInArrow(run, f"`{id_col}` {kind_of_id}, n_bytes long, n_removed long, n_spans long, kept binary")
