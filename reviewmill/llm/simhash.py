"""SimHash near-duplicates: majority fingerprints, compared bit-sliced within candidate blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reviewmill.llm.common import components, fresh, stored

SHINGLE = 3
SEED = 42
RADIUS = 2
#: The 64 bits in bands of 16. Two fingerprints at 2 or fewer differing bits agree on two of the four bands.
BANDS = 4
#: Larger candidate blocks are cut into parts of about this many fingerprints; all pairs of parts are compared.
PART_ROWS = 512
#: Lanes of one bit plane.
LANES = 8192
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text: a bit is set if over half of the shingle hashes have it."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    runs = zip(*(found[i:] for i in range(shingle))) if len(found) >= shingle else [found]
    digests = b"".join(map(partial(xxhash.xxh64_digest, seed=SEED), map(b" ".join, runs)))
    hashes = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), STEP):
        counts += np.unpackbits(hashes[at:at + STEP], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(documents: DataFrame, carried: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``carried`` columns and the ``fingerprint`` (long) of every row; a null, empty or blank text has fingerprint 0."""
    table = documents.select(*carried, F.col(text_col).alias("text of the row"))
    schema = StructType([*table.schema.fields[:-1], StructField("fingerprint", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([fingerprint(x) for x in batch.columns[-1].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], marks], [*carried, "fingerprint"])

    return table.mapInArrow(run, schema)


def close_lanes(marks: np.ndarray, groups: np.ndarray, sides: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Pairs of lanes of one group (sorted) whose fingerprints differ in ``radius`` bits at most.

    Bit planes stand vertically: plane ``b`` is an integer whose bit ``i`` is bit
    ``b`` of lane ``i``. A plane XOR itself shifted by ``d`` compares every lane
    with the one ``d`` further on. Differences go into a carry-save counter, one
    integer per binary digit and one for lanes beyond the radius; the block is
    abandoned once no lane is left within. Lanes of another group, or of the same
    side in a comparison of two parts, count as beyond from the start.
    """
    def plane(flags: np.ndarray) -> int:
        return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")

    planes = [plane((marks >> np.uint64(b)) & np.uint64(1)) for b in range(64)]
    digits = (radius + 1).bit_length()
    widest = int(np.diff(np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])).max())
    for d in range(1, widest):
        live = plane((groups[d:] == groups[:-d]) & ((sides[d:] != sides[:-d]) | (sides[d:] < 0)))
        counter = [0] * digits
        for p in planes:
            if not live:
                break
            carry = (p ^ (p >> d)) & live
            for k in range(digits):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            # Lanes whose count equals radius + 1 leave at once, so no digit ever overflows.
            beyond = live
            for k in range(digits):
                beyond &= counter[k] if (radius + 1) >> k & 1 else ~counter[k]
            live &= ~beyond
        while live:
            low = live & -live
            i = low.bit_length() - 1
            yield i, i + d
            live ^= low


def _forest(marks: np.ndarray, groups: np.ndarray, sides: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a chunk, without those between lanes that are connected already: as many as lanes at most."""
    root = list(range(len(marks)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, j in close_lanes(marks, groups, sides, radius):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def links(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fingerprint`` values within ``radius`` (2 at most).

    Candidates share two of the four bands. A block of candidates beyond
    ``PART_ROWS`` is cut into parts and every pair of parts becomes a unit of its
    own, so that no task ever holds a whole block. Links inside a unit that add
    no connection are left out.
    """
    if not 0 <= radius <= BANDS - 2:
        raise ValueError(f"radius must lie between 0 and {BANDS - 2}")
    width = 64 // BANDS
    band = [F.shiftrightunsigned("fingerprint", width * i).bitwiseAND((1 << width) - 1) for i in range(BANDS)]
    keys = F.array(*[
        F.lit(n << 2 * width).bitwiseOR(F.shiftleft(band[i], width)).bitwiseOR(band[j])
        for n, (i, j) in enumerate(combinations(range(BANDS), 2))])
    rows = marks.select("fingerprint", F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parted = rows.join(sizes, "key").withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int")) \
        .withColumn("slot", F.expr("cast(pmod(xxhash64(fingerprint), parts) as int)")) \
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    units = parted.select(
        "key", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"),
        F.when(F.col("slot") == F.col("other"), -1).when(F.col("slot") < F.col("other"), 0).otherwise(1).alias("side"),
        "fingerprint")
    dealt = units.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def compare(columns: list[np.ndarray]) -> pa.RecordBatch:
        key, low, high, side, mark = columns
        new = np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
        found = _forest(mark.view(np.uint64), np.cumsum(new), side, radius)
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(mark[ends[:, 0]]), pa.array(mark[ends[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            while len(held[0]) > LANES:
                key, low, high = held[:3]
                last = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
                if not len(last):
                    break
                cut = int(last[last <= LANES][-1]) if last[0] <= LANES else int(last[0])
                yield compare([c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield compare(held)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id_col, fingerprint, component_id`` of every row of ``documents``.

    Fingerprints within ``radius`` differing bits are linked; the component is the
    smallest identifier that links reach. Equal fingerprints are counted as one
    node however many rows have them. Texts that are null, empty or blank have
    fingerprint 0 and are linked like any other. Rows with a null identifier are
    returned and get their component; a component of such rows only is null.
    Repeated rows are returned as often as they occur, extra columns are not
    carried, an empty table gives an empty result.
    """
    marks = stored(fingerprints(documents, (id_col,), text_col), "fingerprints")
    rooted = _rooted(marks, id_col, radius)
    firsts = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(firsts, "component").select("fingerprint", "component_id"), "fingerprint-components")
    return marks.join(named, "fingerprint").select(
        id_col, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def _rooted(marks: DataFrame, first: str | Column, radius: int) -> DataFrame:
    """``fingerprint, first, component`` of every distinct fingerprint; ``first`` is its least value of that column."""
    nodes = stored(marks.groupBy("fingerprint").agg(F.min(first).alias("first")), "fingerprint-nodes")
    parts = components(links(nodes.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    return nodes.join(parts, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of every component of ``near_duplicates``, all columns: that with the smallest identifier.

    Null identifiers come last; of rows that share the smallest one the choice goes
    by a hash of all columns, and of rows equal in all columns one stays. Null, empty and blank texts form one
    group; extra columns are carried whatever their names; an empty table stays empty.
    """
    row, = fresh(documents, "row")
    keyed = documents.withColumn(row, F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in documents.columns]))
    marks = stored(fingerprints(keyed, (row, id_col), text_col), "fingerprints")
    rooted = _rooted(marks, F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row)), radius)
    kept = rooted.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first")[row].alias(row))
    return keyed.join(stored(kept, "near-duplicate-kept", (marks,)), row, "left_semi").dropDuplicates([row]).drop(row)
