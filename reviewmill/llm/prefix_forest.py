"""Nearest neighbours by a hash-prefix forest: sorted arrays of long hash strings in every shard."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Trees of a shard's forest and binary digits of their hash strings.
TREES = 32
DIGITS = 24
#: Rows of a shard, the unit that one task holds.
SHARD_ROWS = 4096
#: Share of a shard's rows that a query must have met before the ascent ends. Vectors without any
#: structure need about this share for a recall of 0.9; clustered ones reach it with far less.
SHARE = 0.65
#: Rows that a query meets at least, in shards that have as many.
LEAST_MET = 400
NEAREST = 10
SEED = 20_011


@cache
def _planes(dim: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim, trees * DIGITS))


class Forest:
    """Forest of one shard. Every digit halves the shard at the median of a random projection."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES):
        self.ids, self.vectors, self.trees = ids, vectors, trees
        projected = vectors @ _planes(vectors.shape[1], trees)
        self.medians = np.median(projected, axis=0)
        codes = self._codes(projected)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=0)

    def _codes(self, projected: np.ndarray) -> np.ndarray:
        digits = (projected > self.medians).reshape(len(projected), self.trees, DIGITS)
        return digits @ (1 << np.arange(DIGITS - 1, -1, -1, dtype=np.int64))

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) by tree, matched prefix length and query."""
        codes = self._codes(queries @ _planes(queries.shape[1], self.trees))
        first = np.empty((self.trees, DIGITS + 1, len(queries)), dtype=np.int64)
        last = np.empty_like(first)
        for tree in range(self.trees):
            for length in range(DIGITS + 1):
                free = (1 << (DIGITS - length)) - 1
                first[tree, length] = np.searchsorted(self.codes[:, tree], codes[:, tree] & ~free, "left")
                last[tree, length] = np.searchsorted(self.codes[:, tree], codes[:, tree] | free, "right")
        return first, last

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> list[tuple[int, int, float]]:
        """``query, vector, distance`` of the ``k`` nearest rows met, ties to the smaller identifier.

        Each query descends every tree to its longest matching prefix; then all
        trees ascend together, one digit at a time, until the rows met by any of
        them are enough. Equal vectors have equal hash strings and are met together.
        """
        first, last = self.ranges(queries)
        wanted = min(len(self.ids), max(int(share * len(self.ids)), LEAST_MET))
        counts = (last - first).sum(axis=0)
        found = []
        for i, own in enumerate(query_ids):
            length = int(np.flatnonzero(counts[:, i] >= wanted)[-1])
            while True:
                met = np.zeros(len(self.ids), dtype=bool)
                for tree in range(self.trees):
                    met[self.order[first[tree, length, i]:last[tree, length, i], tree]] = True
                if length == 0 or met.sum() >= wanted:
                    break
                length -= 1
            rows = np.flatnonzero(met & (self.ids != own))
            gaps = self.vectors[rows] - queries[i]
            distance = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
            if len(rows) > k:
                kept = distance <= np.partition(distance, k - 1)[k - 1]
                rows, distance = rows[kept], distance[kept]
            best = np.lexsort((self.ids[rows], distance))[:k]
            found += [(int(own), int(self.ids[r]), float(d)) for r, d in zip(rows[best], distance[best])]
        return found


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector, dim`` of the rows that take part, components as doubles."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.size(vector).alias("dim"))
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & (F.col("dim") > 0) & ~broken & F.exists("vector", lambda x: x != 0))


def search(vectors: DataFrame, query_modulus: int = 100, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding",
           trees: int = TREES, share: float = SHARE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for every query.

    Queries are the rows whose identifier is divisible by ``query_modulus``, all
    other rows are candidates. Score is the Euclidean distance in doubles, ties go
    to the smaller identifier. All rows are dealt to shards by a hash of their
    identifier, every shard indexes all of its rows, and the query set is compared
    with each shard as a stream; a task holds one shard, never a group of equal
    vectors. The best of every shard are merged by query.

    Vectors that are null, empty, zero or hold a null or non-finite component take
    no part, nor do rows with a null identifier; vectors of other length are never
    compared. Of rows that repeat an identifier the smallest vector counts. Fewer
    candidates than ``k`` are all returned; a table without queries or candidates
    gives no rows; extra columns are not carried.
    """
    rows = usable(vectors, id_col, vector_col)
    shards = max(1, -(-rows.count() // shard_rows))
    shard = F.expr(f"cast(pmod(xxhash64(id), {shards}) as int)")
    stored_rows = rows.select("dim", shard.alias("shard"), F.lit(0).alias("kind"), "id", "vector")
    queries = rows.filter(F.col("id") % query_modulus == 0).select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "vector")
    dealt = stored_rows.union(queries).repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id", "vector")
    schema = "query_id long, vec_id long, score double"
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, parts, forest, last_query = None, [], [], None, None
        for batch in batches:
            dims, numbers, kinds, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            flat, offsets = batch.column(4).flatten().to_numpy(), np.asarray(batch.column(4).offsets) - batch.column(4).offsets[0].as_py()
            edges = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1]), True])
            for a, b in zip(edges[:-1], edges[1:]):
                if (place := (dims[a], numbers[a])) != at:
                    at, ids, parts, forest, last_query = place, [], [], None, None
                table = flat[offsets[a]:offsets[b]].reshape(b - a, int(dims[a]))
                if kinds[a] == 0:
                    ids.append(own[a:b])
                    parts.append(table)
                    continue
                if not ids:
                    continue
                if forest is None:
                    every, first = np.unique(np.concatenate(ids), return_index=True)
                    forest = Forest(every, np.concatenate(parts)[first], trees)
                new = np.r_[own[a] != last_query, own[a + 1:b] != own[a:b - 1]]
                last_query = own[b - 1]
                if found := forest.nearest(own[a:b][new], table[new], k, share):
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=names), preserve_index=False)

    best = dealt.mapInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id"), "score")
