"""Term counts of many texts in one row, as few bytes, and what models make of them.

A row of a packed table holds the texts of one run: the places and counts of their terms one after the other, where each
text ends, and the length of each text's weighted counts by every model. Numbers lie as NumPy reads them, each in as few
bytes as the largest of its row needs. Readers see one row at a time, so memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from reviewmill.classifier.features import FeatureModel, Run, Vocabulary
from reviewmill.session import scratch_path

# Texts are packed together up to about so many words, and taken from a batch so many at a time.
RUN_WORDS, SLICE_ROWS = 1 << 18, 256
# 1 + ln(count) of the counts that a byte holds; the first stands for none.
_SCALED = 1.0 + np.log(np.maximum(np.arange(256), 1), dtype=np.float64)
_BYTES = ("places", "counts", "ends", "lengths")


class Texts:
    """Scaled counts of some texts: 1 + ln(count) by place."""

    def __init__(self, ends: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
        self.places = places.astype(np.intp)
        self.values = _SCALED.take(counts) if counts.dtype == np.uint8 else 1.0 + np.log(counts, dtype=np.float64)
        self.sizes = np.diff(ends, prepend=0)
        self.filled = np.flatnonzero(self.sizes)
        self.starts = (ends - self.sizes)[self.filled]

    def _by_text(self, entries: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.sizes))
        if len(self.filled):
            sums[self.filled] = np.add.reduceat(entries, self.starts)
        return sums

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For every text the sum of its values times the weights of their places."""
        return self._by_text(weights.take(self.places) * self.values)

    def lengths(self, weights: np.ndarray) -> np.ndarray:
        """For every text the length of its weighted values; 1 where it has none, as nothing is divided by it then."""
        found = np.sqrt(self._by_text(np.square(weights.take(self.places) * self.values)))
        found[found == 0.0] = 1.0
        return found

    def spread(self, amounts: np.ndarray, places: int) -> np.ndarray:
        """For every place the sum of its values times the amounts of their texts."""
        return np.bincount(self.places, np.repeat(amounts, self.sizes) * self.values, places)


def _least(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def _unpacked(found: bytes, n: int) -> np.ndarray:
    return np.frombuffer(found, f"u{max(len(found) // max(n, 1), 1)}")


def packed(table: DataFrame, models: list[FeatureModel], numbers: tuple[str, ...], kept: tuple[str, ...] = ()) -> DataFrame:
    """Stored counts of ``terms`` by the vocabulary that ``models`` share.

    ``numbers`` are integer columns that fits need, ``kept`` any others that go along with the texts.
    """
    fields = {f.name: f for f in table.schema}
    schema = StructType()
    for name in (*_BYTES, *numbers):
        schema = schema.add(name, "binary")
    for name in kept:
        schema = schema.add(name, ArrayType(fields[name].dataType))
    vocabulary, weights = Vocabulary(models[0].counter.vocabulary), [np.array(m.weights) for m in models]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(run: Run, slices: list[pa.RecordBatch]) -> pa.RecordBatch:
            ends, places, counts = vocabulary.flat(run)
            texts = Texts(ends, places, counts)
            lengths = np.concatenate([texts.lengths(w) for w in weights])
            found = [pa.array([x.tobytes()], pa.binary()) for x in (_least(places), _least(counts), ends, lengths)]
            whole = pa.Table.from_batches(slices)
            found += [pa.array([whole[c].to_numpy().astype(np.int32).tobytes()], pa.binary()) for c in numbers]
            for c in kept:
                column = whole[c].combine_chunks()
                found.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
            return pa.RecordBatch.from_arrays(found, names=[*_BYTES, *numbers, *kept])

        run, slices = Run(), []
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                first = 0
                for i, text in enumerate(part.column("terms").to_pylist(), 1):
                    run.add(text)
                    if run.full(RUN_WORDS):
                        yield row(run, [*slices, part.slice(first, i - first).select([*numbers, *kept])])
                        run, slices, first = Run(), [], i
                if first < part.num_rows:
                    slices.append(part.slice(first).select([*numbers, *kept]))
        if slices:
            yield row(run, slices)

    path = scratch_path(table.sparkSession, "term-counts")
    table.select("terms", *numbers, *kept).mapInArrow(pack, schema).write.parquet(path)
    return table.sparkSession.read.schema(schema).parquet(path)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Texts, np.ndarray]]:
    """Rows of a packed table one by one, with their texts and the lengths of these by model."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            ends = np.frombuffer(row["ends"].as_buffer(), np.int64)
            n = int(ends[-1]) if len(ends) else 0
            texts = Texts(ends, _unpacked(row["places"].as_buffer(), n), _unpacked(row["counts"].as_buffer(), n))
            yield row, texts, np.frombuffer(row["lengths"].as_buffer(), np.float64).reshape(-1, len(ends))


def integers(row: dict, name: str) -> np.ndarray:
    return np.frombuffer(row[name].as_buffer(), np.int32)


def probabilities(texts: Texts, lengths: np.ndarray, weights: np.ndarray, coefficients: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """One row of class scores for every text."""
    margins = np.stack([texts.sums(c * weights) / lengths + b for c, b in zip(coefficients, intercepts)])
    odds = np.exp(margins - margins.max(axis=0))
    return (odds / odds.sum(axis=0)).T


def class_scores(features: FeatureModel, coefficients: np.ndarray, intercepts: np.ndarray):
    """Class scores of ``terms`` as an array; for a table or a stream."""
    vocabulary, weights = Vocabulary(features.counter.vocabulary), np.array(features.weights)

    @F.pandas_udf("array<double>")
    def scores(terms: pd.Series) -> pd.Series:
        found, run = [], Run()
        for i, text in enumerate(terms, 1):
            run.add(text)
            if run.full(RUN_WORDS) or i == len(terms):
                texts = Texts(*vocabulary.flat(run))
                found += list(probabilities(texts, texts.lengths(weights), weights, coefficients, intercepts))
                run = Run()
        return pd.Series(found, dtype=object)

    return scores


def scored(table: DataFrame, numbers: dict[str, str], kept: tuple[str, ...], models: dict[int, tuple[int, FeatureModel, np.ndarray, np.ndarray]],
           part: str) -> DataFrame:
    """Texts of the parts that ``models`` names, each with ``_scores`` by the model of its part (its number among those packed, features, coefficients and intercepts).

    ``numbers`` are the integer columns of a packed table to give again, by name, under the names that they map to.
    """
    schema = StructType()
    for name in kept:
        schema = schema.add(name, table.schema[name].dataType.elementType)
    for name in numbers.values():
        schema = schema.add(name, IntegerType())
    schema = schema.add("_scores", ArrayType(DoubleType()))
    known = {p: (n, np.array(f.weights), c, b) for p, (n, f, c, b) in models.items()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts, lengths in rows_of(batches):
            parts, found = integers(row, part), np.zeros((len(texts.sizes), 0))
            for p, (n, weights, coefficients, intercepts) in known.items():
                own = parts == p
                if own.any():
                    own_scores = probabilities(texts, lengths[n], weights, coefficients, intercepts)
                    found = found if found.shape[1] else np.zeros_like(own_scores)
                    found[own] = own_scores[own]
            chosen = np.flatnonzero(np.isin(parts, list(known)))
            if not len(chosen):
                continue
            columns = [row[c].values.take(pa.array(chosen)) for c in kept]
            columns += [pa.array(integers(row, c)[chosen], pa.int32()) for c in numbers]
            width = found.shape[1]
            flat = pa.array(found[chosen].ravel(), pa.float64())
            columns.append(pa.ListArray.from_arrays(pa.array(np.arange(len(chosen) + 1, dtype=np.int32) * width), flat))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return table.select(*_BYTES, *dict.fromkeys([part, *numbers]), *kept).mapInArrow(score, schema)
