"""Multinomial logistic regressions over one packed table, fitted together.

Every point that the searches of all fits ask for is valued in one pass over the table, whose rows stream through the
tasks: nothing of it is kept in memory. The classes' slopes sum up to zero, so that of the last follows from the others.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.classifier.features import FeatureModel
from reviewmill.classifier.packed import integers, rows_of

# A fit ends where the strongly convex objective is at most this share above its minimum.
TOLERANCE = 1e-6
_KEPT_STEPS, _TRIALS, _FIRST_STEP = 10, 30, 2.0
# Slopes are summed across tasks in slices of so many numbers.
_SLICE = 1 << 17


@dataclass
class Goal:
    """One fit: the features and their number among those packed, the parts of the table that teach, their rows by part and label, and C."""

    features: FeatureModel
    number: int
    rows: dict[int, np.ndarray]
    c: float

    def __post_init__(self) -> None:
        counts = sum(self.rows.values())
        self.total = int(counts.sum())
        if not self.total:
            raise ValueError("no row has a known label")
        self.used = counts > 0
        #: Of a row of each label, as share of all.
        self.shares = np.where(self.used, 1.0 / (self.used.sum() * np.maximum(counts, 1)), 0.0)
        self.ridge = 1.0 / (self.c * self.total)
        self.weights = np.array(self.features.weights)


def fitted(table: DataFrame, goals: list[Goal], max_iterations: int, part: str = "_part", label: str = "_label") -> list[tuple[np.ndarray, np.ndarray]]:
    """Coefficients and intercepts of every goal. Rows whose label is negative teach nothing."""
    searches = [_search(g, max_iterations) for g in goals]
    found: list = [None] * len(goals)
    asked = {i: None for i in range(len(goals))}
    values: dict[int, tuple[float, np.ndarray]] = {}
    while asked:
        for i in list(asked):
            try:
                asked[i] = searches[i].send(values.get(i))
            except StopIteration as end:
                found[i] = end.value
                del asked[i]
        values = _values(table, {i: (goals[i], point) for i, point in asked.items()}, part, label) if asked else {}
    return found


def _search(goal: Goal, max_iterations: int) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Yields points (coefficients with the intercept last, by class), is sent their loss and slope, and ends with the best."""
    point = np.zeros((len(goal.shares), len(goal.weights) + 1))
    if goal.used.sum() == 1:
        return point[:, :-1], np.where(goal.used, 0.0, -np.inf)
    shape, point = point.shape, point.ravel()

    def valued(at: np.ndarray, found: tuple[float, np.ndarray]) -> tuple[float, np.ndarray]:
        penalty = at.reshape(shape).copy()
        penalty[:, -1] = 0.0
        return found[0] + goal.ridge / 2 * np.square(penalty).sum(), (found[1] + goal.ridge * penalty).ravel()

    value, slope = valued(point, (yield point.reshape(shape)))
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iterations):
        if slope @ slope <= 2 * goal.ridge * TOLERANCE * value:
            break
        way = _way(slope, steps)
        down, length, low, high = slope @ way, 1.0 if steps else _FIRST_STEP, 0.0, np.inf
        for _ in range(_TRIALS):
            there = point + length * way
            there_value, there_slope = valued(there, (yield there.reshape(shape)))
            if there_value > value + 1e-4 * length * down:
                high = length
            elif there_slope @ way < 0.9 * down:
                low = length
            else:
                break
            length = (low + high) / 2 if high < np.inf else 2 * low
        else:
            break  # the loss has no digits left to tell points apart
        steps = [*steps, (there - point, there_slope - slope)][-_KEPT_STEPS:]
        point, value, slope = there, there_value, there_slope
    made = point.reshape(shape)
    return made[:, :-1], made[:, -1] - made[:, -1].mean()


def _way(slope: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The direction of L-BFGS."""
    way, shares = -slope, []
    for step, turn in reversed(steps):
        shares.append((step @ way) / (step @ turn))
        way = way - shares[-1] * turn
    if steps:
        step, turn = steps[-1]
        way = way * ((step @ turn) / (turn @ turn))
    for (step, turn), share in zip(steps, reversed(shares)):
        way = way + step * (share - (turn @ way) / (step @ turn))
    return way


def _values(table: DataFrame, asked: dict[int, tuple[Goal, np.ndarray]], part: str, label: str) -> dict[int, tuple[float, np.ndarray]]:
    """Weighted log-loss of every point and its slope, without the penalty: one pass over the table for all."""
    spark = table.sparkSession
    classes = next(len(g.shares) for g, _ in asked.values())
    sent = spark.sparkContext.broadcast([
        # Scores against those of the last class, as weights of plain counts.
        (g.number, list(g.rows), g.shares, len(g.weights), (p[:-1, :-1] - p[-1, :-1]) * g.weights, p[:-1, -1] - p[-1, -1]) for g, p in asked.values()])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[np.zeros(1), np.zeros(classes - 1), np.zeros((classes - 1, places))] for _, _, _, places, _, _ in sent.value]
        for row, texts, lengths in rows_of(batches):
            labels, parts = integers(row, label), integers(row, part)
            for (number, inside, shares, places, weights, intercepts), (loss, level, slope) in zip(sent.value, found):
                own = (labels >= 0) & np.isin(parts, inside)
                if not own.any():
                    continue
                share = np.where(own, shares[labels], 0.0)
                margins = np.zeros((classes, len(labels)))
                for k in range(classes - 1):
                    margins[k] = texts.sums(weights[k]) / lengths[number] + intercepts[k]
                top = margins.max(axis=0)
                odds = np.exp(margins - top)
                sums = odds.sum(axis=0)
                loss += (share * (top + np.log(sums) - margins[labels, np.arange(len(labels))])).sum()
                for k in range(classes - 1):
                    wrong = share * (odds[k] / sums - (labels == k))
                    level[k] += wrong.sum()
                    slope[k] += texts.spread(wrong / lengths[number], places)
        flat = np.concatenate([x.ravel() for each in found for x in each])
        for at in range(0, len(flat), _SLICE):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([flat[at:at + _SLICE].tobytes()], pa.binary())], names=["at", "numbers"])

    def summed(numbers: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in numbers["numbers"])
        return pa.table({"at": numbers["at"][:1], "numbers": pa.array([total.tobytes()], pa.binary())})

    # Tasks send all slopes once, whatever they read, so there are no more of them than cores.
    rows = table.select("places", "counts", "ends", "lengths", *dict.fromkeys((part, label))).coalesce(spark.sparkContext.defaultParallelism)
    schema = "at long, numbers binary"
    slices = rows.mapInArrow(passed, schema).groupBy("at").applyInArrow(summed, schema).collect()
    sent.destroy()
    flat, at, values = np.concatenate([np.frombuffer(r["numbers"]) for r in sorted(slices, key=lambda r: r["at"])]), 0, {}
    for i, (goal, _) in asked.items():
        places = len(goal.weights)
        level = flat[at + 1:at + classes]
        slope = flat[at + classes:at + classes + (classes - 1) * places].reshape(classes - 1, places) * goal.weights
        whole = np.column_stack([slope, level])
        values[i] = float(flat[at]), np.vstack([whole, -whole.sum(axis=0)])
        at += classes + (classes - 1) * places
    return values
