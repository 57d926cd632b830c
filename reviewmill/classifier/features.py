"""TF-IDF features: word and word-pair counts, sublinear, weighted, unit length."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from reviewmill.session import scratch_path

# Of folded texts, where characters beyond ASCII are parts of words.
_WORD = re.compile(r"[0-9A-Za-z_\x80-\U0010ffff]{2,}")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
_BLANKS = {i: " " for i in range(128) if not (chr(i).isalnum() or chr(i) == "_")}
# Texts are counted together up to about so many words, or rows, and taken from a batch so many at a time.
_RUN_WORDS, _RUN_ROWS, _SLICE_ROWS = 1 << 20, 4096, 256


@dataclass(frozen=True)
class FeatureSettings:
    """Fixed values of the feature contract."""

    min_documents: float = 2.0
    max_document_share: float = 0.98
    max_terms: int = 50_000


def _accents() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decomposition."""
    accented, plain = [], []
    for point in range(0xC0, 0x1F00):
        letter = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base != letter:
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


def fold_text(c: Column | str) -> Column:
    """Lower case without accents."""
    accented, plain = _accents()
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.regexp_replace(F.translate(text, accented, plain), r"\p{Mn}+", "")


class _Folds(dict):
    """What becomes of a character beyond ASCII: its base letter, nothing for a mark, a blank for what no word holds, or itself.

    A word holds what Unicode's definition of ``\\w`` names: unlike Python's own, that has marks and joiners, but no fractions.
    """

    def __missing__(self, c: str) -> str:
        kind, point = unicodedata.category(c), ord(c)
        circled = 0x24B6 <= point <= 0x24E9 or 0x1F130 <= point <= 0x1F149 or 0x1F150 <= point <= 0x1F169 or 0x1F170 <= point <= 0x1F189
        inside = kind in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mc", "Me", "Nd", "Pc") or c in "\u200c\u200d" or circled
        self[c] = "" if kind == "Mn" else c if inside else " "
        return self[c]


_FOLDS = _Folds(zip(*_accents()))


def words_of(text: str | None) -> list[str]:
    """All words of two or more characters of the folded text, as :func:`fold_text` folds it."""
    folded = (text or "").lower()
    if not folded.isascii():
        folded = _NOT_ASCII.sub(lambda found: _FOLDS[found[0]], folded)
    if folded.isascii():
        return [w for w in folded.translate(_BLANKS).split() if len(w) > 1]
    return _WORD.findall(folded)


@F.pandas_udf(StringType())
def _words(texts: pd.Series) -> pd.Series:
    return pd.Series([" ".join(words_of(t)) for t in texts], dtype=object)


def with_terms(table: DataFrame, text: str) -> DataFrame:
    """Add ``terms``: all words of two or more characters, in order, with one blank between.

    Words and pairs of neighbours are the terms; they are formed where they are counted, as numbers.
    """
    return table.withColumn("terms", _words(text))


class _Numbered(dict):
    """A number for every word, in the order in which words come."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return self[word]


class Run:
    """Texts that are counted together: their words by number, and the row of each."""

    def __init__(self) -> None:
        self.known, self.numbers, self.groups, self.words = _Numbered(), [], [], 0

    def add(self, terms: str | None, group: int = 0) -> None:
        own = terms.split(" ") if terms else []
        self.numbers.append(np.fromiter(map(self.known.__getitem__, own), np.int64, len(own)))
        self.groups.append(group)
        self.words += len(own)

    def full(self, words: int = _RUN_WORDS) -> bool:
        return self.words >= words or len(self.numbers) >= _RUN_ROWS

    def occurrences(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Number and row of every word, and of every pair of neighbours, whose number is that of its first word times all words, plus that of its second."""
        numbers = np.concatenate(self.numbers) if self.numbers else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(self.numbers)), [len(n) for n in self.numbers])
        beside = row[:-1] == row[1:]
        return (numbers, row), ((numbers[:-1] * len(self.known) + numbers[1:])[beside], row[:-1][beside])

    def statistics(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        """Every term within every group with its uses and rows: first the words, then the pairs."""
        names, every = pa.array(list(self.known), pa.string()), max(len(self.known), 1)
        groups, many = np.array(self.groups, np.int64), max(self.groups, default=0) + 1
        for pairs, (number, row) in enumerate(self.occurrences()):
            found, uses, rows = self._tally(number * many + groups[row], row)
            term = found // many
            texts = pc.binary_join_element_wise(names.take(pa.array(term // every)), names.take(pa.array(term % every)), " ") if pairs else names.take(pa.array(term))
            yield texts, found % many, uses, rows

    def _tally(self, number: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different numbers in order, how often each is there, and in how many rows."""
        if not len(number):
            return number, number, number
        each, uses = np.unique(number * len(self.numbers) + row, return_counts=True)
        number = each // len(self.numbers)
        first = np.flatnonzero(np.diff(number, prepend=-1))
        return number[first], np.add.reduceat(uses, first), np.diff(first, append=len(number))


class Vocabulary:
    """Places of the terms of a vocabulary, and the counts of texts by them."""

    def __init__(self, terms: list[str]) -> None:
        self.size = len(terms)
        self.places = {t: i for i, t in enumerate(terms) if " " not in t}
        pairs = [(*t.split(" "), i) for i, t in enumerate(terms) if " " in t]
        self.firsts, self.seconds, places = zip(*pairs) if pairs else ((), (), ())
        self.pair_places = np.array(places, np.int64)

    def counts(self, run: Run) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and counts of the terms of every row."""
        ends, places, counts = self.flat(run)
        return zip(np.split(places.astype(np.int32), ends[:-1]), np.split(counts, ends[:-1]))

    def flat(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and counts of the terms of all rows, one row after the other, behind the end of each row."""
        (words, rows), (pairs, pair_rows) = run.occurrences()
        place = np.fromiter((self.places.get(w, -1) for w in run.known), np.int64, len(run.known))[words]
        first, second = (np.array([run.known.get(w, -1) for w in side], np.int64) for side in (self.firsts, self.seconds))
        there = (first >= 0) & (second >= 0)
        known = first[there] * len(run.known) + second[there]
        order = np.argsort(known)
        known, places = known[order], self.pair_places[there][order]
        at = np.searchsorted(known, pairs)
        found = np.append(known, -1)[at] == pairs
        size = max(self.size, 1)
        each, counts = np.unique(np.concatenate([
            rows[place >= 0] * size + place[place >= 0], pair_rows[found] * size + places[at[found]]]), return_counts=True)
        return np.searchsorted(each, np.arange(1, len(run.numbers) + 1) * size), each % size, counts


def _scaled_counts(vocabulary: list[str]):
    """1 + ln(count) of the terms of a text, as sparse vectors."""
    known = Vocabulary(vocabulary)

    @F.pandas_udf(VectorUDT())
    def scaled(texts: pd.Series) -> pd.DataFrame:
        places, values, run = [], [], Run()
        for i, terms in enumerate(texts, 1):
            run.add(terms)
            if run.full() or i == len(texts):
                for place, count in known.counts(run):
                    places.append(place)
                    values.append(1.0 + np.log(count))
                run = Run()
        return pd.DataFrame({
            "type": np.zeros(len(places), np.int8), "size": np.full(len(places), known.size, np.int32),
            "indices": pd.Series(places, dtype=object), "values": pd.Series(values, dtype=object)})

    return scaled


@dataclass
class FeatureModel:
    """Vocabulary and weights learnt from training text."""

    counter: CountVectorizerModel
    weights: DenseVector

    def transform(self, table: DataFrame, text: str, output: str = "features") -> DataFrame:
        return self.transform_terms(with_terms(table, text), output)

    def transform_terms(self, table: DataFrame, output: str = "features") -> DataFrame:
        """As :meth:`transform` for a table that already has ``terms``."""
        return self.weigh(self.count(table, stored=False), output)

    def count(self, table: DataFrame, stored: bool = True) -> DataFrame:
        """``_tf`` in place of ``terms``: scaled counts, the same for all models of one vocabulary.

        ``stored`` counts are written below the shared folder, for whoever reads them again. For a stream, or a single use, they are made as rows come.
        """
        counted = table.withColumn("_tf", _scaled_counts(self.counter.vocabulary)("terms")).drop("terms")
        if not stored:
            return counted
        path = scratch_path(table.sparkSession, "term-counts")
        counted.write.parquet(path)
        return table.sparkSession.read.schema(counted.schema).parquet(path)

    def weigh(self, scaled: DataFrame, output: str = "features") -> DataFrame:
        weighted = ElementwiseProduct(scalingVec=self.weights, inputCol="_tf", outputCol="_weighted").transform(scaled)
        return Normalizer(p=2.0, inputCol="_weighted", outputCol=output).transform(weighted).drop("_tf", "_weighted")

    def save(self, path: str) -> None:
        self.counter.write().overwrite().save(f"{path}/terms")
        spark = SparkSession.active()
        rows = [(i, float(w)) for i, w in enumerate(self.weights)]
        spark.createDataFrame(rows, "term int, weight double").write.mode("overwrite").parquet(f"{path}/weights")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        # One number per vocabulary term: bounded by FeatureSettings.max_terms.
        rows = spark.read.parquet(f"{path}/weights").orderBy("term").collect()
        return FeatureModel(CountVectorizerModel.load(f"{path}/terms"), DenseVector([r.weight for r in rows]))


def fit_features(table: DataFrame, text: str, settings: FeatureSettings = FeatureSettings()) -> FeatureModel:
    """Learn the vocabulary and the smoothed inverse document frequencies."""
    return learn_from_terms(with_terms(table.select(text), text).select("terms"), settings)


def _counter(vocabulary: list[str]) -> CountVectorizerModel:
    """A counter of these terms. They reach the JVM as one text: an array would be filled by one call per term."""
    if not vocabulary:
        return CountVectorizerModel.from_vocabulary([], "terms", "_counts")
    jvm = SparkSession.active().sparkContext._jvm
    terms = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(vocabulary))
    counter = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", terms)
    counter._set(vocabSize=len(vocabulary))
    return counter.setInputCol("terms").setOutputCol("_counts")


def term_statistics(terms: DataFrame, *by: str) -> DataFrame:
    """``term, uses, documents`` for every term within ``by``: how often it is used, and in how many rows. The rows are read once.

    Terms are counted as numbers within runs of texts, so one row for each term of a run is grouped, not one for each use.
    """
    schema = StructType([terms.schema[c] for c in by]).add("term", "string").add("uses", "long").add("documents", "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(run: Run) -> Iterator[pa.RecordBatch]:
            values = [pa.array(side, kind) for side, kind in zip(zip(*groups), types)]
            for names, group, uses, documents in run.statistics():
                same = [side.take(pa.array(group)) for side in values]
                yield pa.RecordBatch.from_arrays([*same, names, pa.array(uses, pa.int64()), pa.array(documents, pa.int64())],
                                                 names=[*by, "term", "uses", "documents"])

        # All groups share a run, so memory does not grow with their number.
        run, groups, types = Run(), _Numbered(), []
        for batch in batches:
            types = [batch.column(c).type for c in by]
            for at in range(0, batch.num_rows, _SLICE_ROWS):
                part = batch.slice(at, _SLICE_ROWS)
                keys = zip(*(part.column(c).to_pylist() for c in by)) if by else [()] * part.num_rows
                for group, text in zip(keys, part.column("terms").to_pylist()):
                    run.add(text, groups[group])
                    if run.full():
                        yield from rows(run)
                        run = Run()
        if run.numbers:
            yield from rows(run)

    found = terms.select(*by, "terms").mapInArrow(counted, schema)
    return found.groupBy(*by, "term").agg(F.sum("uses").alias("uses"), F.sum("documents").alias("documents"))


def chosen_terms(statistics: DataFrame, rows: int, settings: FeatureSettings) -> list[tuple[str, int]]:
    """Terms of the vocabulary with their document frequencies, by use, ties by the term itself, so the
    choice never depends on how the input is partitioned. One row per chosen term, ``settings.max_terms`` at most, comes to the driver."""
    least, share = settings.min_documents, settings.max_document_share
    known = statistics.filter(F.col("documents") >= (least if least >= 1.0 else least * rows))
    if share < 1.0:
        known = known.filter(F.col("documents") <= share * rows)
    chosen = known.orderBy(F.desc("uses"), "term").limit(settings.max_terms).select("term", "documents").collect()
    return [(r.term, r.documents) for r in chosen]


def inverse_frequency(rows: int, documents: int) -> float:
    """Smoothed inverse document frequency."""
    return math.log((rows + 1) / (documents + 1)) + 1.0


def learn_from_terms(terms: DataFrame, settings: FeatureSettings = FeatureSettings()) -> FeatureModel:
    """Vocabulary and document frequencies of all rows."""
    rows = terms.count()
    chosen = chosen_terms(term_statistics(terms), rows, settings)
    return FeatureModel(_counter([t for t, _ in chosen]), DenseVector([inverse_frequency(rows, n) for _, n in chosen]))


def learn_without_each(terms: DataFrame, fold: str, folds: int, settings: FeatureSettings = FeatureSettings()) -> list[FeatureModel]:
    """For every fold the features of all rows outside it, as models over one common vocabulary."""
    return learn_without(terms, fold, folds, [{i} for i in range(folds)], settings)


def learn_without(terms: DataFrame, part: str, parts: int, left_out: list[set[int]], settings: FeatureSettings = FeatureSettings()) -> list[FeatureModel]:
    """For every set of parts the features of all rows outside them, as models over one common vocabulary.

    One table of terms by part is counted; what is left without some parts is the sum of the others. All models
    count the same terms, so one table of counts serves them; a term that is not of a model's own vocabulary has weight 0.
    """
    by_part = term_statistics(terms, part).groupBy("term").pivot(part, list(range(parts))).agg(F.sum("uses").alias("uses"), F.sum("documents").alias("documents"))
    rows = {r[part]: r["n"] for r in terms.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
    own = [F.coalesce(F.col(f"{i}_{c}"), F.lit(0)).alias(f"{c}_{i}") for i in range(parts) for c in ("uses", "documents")]
    path = scratch_path(terms.sparkSession, "part-terms")
    by_part.select("term", *own).write.parquet(path)
    kept = terms.sparkSession.read.parquet(path)
    inside = [[i for i in range(parts) if i not in out] for out in left_out]
    totals = [sum(rows.get(i, 0) for i in held) for held in inside]

    def chosen_of(held: list[int], total: int) -> dict[str, int]:
        sums = [sum((F.col(f"{c}_{i}") for i in held), F.lit(0)).alias(c) for c in ("uses", "documents")]
        return dict(chosen_terms(kept.select("term", *sums), total, settings))

    chosen = [chosen_of(held, total) for held, total in zip(inside, totals)]
    everything = sorted(set().union(*chosen))
    counter = _counter(everything)
    return [FeatureModel(counter, DenseVector([
        inverse_frequency(total, own[t]) if t in own else 0.0 for t in everything])) for total, own in zip(totals, chosen)]
