"""Toxicity by two class-conditional Kneser-Ney models of the characters of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from reviewmill.llm.common import crc32_modulo, dropped, stored

#: Longest character n-gram and discount of the models.
ORDER = 8
DISCOUNT = 0.75
#: Words of the windows whose most toxic one counts; words whose mean counts, the most toxic ones; log-likelihood ratio
#: of a word above which it adds to the excess of its text.
WINDOW, TOP, STRONG = 12, 3, 2.0
#: Words of texts that are looked up at a time, whole texts at least.
TOGETHER = 1 << 16
#: Longer runs of letters and digits are words of this many characters, one after the other.
WORD_CHARACTERS = 64
#: Labelled documents that the models and the calibration read at most, and characters of the former, in expectation;
#: chosen by a hash of their identifier. The characters bound the table of n-grams that is sent to all tasks.
FIT_ROWS = 60_000
FIT_CHARACTERS = 12_000_000
CALIBRATION_ROWS = 6_000
#: Of the remainders of crc32 modulo FOLDS, this one is never learned from, and the next calibrates.
FOLDS = 5
HELD_OUT = 0
CALIBRATION = 1
#: Features of a text, in the order of the calibration's weights, which are these if it has nothing to fit on.
FEATURES = ("whole", "window", "top", "excess")
DEFAULT = (-7.5, 1.0, 0.0, 1.1, 24.0)
#: Columns that a scored table has, all named with toxic_ before it.
ADDED = {"held_out": BooleanType(), "score": DoubleType(), "predicted": IntegerType(), **dict.fromkeys(FEATURES, DoubleType())}
COUNTS = ("toxic_fit", "plain_fit", "toxic_all", "plain_all")
START, END = "\x02", "\x03"
WORDS = re.compile(rf"[^\W_]{{1,{WORD_CHARACTERS}}}")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def grams_of(word: str) -> list[str]:
    """For every character and the end, itself with up to ``ORDER - 1`` characters before it."""
    marked = START + word + END
    return [marked[max(0, i - ORDER + 1):i + 1] for i in range(1, len(marked))]


def gathered(documents: DataFrame) -> DataFrame:
    """``gram`` with its counts in toxic and ordinary documents, without and with the calibration part.

    ``documents`` has ``text, toxic, fold``; rows without a label add their n-grams
    with counts of zero, which is what the shared backoff counts need. Words are summed up over the
    corpus before they are cut into n-grams.
    """
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"[\p{{L}}\p{{N}}]{{1,{WORD_CHARACTERS}}}"), F.lit(0))).alias("word")
    fit = F.col("fold") != CALIBRATION
    kinds = {"toxic_fit": fit & (F.col("toxic") == 1), "plain_fit": fit & (F.col("toxic") == 0), "toxic_all": F.col("toxic") == 1, "plain_all": F.col("toxic") == 0}
    rows = documents.select(*[F.coalesce(c.cast("long"), F.lit(0).cast("long")).alias(n) for n, c in kinds.items()], word)
    words = rows.groupBy("word").agg(*[F.sum(n).alias(n) for n in COUNTS])
    marked = words.select(F.concat(F.lit(START), "word", F.lit(END)).alias("marked"), *COUNTS)
    ends = F.sequence(F.lit(2), F.length("marked"))
    grams = F.transform(ends, lambda i: F.substring("marked", F.greatest(F.lit(1), i - ORDER + 1), F.least(i, F.lit(ORDER))))
    return marked.select(F.explode(grams).alias("gram"), *COUNTS).groupBy("gram").agg(*[F.sum(n).alias(n) for n in COUNTS])


def shared_backoff(grams: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram, p``: Kneser-Ney probability of the last character of every ``wanted`` n-gram, all shorter than the longest.

    Counts are of types, not tokens: the number of different characters seen before
    an n-gram anywhere in the corpus. Both classes share them. Types are counted level by level, each from the one
    above and written before the next; probabilities are worked out for wanted n-grams and their ends only.
    """
    levels: dict[int, DataFrame] = {}
    for size in range(ORDER, 1, -1):
        longer = grams.filter(F.length("gram") == size).select("gram")
        if size in levels:
            longer = longer.union(levels[size].select("gram"))
        found = longer.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels[size - 1] = stored(found, f"types-{size - 1}")
    needed = {ORDER: wanted.limit(0)}
    for size in range(ORDER - 1, 0, -1):
        own = wanted.filter(F.length("gram") == size).union(needed[size + 1].select(F.expr("substring(gram, 2)").alias("gram")))
        needed[size] = stored(own.distinct(), f"wanted-{size}") if size > 1 else own.distinct()
    total = levels[1].agg(F.sum("n")).first()[0] or 1
    below = stored(levels[1].select("gram", (F.col("n") / F.lit(total)).alias("p")), "backoff-1")
    everything = below
    for size in range(2, ORDER):
        level = levels[size]
        totals = level.groupBy(F.expr(f"substring(gram, 1, {size - 1})").alias("h")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = needed[size].join(level, "gram").withColumns({"h": F.expr(f"substring(gram, 1, {size - 1})"), "rest": F.expr("substring(gram, 2)")})
        lower = below.select(F.col("gram").alias("rest"), F.col("p").alias("q"))
        p = (F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("q")) / F.col("total")
        below = stored(rows.join(totals, "h").join(lower, "rest").select("gram", p.alias("p")), f"backoff-{size}", (level, needed[size]))
        everything = everything.union(below)
    return everything


def ratios(grams: DataFrame) -> DataFrame:
    """``gram, fit, every``: log-likelihood ratio, toxic to ordinary, of the last character of ``gram``.

    Rows whose name ends with a tab are contexts: the ratio of what the classes
    leave to the shared counts, for characters that neither has seen there.
    """
    labelled = stored(grams.filter("toxic_all + plain_all > 0").withColumn("h", F.expr("substring(gram, 1, length(gram) - 1)")), "toxic-labelled")
    wanted = labelled.select(F.expr("substring(gram, 2)").alias("gram")).distinct()
    backoff = shared_backoff(grams, wanted).select(F.col("gram").alias("rest"), "p")
    sums = []
    for name in COUNTS:
        sums += [F.sum(name).alias(f"{name}_sum"), F.count(F.when(F.col(name) > 0, 1)).alias(f"{name}_kinds")]
    contexts = stored(labelled.groupBy("h").agg(*sums), "toxic-contexts")

    def left(name: str) -> Column:
        """Share of a context's probability that the class leaves to the shared counts."""
        return F.when(F.col(f"{name}_sum") > 0, DISCOUNT * F.col(f"{name}_kinds") / F.greatest(F.col(f"{name}_sum"), F.lit(1))).otherwise(1.0)

    def seen(name: str) -> Column:
        own = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"{name}_sum"), F.lit(1))
        return own + left(name) * F.col("p")

    rows = labelled.withColumn("rest", F.expr("substring(gram, 2)")).join(contexts, "h").join(backoff, "rest")
    known = rows.select("gram", *[F.log(seen(f"toxic_{x}") / seen(f"plain_{x}")).alias(x) for x in ("fit", "all")])
    unknown = contexts.select(F.concat("h", F.lit("\t")).alias("gram"), *[F.log(left(f"toxic_{x}") / left(f"plain_{x}")).alias(x) for x in ("fit", "all")])
    return known.union(unknown)


def _mixed(codes: np.ndarray, place: int) -> np.ndarray:
    """64 bits for a character (its code point, unsigned 64 bits) at a place counted from the end of an n-gram."""
    x = codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64((place + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_hashes(grams: pa.StringArray) -> np.ndarray:
    """Hashes of n-grams: the sum of what their characters have at their places from the end."""
    sizes = pc.utf8_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)
    codes, last = _codes("".join(grams.to_pylist())), np.cumsum(sizes) - 1
    hashes = np.zeros(len(sizes), np.uint64)
    for place in range(int(sizes.max(initial=0))):
        met = np.flatnonzero(sizes > place)
        hashes[met] += _mixed(codes[last[met] - place], place)
    return hashes


def packed(hashes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-grams in order, with their ratios: 12 bytes for each."""
    order = np.argsort(hashes)
    return hashes[order], values[order].astype(np.float32)


class Scorer(dict):
    """Log-likelihood ratios of words, toxic to ordinary; those it has met are remembered."""

    def __init__(self, table: tuple[np.ndarray, np.ndarray], remembered: int = 400_000):
        (self.hashes, self.values_of), self.remembered = table, remembered

    def _looked_up(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios of n-grams by hash, and whether the table has them."""
        if not len(self.hashes):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        there = self.hashes[at] == wanted
        return np.where(there, self.values_of[at], 0.0), there

    def learn(self, words: set[str]) -> None:
        """Work out the ratios of words it does not know: of n-grams that no label has, the ratio of their context.

        All n-grams of all new words are hashed together: the one that ends at a character is the sum of the
        characters before it, up to ``ORDER`` of them and as far as the word's start.
        """
        if len(self) + len(words) > self.remembered:
            self.clear()
        new = list(words.difference(self))
        if not new:
            return
        codes = _codes("".join([START + w + END for w in new]))
        starts = np.cumsum([0, *(len(w) + 2 for w in new[:-1])])
        inside = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
        before = np.zeros(len(codes), np.uint64)
        for place in range(1, ORDER):
            before[place:] += np.where(inside[place:] >= place, _mixed(codes[:-place], place), np.uint64(0))
        values, there = self._looked_up(before + _mixed(codes, 0))
        rest = np.flatnonzero(~there)
        values[rest] = self._looked_up(before[rest] + _mixed(np.array([ord("\t")], np.uint64), 0))[0]
        values[starts] = 0.0  # nothing is predicted at the start itself
        self.update(zip(new, np.add.reduceat(values, starts).tolist()))

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: log-likelihood ratio per character of the whole and of its most toxic window, mean ratio of
        its most toxic words, and what words have beyond ``STRONG``, per word of the text."""
        rows = np.zeros((len(texts), len(FEATURES)))
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            held.append((i, words_of(text)))
            size += len(held[-1][1])
            if size >= TOGETHER or i == len(texts) - 1:
                self._fill(rows, held)
                held, size = [], 0
        return rows

    def _fill(self, rows: np.ndarray, held: list[tuple[int, list[str]]]) -> None:
        self.learn({w for _, found in held for w in found})
        for i, found in held:
            if not found:
                continue
            each = np.fromiter(map(self.__getitem__, found), float, len(found))
            sums = np.r_[0.0, np.cumsum(each)]
            sizes = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)]
            wide, top = min(WINDOW, len(found)), min(TOP, len(found))
            best = np.partition(each, len(each) - top)[len(each) - top:]
            rows[i] = (sums[-1] / sizes[-1], ((sums[wide:] - sums[:-wide]) / (sizes[wide:] - sizes[:-wide])).max(),
                       best.sum() / TOP, np.maximum(each - STRONG, 0.0).sum() / len(found))


def calibrated(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on an intercept and the features, with a small ridge."""
    x = np.c_[np.ones(len(features)), features]
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * features.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta = beta + step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _sampled(rows: DataFrame, n: int, characters: float = float("inf")) -> DataFrame:
    """About ``n`` rows and ``characters`` characters (column ``size``), always the same, by a hash of the identifier."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    share = min(1.0, n / max(1, total.n), characters / max(1, total.size))
    return rows if share == 1.0 else rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * share))


def score(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """All rows of ``documents`` as ``id_col, held_out, score, predicted``, with all features.

    See ``annotated``.
    """
    found = annotated(documents.select(id_col, text_col), labels, id_col, text_col, label_col, fit_rows, calibration_rows)
    return found.select(id_col, *[F.col(f"toxic_{n}").alias(n) for n in ADDED])


def annotated(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
              fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS, fit_characters: int = FIT_CHARACTERS) -> DataFrame:
    """All rows and columns of ``documents`` with ``toxic_held_out``, ``toxic_score``, ``toxic_predicted`` and all features.

    Labels of documents whose identifier's crc32 modulo ``FOLDS`` is ``HELD_OUT``
    are never read. A character is predicted from those before it in its word; the
    classes keep their own counts of the longest n-grams and share the backoff
    counts, gathered from every document, labelled or not. A text's score compares
    its length-normalised log-likelihoods under both classes, over the whole text, its most toxic window of ``WINDOW``
    words, its most toxic words and all words far above the ordinary, by a logistic regression
    fitted where the counts have not been (models without that part of the labels).

    The models and the calibration read bounded samples of the labelled rows (``fit_rows``, ``fit_characters``,
    ``calibration_rows``). Hashes and ratios of that sample's n-grams, at most one of 12 bytes for each of its characters
    and one for each context, pass through the driver to all tasks; counts of the corpus do not. Runs of letters longer than ``WORD_CHARACTERS`` are several words.
    Null, empty and wordless texts have features 0 and get the score of those.
    Without labels of both kinds every score is 0. Labels that are null, not 0 or 1,
    or whose document is missing are ignored; of repeated labels the larger counts.
    Rows with null identifiers are scored and not held out; repeated rows are
    returned as often as they occur; columns of the added names are replaced.
    """
    spark = documents.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1) and id is not null")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("fold", crc32_modulo(F.col("id"), FOLDS)).filter(F.col("fold") != HELD_OUT)
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = texts.select("id", F.length("text").alias("size")).groupBy("id").agg(F.sum("size").alias("size"))
    known = stored(_sampled(stored(known.join(sizes, "id"), "toxic-labels"), fit_rows, fit_characters), "toxic-labels")

    model, beta = packed(np.zeros(0, np.uint64), np.zeros(0)), np.array([-50.0] + [0.0] * len(FEATURES))
    if known.select("toxic").distinct().count() == 2:
        given = F.broadcast(known.select("id", "toxic", "fold"))
        grams = stored(gathered(texts.join(given, "id", "left")), "toxic-grams")
        rows = ratios(grams).select("gram", F.col("fit").cast("float"), F.col("all").cast("float")).toArrow()
        dropped(grams)
        hashes = np.concatenate([np.zeros(0, np.uint64), *map(gram_hashes, rows["gram"].chunks)])
        fit, model = (packed(hashes, rows[n].to_numpy()) for n in ("fit", "all"))
        calibration = _sampled(known.filter(F.col("fold") == CALIBRATION), calibration_rows)
        first = spark.sparkContext.broadcast(fit)
        chosen = texts.join(F.broadcast(calibration.select("id", "toxic")), "id").select("text", "toxic")

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(first.value)
            for batch in batches:
                found = scorer.features(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(1), *map(pa.array, found.T)], ["toxic", *FEATURES])

        seen = chosen.mapInArrow(features, ", ".join(["toxic int", *(f"{n} double" for n in FEATURES)])).toPandas()
        first.destroy()
        beta = calibrated(seen[list(FEATURES)].to_numpy(), seen["toxic"].to_numpy(dtype=float)) if seen["toxic"].nunique() == 2 else np.array(DEFAULT)
    model = spark.sparkContext.broadcast(model)
    added = [StructField(f"toxic_{n}", t) for n, t in ADDED.items()]
    carried = documents.select(*[c for c in documents.columns if c not in {f.name for f in added}])
    at = carried.columns.index(text_col)
    table = carried.withColumn("toxic_held_out", F.coalesce(crc32_modulo(F.col(id_col), FOLDS) == HELD_OUT, F.lit(False)))
    schema = StructType([*carried.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            found = scorer.features(batch.column(at).to_pylist())
            p = 1 / (1 + np.exp(-np.clip(beta[0] + found @ beta[1:], -50, 50)))
            columns = [p, (p >= 0.5).astype(np.int32), *found.T]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], schema.names)

    return table.mapInArrow(run, schema)
