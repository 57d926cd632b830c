"""Language identification by error-correcting output codes over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the hashed n-grams.
BUCKETS = 1 << 16
#: Documents of each language that the fit reads at most, in expectation; chosen by a hash of identifier and text.
FIT_ROWS = 4000
#: Share of a count added to every bucket, as the mean count of a bucket.
SMOOTHING = 0.05
#: Languages up to which the code has every possible column.
EXHAUSTIVE = 6
#: The answer counts as ambiguous below this score.
CLEAR = 0.75
#: How fast the score grows with the difference of losses.
SHARPNESS = 8.0
#: Characters handled at a time.
STEP = 1 << 18
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # buckets x bits: log odds of the two halves
    scale: np.ndarray  # bits: mean absolute margin of the languages
    trust: np.ndarray  # languages x bits: how well a bit tells this language, rows add up to 1


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams of the letters, in parts; nothing for texts without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not _letters()[codes].any():
        return
    codes = np.r_[np.uint32(32), np.where(_letters()[codes], codes, np.uint32(32)), np.uint32(32)]
    for at in range(0, len(codes), STEP):
        c = codes[max(0, at - 2):at + STEP]
        one, two = c * np.uint32(0x9E3779B1), c[1:] * np.uint32(0x85EBCA6B) ^ c[:-1] * np.uint32(0xC2B2AE35)
        three = two[1:] * np.uint32(0x27D4EB2F) ^ c[:-2] * np.uint32(0x165667B1)
        skip = 2 if at else 0
        parts = one[skip:], two[max(0, skip - 1):], three
        # Blanks between letters carry nothing alone or doubled.
        kept = c[skip:] != 32, (c[1:] != 32)[max(0, skip - 1):] | (c[:-1] != 32)[max(0, skip - 1):], c[1:-1] != 32
        hashed = np.concatenate([p[k] for p, k in zip(parts, kept)])
        yield ((hashed ^ hashed >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int64) % BUCKETS


def codewords(n: int) -> np.ndarray:
    """Code of ``n`` words: every column that splits the languages, or random ones with the largest least distance."""
    if n <= EXHAUSTIVE:
        columns = [[1 if c >> i & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(columns, dtype=np.int8).reshape(-1, n).T
    rng, bits = np.random.default_rng(7), int(np.ceil(15 * np.log2(n)))
    best, least = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        np.fill_diagonal(apart, bits)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


def fitted(counts: np.ndarray, languages: list[str]) -> Model:
    """Model from n-gram counts by language and bucket. All languages weigh alike, whatever their size."""
    code = codewords(len(languages))
    shares = counts + SMOOTHING * np.maximum(counts.sum(axis=1, keepdims=True), 1) / BUCKETS
    shares = shares / shares.sum(axis=1, keepdims=True)
    on, off = np.maximum(code, 0).T.astype(float), np.maximum(-code, 0).T.astype(float)
    on, off = on / on.sum(axis=1, keepdims=True), off / off.sum(axis=1, keepdims=True)
    weights = (np.log(on @ shares) - np.log(off @ shares)).T
    margins = shares @ weights
    scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
    trust = np.maximum(code * margins / scale, 1e-6)
    return Model(languages, code, weights.astype(np.float32), scale, trust / trust.sum(axis=1, keepdims=True))


def predict(text: str | None, model: Model) -> tuple[str, float, bool, str | None]:
    """Language, score, whether it is ambiguous, and the second-best language.

    The margin of every bit is the mean log odds of the n-grams. A language's loss
    is the exponential loss of its codeword's bits, weighted by the trust in each
    bit for that language; the least loss wins, ties go to the first language.
    """
    total, n = np.zeros(model.code.shape[1]), 0
    for buckets in ngrams(text):
        total += model.weights[buckets].sum(axis=0, dtype=np.float64)
        n += len(buckets)
    if not n or not model.languages:
        return UNKNOWN, 0.0, True, None
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False, None
    margin = np.clip(total / n / model.scale, -4, 4)
    loss = (model.trust * np.exp(-model.code * margin)).sum(axis=1)
    shares = np.exp(-SHARPNESS * (loss - loss.min()))
    shares /= shares.sum()
    first, second = np.argsort(loss, kind="stable")[:2]
    return model.languages[first], float(shares[first]), bool(shares[first] < CLEAR), model.languages[second]


def fit(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS, id_col: str = "doc_id") -> Model:
    """Model from a sample of about ``fit_rows`` documents of each language, whole texts.

    The sample takes the documents with the smallest hashes of identifier and text, so it is
    the same in every run, and copies of a text are not in or out together. The driver gets one row per language and the summed
    counts by language and bucket, bounded by languages times ``BUCKETS``.
    """
    known = documents.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("at"))
    sizes = {row.lang: row.n for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_rows / sizes[lang]))]), F.col("lang"))
    place = F.pmod("at", F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(place < share).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for buckets in ngrams(text):
                    row = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    row += np.bincount(buckets, minlength=BUCKETS)
        for lang, row in sums.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used), pa.array(row[used])], ["lang", "bucket", "n"])

    parts = chosen.mapInArrow(run, "lang string, bucket long, n long")
    table = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    counts[table["lang"].map(languages.index).to_numpy(dtype=int), table["bucket"].to_numpy(dtype=int)] = table["n"]
    return fitted(counts, languages)


def identify(documents: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All rows of ``documents`` as ``id_col, held_out, lang_pred, score, ambiguous, second``.

    Languages are learned from the rows where ``learn`` holds and text and language
    are known; no other column is an input of a prediction. A text that is null or
    has no letter is ``und`` with score 0, as is every text if nothing could be
    learned. Texts of one letter get an answer, usually marked ambiguous. Rows with
    null identifiers are returned and are not learned from; repeated rows are
    returned as often as they occur; extra columns are not carried.
    """
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(fit(documents.filter(learn), text_col, lang_col, id_col=id_col))
    table = documents.select(F.col(id_col), (~F.coalesce(learn, F.lit(True))).alias("held_out"), F.col(text_col).alias("__text"))
    names = [id_col, "held_out", "lang_pred", "score", "ambiguous", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = [predict(text, model.value) for text in batch.column(2).to_pylist()]
            columns = [pa.array([a[i] for a in answers], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    kind_of_id = table.schema[0].dataType.simpleString()
    return table.mapInArrow(run, f"`{id_col}` {kind_of_id}, held_out boolean, lang_pred string, score double, ambiguous boolean, second string")
