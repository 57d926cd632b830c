"""Token ids of documents in Parquet list columns that can be read in part."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

#: Row groups, and pages within them: what one selective read has to fetch at least.
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 512
#: Texts are encoded in slices of about this many characters, cut at blanks.
SLICE = 1 << 20
#: Pieces whose ids a worker remembers, in two generations.
REMEMBERED = 800_000

# The normaliser and pre-tokeniser of vocabularies whose pieces can be encoded one by one.
SPLITS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# Characters whose class is beyond doubt: ASCII, Latin letters, common marks. Others go to the library as whole slices.
_LETTERS = "a-zß-öø-ÿ"
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7fÀ-ÿ¡§«¶»¿–—‘’“”„…€]*")
#: What stands between runs of letters, as the vocabulary cuts it.
MARK = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \\t-\\r0-9{_LETTERS}]+")
_BLANK = re.compile("[ \\t-\\r]")

_CODERS: dict[str, Coder] = {}


def _letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it shows, else one from 256 on in order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class _Pieces(dict):
    """Ids of pieces as bytes, by the vocabulary's model where they are not remembered."""

    def __init__(self, model):
        self.model, self.letters, self.older = model, _letters(), {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        coded = self.older.get(piece)
        if coded is None:
            # Printable ASCII stands for itself; pieces hold no blank.
            letters = piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))
            coded = array("i", [t.id for t in self.model.tokenize(letters)]).tobytes()
        self[piece] = coded
        return coded


class Coder:
    """Ids of texts, by the tokenizers library; ids of pieces seen before come from memory."""

    def __init__(self, vocabulary: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            form = json.load(file)
        self.library = Tokenizer.from_str(json.dumps(form))
        self.splits = all(form.get(k) == v for k, v in SPLITS.items())
        self.special = [t["content"] for t in form.get("added_tokens", [])]
        self.known = _Pieces(self.library.model)

    @staticmethod
    def of(vocabulary: str) -> Coder:
        """One for each worker process."""
        if vocabulary not in _CODERS:
            _CODERS[vocabulary] = Coder(vocabulary)
        return _CODERS[vocabulary]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, as 32-bit integers."""
        if not self.splits:
            return [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.frombuffer(b"".join(map(self._coded, slices(text))), np.int32) for text in texts]

    def _coded(self, part: str) -> bytes:
        """Piece by piece, as the vocabulary never joins them; by the whole ``part`` where a character leaves doubt."""
        if PLAIN.fullmatch(part) and not any(s in part for s in self.special):
            return b"".join(map(self.known.__getitem__, MARK.sub(r" \g<0> ", part.lower()).split()))
        return array("i", self.library.encode(part, add_special_tokens=False).ids).tobytes()


def slices(text: str) -> Iterator[str]:
    """``text`` cut at blanks into parts of about ``SLICE`` characters."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + SLICE)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def encoded(documents: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, part, before, n_tokens, tokens`` in ascending order of ``id_col``.

    ``part`` numbers the ranges that the identifiers are dealt into, ``before`` is
    the number of ids ahead of a document inside its part. Null identifiers come
    last; rows that share an identifier go by a hash of their text and by the text. Equal rows
    may lie in different parts, so that no identifier fills one task.
    """
    table = documents.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    order = [F.col(id_col).asc_nulls_last(), F.xxhash64("__text")]
    dealt = table.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "__text")
    schema = StructType([
        table.schema.fields[0], StructField("part", IntegerType()), StructField("before", LongType()),
        StructField("n_tokens", LongType()), StructField("tokens", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = Coder.of(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = coder.encode(batch.column(1).to_pylist())
            sizes = np.array([len(x) + 1 for x in ids], np.int64)
            ends = np.cumsum(sizes)
            flat = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int32)
            for x, end in zip(ids, ends):
                flat[end - 1 - len(x):end - 1] = x
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(before + ends - sizes), pa.array(sizes), tokens],
                [f.name for f in schema.fields])
            before += int(sizes.sum())

    return dealt.mapInArrow(run, schema)


def write(documents: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          dictionary: bool = True, row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Token files of ``documents`` at ``path``: one row for each document, in ascending order of ``id_col``.

    ``path/ids`` has ``id_col, part, before, n_tokens, tokens``. Tokens are
    dictionary-coded, or delta-coded where ``dictionary`` is false; the other
    columns are delta-coded and sorted, so that row groups and the page index of a
    file tell which pages a range of documents or positions needs. ``path/parts``
    has the ids ahead of every part: ``part, ahead, n_tokens, n_documents``.

    A document's ids are those of its whole text followed by ``end_id``; a null
    or empty text has ``end_id`` only. Rows with a null identifier come last,
    repeated rows are written as often as they occur, extra columns are left out
    whatever their names, an empty table gives empty files. An existing ``path`` is an error.
    """
    ids = encoded(documents, vocabulary, end_id, id_col, text_col)
    options = {
        "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": str(dictionary).lower(),
        "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes), "parquet.page.row.count.limit": str(page_rows),
        "parquet.dictionary.page.size": str(1 << 20), "compression": "zstd",
    }
    ids.write.options(**options).parquet(f"{path}/ids")
    sizes = documents.sparkSession.read.schema(_schema(documents, id_col)).parquet(f"{path}/ids") \
        .groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_documents"))
    # One row for each file: the only window without a key sees as many rows as there are files.
    ahead = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"), "n_tokens", "n_documents").coalesce(1).write.parquet(f"{path}/parts")


def _schema(documents: DataFrame, id_col: str) -> StructType:
    return StructType([documents.select(id_col).schema.fields[0], StructField("part", IntegerType()), StructField("n_tokens", LongType())])


def read(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """``start`` and the written columns of every document; without ``tokens`` no page of ids is read.

    ``start`` is the number of ids of all documents before it. Filters on the
    identifier reach row groups and pages of the files.
    """
    ids = spark.read.parquet(f"{path}/ids")
    id_col = ids.columns[0]
    parts = spark.read.parquet(f"{path}/parts").select(F.col("part").alias("__part"), "ahead")
    joined = ids.join(parts, ids["part"] == parts["__part"])
    return joined.select(id_col, (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", *(["tokens"] if tokens else []))


def window(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The ids at positions ``first`` up to ``last`` (exclusive) of the whole sequence, by document: ``id_col, start, tokens``.

    Only parts that overlap are read, and within them only the row groups and
    pages of the documents that do.
    """
    parts = spark.read.parquet(f"{path}/parts").filter((F.col("ahead") < last) & (F.col("ahead") + F.col("n_tokens") > first))
    asked = [(r.part, r.ahead) for r in parts.select("part", "ahead").collect()]
    ids = spark.read.parquet(f"{path}/ids")
    if not asked:
        return ids.limit(0).select(ids.columns[0], F.col("before").alias("start"), "tokens")
    # ``before`` is sorted inside a part, so bounds on it prune pages; the number of parts asked for is that of files met.
    ahead = F.create_map(*[F.lit(x) for pair in asked for x in pair])
    met = ids.filter(F.col("part").isin([p for p, _ in asked]) & (F.col("before") < last - min(a for _, a in asked)))
    start = F.element_at(ahead, F.col("part")).cast("long") + F.col("before")
    begin, end = F.greatest(start, F.lit(first)), F.least(start + F.col("n_tokens"), F.lit(last))
    cut = F.slice("tokens", (begin - start + 1).cast("int"), (end - begin).cast("int"))
    return met.filter((start < last) & (start + F.col("n_tokens") > first)).select(ids.columns[0], begin.alias("start"), cut.alias("tokens"))


def checksums(ids: DataFrame, name: str = "ids_crc32") -> DataFrame:
    """``ids`` with its last column, the tokens, replaced by the crc32 of them as little-endian 32-bit integers."""
    schema = StructType([*ids.schema.fields[:-1], StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.columns[-1]
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            ends = lists.offsets.to_numpy().astype(np.int64) * 4
            sums = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], schema.names)

    return ids.mapInArrow(run, schema)
