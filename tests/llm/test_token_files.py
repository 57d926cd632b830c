"""Token files: exact round trips, file layout, selective reads."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import token_files
from reviewmill.llm.common import prepare
from reviewmill.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (5, "Hello, World! it's 42."), (1, None), (2, ""), (None, "İstanbul straße Ärger"), (None, "İstanbul straße Ärger"), (7, " \n\t "), (5, "another five"),
    (3, "long text of words " * 5000), (4, "<|endoftext|> inside 漢字 ﬁne"), (8, "x" * 3000), (5, "Hello, World! it's 42."),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_equal_whole_texts(library, monkeypatch):
    monkeypatch.setattr(token_files, "SLICE", 15)
    coder, rng = token_files.Coder.of(VOCABULARY), random.Random(8)
    pools = ("abXY 's't've 12 .,!\n\t\x0b\x1c\x00", "äßÄÖéÈñ¡«»–’“…€×÷ x'S \xa0\x85", "aΣẹ́ ̈ <|endoftext|>é漢😀ﬁİſ²ªµ. ")
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(60))) for _ in range(3000)]
    assert [x.tolist() for x in coder.encode(texts)] == [whole(library, x)[:-1] for x in texts]
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    assert [x.tolist() for x in coder.encode(texts[:50])] == [whole(library, x)[:-1] for x in texts[:50]]


def test_query_against_the_library(spark, sf_dir, library):
    found = QUERIES["op13_token_files"](spark, sf_dir).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    start = 0
    for row, (doc, text) in zip(found, docs, strict=True):
        ids = whole(library, text)
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("dictionary", [True, False])
def test_files_and_selective_reads(spark, tmp_path, library, dictionary):
    table = prepare(spark).createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    clashing = table.select("*", *[F.lit("x").alias(c) for c in ("part", "before", "n_tokens", "tokens", "start", "__text_", "ahead")])
    path = f"{tmp_path}/files"
    token_files.write(clashing, path, VOCABULARY, end_id=2, dictionary=dictionary)
    found = token_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [1, 2, 3, 4, 5, 5, 5, 7, 8, None, None]
    assert sorted((str(r.doc_id), list(r.tokens)) for r in found) == sorted((str(d), whole(library, t)) for d, t in ROWS)
    sequence = [i for r in found for i in r.tokens]
    assert [r.start for r in found] == list(np.cumsum([0] + [len(r.tokens) for r in found])[:-1])
    for first, last in ((0, 5), (3, 20_500), (len(sequence) - 4, len(sequence) + 9), (7, 7), (10**9, 10**9 + 5)):
        cut = token_files.window(spark, path, first, last).orderBy("start").collect()
        assert [i for r in cut for i in r.tokens] == sequence[first:last]
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/ids/*.parquet")]
    columns = {m.row_group(0).column(i).path_in_schema: m.row_group(0).column(i) for m in files if m.num_rows for i in range(m.num_columns)}
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    coded = set(columns["tokens.list.element"].encodings)
    assert ("RLE_DICTIONARY" in coded) == dictionary and ("DELTA_BINARY_PACKED" in coded or dictionary)
    assert "DELTA_BINARY_PACKED" in columns["before"].encodings
    plan = token_files.read(spark, path, tokens=False).filter("doc_id = 5")._jdf.queryExecution().toString()
    scans = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line and "before" in line]
    assert scans and all("array<" not in line.split("ReadSchema")[1] for line in scans) and "EqualTo(doc_id,5)" in scans[0]


def test_small_row_groups(spark, tmp_path, sf_dir):
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    token_files.write(docs.coalesce(1), f"{tmp_path}/files", VOCABULARY, end_id=2, row_group_bytes=64 << 10, page_bytes=8 << 10, page_rows=5)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/files/ids/*.parquet")]
    assert sum(m.num_row_groups for m in files) > len(files)


def test_empty_table(spark, tmp_path):
    table = prepare(spark).createDataFrame([], "doc_id long, text string")
    token_files.write(table, f"{tmp_path}/files", VOCABULARY, end_id=2)
    assert token_files.read(spark, f"{tmp_path}/files").count() == 0 and token_files.window(spark, f"{tmp_path}/files", 0, 9).count() == 0
