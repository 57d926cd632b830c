"""Cleaning pipeline over documents: toxicity, line dedup, near-dedup, decontamination, mixing.

Every stage takes what its predecessor kept and returns the columns of documents;
the last adds the words and copies that the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from reviewmill.llm.common import prepare, stored


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity models reject.

    Null and empty texts are scored like any and stay; without labels of both kinds all rows stay; repeated rows
    stay or go together; an empty table stays empty.
    """
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.annotated(docs, labels).filter("toxic_predicted = 0").select(*docs.columns)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines; documents that have lost everything but blanks go. ``n_chars`` follows the text.

    Null, empty and blank texts lose nothing and stay; rows equal in identifier and text lose the same lines.
    """
    prepare(spark)
    found = line_dedup.dedup(docs)
    empty = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = found.filter(~F.coalesce(empty, F.lit(False)))
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def copies_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash of three-word shingles, two differing bits at most.

    Null, empty and blank texts are one group; of rows equal in all columns one stays; an empty table stays empty.
    """
    prepare(spark)
    return simhash.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item. Null and empty texts hold none; an empty benchmark keeps all."""
    return decontaminate.clean(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with their words and copies. Texts without words are not taken; null is a source."""
    prepare(spark)
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out), ("line_dedup", lines_once), ("near_dedup", copies_once),
    ("decontamination", benchmark_out), ("mixing", mixed),
]

#: A classifier fit and 64-bit hashes of shingles have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", (docs,) if place else ())
    return STAGES[-1][1](spark, docs, sf_dir)
