"""What the operators of this subpackage share: stored tables, word rules, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import configure, scratch_path

# A word is a run of characters other than blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings; Arrow batches are bounded by bytes, as texts differ much in length."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def stored(table: DataFrame, name: str, instead_of: tuple[DataFrame, ...] = ()) -> DataFrame:
    """``table`` written to the shared folder and read again, which cuts its lineage.

    ``instead_of`` are tables of this kind that nobody reads once this one is written; their files are deleted.
    """
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    for old in instead_of:
        dropped(old)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table."""
    spark = table.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        if "/reviewmill/" in file:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(table: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores ahead until no column of ``table`` is called so in any case."""
    taken, found = {c.lower() for c in table.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def words(text: Column) -> Column:
    """Array of the words of ``text`` with A-Z lower-cased; empty for null and blank texts."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    return F.filter(F.split(lowered, " "), lambda w: w != "")


def crc32_modulo(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo ``modulus``; null for a null identifier."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges (a, b)``.

    The component is the smallest node that can be reached. Alternating star
    contractions: every node hands its larger neighbours, then its smaller ones,
    to the smallest neighbour, until nothing changes. Each round is written to
    the shared folder; the driver sees a row count and a checksum only. Nodes with
    very many neighbours are pre-aggregated to a minimum, and the joins that hand
    it out are plain equality joins, which the adaptive skew join splits.
    Null ends are ignored; loops and repeated edges do no harm.
    """
    links = stored(edges.filter("a is not null and b is not null and a <> b").select(*_ends()).distinct(), "links")
    seen = None
    while (state := links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()) != seen:
        seen = state
        links = stored(_contract(links), "links", (links,))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _ends() -> list[Column]:
    return [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]


def _contract(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(least.select("u", F.col("m").alias("v"))).distinct()
