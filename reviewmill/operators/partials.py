"""Additive partial aggregates of the joined view: one scan serves many tables, and later batches merge into it.

The finest partial has one row for each day and product, with counts and sums only. Tables of few
groups are rolled up from it with one bitmap of product numbers for every 32,768 products, so exact distinct counts
merge like sums do: a later day is an ``or`` of bitmaps, never a second look at earlier reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.text import folded_name, is_blank
from reviewmill.functions.times import month_text
from reviewmill.operators.aggregates import label_counts, with_rates
from reviewmill.schemas import LABELS
from reviewmill.session import scratch_path
from reviewmill.settings import MONTH_FORMAT, UNKNOWN_NAME

COUNTS = ("review_count", *[f"{label}_count" for label in reversed(LABELS)], "verified_count")
#: Averages of the serving tables and the columns of the view they are of.
AVERAGES = {"average_rating": "rating", "average_prediction_score": "pred_score", "average_helpful_vote": "helpful_vote"}
SUMS = tuple(f"{c}_{part}" for c in AVERAGES.values() for part in ("sum", "rows"))
ITEM = ("parent_asin", "product_title", "store_name", "main_category")
GRAIN = ("dt", "month_id", *ITEM)


def kept(table: DataFrame, name: str) -> DataFrame:
    """``table`` written to the shared folder and read again."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def product_numbers(view: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``parent_asin, number``: the numbers of ``known`` (none if left out), and the next ones for the other products of ``view``.

    Numbers are dense from 1 on. Products are dealt to ranges, numbered inside each, and moved up by the
    size of the ranges before: one row for each range is all that is summed in order. Null has no number.
    """
    found = view.select("parent_asin").filter("parent_asin is not null").distinct()
    first = 0
    if known is not None:
        found = found.join(known, "parent_asin", "left_anti")
        first = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    placed = kept(found.repartitionByRange("parent_asin").select("parent_asin", F.monotonically_increasing_id().alias("place")), "product-places")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", (F.coalesce(before, F.lit(0)) + first).alias("before"))
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    fresh = placed.withColumn("part", part).join(sizes, "part").select("parent_asin", number.alias("number"))
    return fresh if known is None else known.select("parent_asin", "number").union(fresh)


def daily_partials(view: DataFrame, numbers: DataFrame, month_format: str = MONTH_FORMAT) -> DataFrame:
    """Counts and sums of the view by day and product with its names, and the product's ``number``.

    Reviews are summed before the numbers are joined, so the join moves one row for each day and product.
    """
    rows = view.withColumn("month_id", month_text("review_time", month_format))
    return _counted(rows, *GRAIN).join(numbers, "parent_asin", "left")


def _counted(rows: DataFrame, *grain: str) -> DataFrame:
    sums = [f(F.col(c).cast("double")).alias(f"{c}_{part}") for c in AVERAGES.values() for part, f in (("sum", F.sum), ("rows", F.count))]
    return rows.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("review_count"), *label_counts(),
        F.count(F.when(F.col("verified_purchase"), 1)).alias("verified_count"), *sums)


def _summed() -> list[Column]:
    return [F.sum(c).alias(c) for c in (*COUNTS, *SUMS)]


def bitmaps(partials: DataFrame, *keys: str) -> DataFrame:
    """Mergeable partials by ``keys``: counts, sums and a bitmap of products for every ``bucket`` of 32,768 product numbers.

    For few groups: every group has up to 4 KB for each bucket.
    """
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return partials.groupBy(*keys, bucket).agg(*_summed(), F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("products"))


def merged(one: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Partials of two disjoint sets of reviews, from :func:`bitmaps` by the same keys and product numbers, as those of both."""
    both = one.unionByName(other)
    return both.groupBy(*keys, "bucket").agg(*_summed(), F.bitmap_or_agg("products").alias("products"))


def finished(parts: DataFrame, *keys: str) -> DataFrame:
    """One row for each of ``keys`` from bitmap partials: counts, distinct products, averages and rates."""
    products = F.coalesce(F.sum(F.bitmap_count("products")), F.lit(0)).alias("product_count")
    table = parts.groupBy(*keys).agg(*_summed(), products)
    return _averaged(table.withColumn("review_count", F.coalesce("review_count", F.lit(0))))


def _averaged(table: DataFrame) -> DataFrame:
    means = {name: F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_rows"), F.lit(0)) for name, c in AVERAGES.items()}
    return with_rates(table.withColumns(means).drop(*SUMS))


def overview(parts: DataFrame) -> DataFrame:
    """The overview from bitmap partials without keys."""
    return finished(parts).drop("verified_count", "average_helpful_vote")


def monthly(parts: DataFrame) -> DataFrame:
    """The monthly table from bitmap partials by ``month_id``."""
    return finished(parts, "month_id").drop("verified_count", "average_helpful_vote")


def categories(parts: DataFrame) -> DataFrame:
    """The category table from bitmap partials by ``main_category``: spellings that fold alike are merged."""
    folded = parts.withColumn("category_key", folded_name("main_category"))
    names = folded.groupBy("category_key").agg(F.coalesce(F.min("main_category"), F.lit(UNKNOWN_NAME)).alias("main_category"))
    joint = folded.groupBy("category_key", "bucket").agg(*_summed(), F.bitmap_or_agg("products").alias("products"))
    return finished(joint, "category_key").join(names, "category_key").drop("verified_count", "average_helpful_vote")


def daily(partials: DataFrame) -> DataFrame:
    table = _averaged(partials.groupBy("dt").agg(*_summed()))
    return table.drop("verified_count", "average_helpful_vote", "average_prediction_score")


def stores(partials: DataFrame) -> DataFrame:
    """The store table. There are many stores of few products, so these are counted by rows of (store, product), not bitmaps."""
    pairs = partials.groupBy("store_name", "number").agg(*_summed())
    table = pairs.groupBy(folded_name("store_name").alias("folded")).agg(
        F.coalesce(F.min("store_name"), F.lit(UNKNOWN_NAME)).alias("store_name"), *_summed(), F.count_distinct("number").alias("product_count"))
    keyed = _averaged(table).withColumn("store_key", F.sha2("folded", 256))
    return keyed.drop("folded", "verified_count", "average_helpful_vote")


def products(partials: DataFrame) -> DataFrame:
    grain = [c for c in GRAIN if c not in ("dt", "month_id")]
    table = _averaged(partials.filter(~is_blank("parent_asin")).groupBy(*grain).agg(*_summed()))
    return table.withColumn("verified_purchase_rate", safe_rate("verified_count", "review_count")).drop("verified_count")


def distinct_products(parts: DataFrame) -> DataFrame:
    """Distinct products of bitmap partials without keys."""
    return parts.agg(F.coalesce(F.sum(F.bitmap_count("products")), F.lit(0)).alias("distinct_products"))


def item_partials(view: DataFrame) -> DataFrame:
    """Counts and sums of the view by product with its names, days together: as many rows as there are products, however many reviews."""
    return _counted(view, *ITEM)


def months(view: DataFrame, month_format: str = MONTH_FORMAT) -> DataFrame:
    """The monthly table straight from the view: summed by month and product, of which the products of a month are the rows."""
    pairs = _counted(view.withColumn("month_id", month_text("review_time", month_format)), "month_id", "parent_asin")
    table = pairs.groupBy("month_id").agg(*_summed(), F.count("parent_asin").alias("product_count"))
    return _averaged(table).drop("verified_count", "average_helpful_vote")


#: Serving tables by the partials that they are made of.
OF_ITEMS = ("dws_sentiment_overview", "dws_product_sentiment", "dws_category_sentiment", "dws_store_sentiment")
OF_DAYS, OF_MONTHS = ("dws_sentiment_daily",), ("dws_monthly_sentiment",)


def serving_tables(view: DataFrame, *names: str) -> dict[str, DataFrame]:
    """The named ones of the six tables that partials give, all if none is named.

    A day and product have hardly more than one review, so partials of that grain are as large as the view. Where all reviews are at hand,
    tables by product come from partials by product (written once), the others from sums of their own grain.
    """
    names = names or (*OF_ITEMS, *OF_DAYS, *OF_MONTHS)
    made = {}
    if set(names) & set(OF_ITEMS):
        counted = kept(item_partials(view), "item-partials")
        items = counted.join(product_numbers(counted), "parent_asin", "left")
        made |= {
            "dws_sentiment_overview": overview(bitmaps(items)), "dws_product_sentiment": products(counted),
            "dws_category_sentiment": categories(bitmaps(items, "main_category")), "dws_store_sentiment": stores(items),
        }
    if set(names) & set(OF_DAYS):
        made["dws_sentiment_daily"] = daily(_counted(view, "dt"))
    if set(names) & set(OF_MONTHS):
        made["dws_monthly_sentiment"] = months(view)
    return {name: made[name] for name in names}
