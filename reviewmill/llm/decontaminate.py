"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact shingle similarity.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.once import computed_once
from reviewmill.llm.common import fresh, stored

SHINGLE = 5
#: Weighted Jaccard similarity of shingles from which a window counts as a copy of an item.
SIMILARITY = 0.8
#: Differing bits up to which a window's fingerprint counts as near. Two texts of similarity 0.8 share 8/9 of
#: their shingles each, which turns 10 of 64 bits on average, with a standard deviation of 3.
RADIUS = 20
#: Every STRIDE-th shingle of a text is looked up. A window of similarity 0.8 lacks one in nine of its
#: shingles at most, so at least one of those looked up in it is shared, for items of STRIDE shingles or more.
STRIDE = 4
#: All shingles of texts up to this many words are looked up, as they may be shorter than an item.
SHORT = 64
#: Keys up to this many (8 bytes each) are sent to all tasks; beyond that they are joined.
BROADCAST_KEYS = 2_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column, stride: Column) -> Column:
    """Hash of the five words from every ``stride``-th place on; empty if there are fewer than five words."""
    places = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1, stride)
    return F.when(F.size(words) >= SHINGLE, F.transform(places, lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _fingerprint(shingles: Column) -> Column:
    """SimHash: a bit is set if over half of the shingles, repeats included, have it."""
    def bit(b: Column) -> Column:
        having = F.size(F.filter(shingles, lambda h: F.call_function("shiftrightunsigned", h, b).bitwiseAND(1) == 1))
        return F.when(2 * having > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _blocks(mark: Column, radius: int) -> Column:
    """The fingerprint in ``radius + 1`` blocks, each with its number. Marks within the radius share one."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*[
        F.shiftrightunsigned(mark, a).bitwiseAND((1 << (b - a)) - 1).bitwiseOR(F.lit(i << 33)) for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def _weighted(shingles: Column) -> Column:
    """Shingles with the number of their repeat, so that plain sets compare weights."""
    numbered = F.transform(shingles, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(shingles, 1, i + 1), lambda x: x == h))))
    single = F.transform(shingles, lambda h: F.xxhash64(h, F.lit(1)))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), single).otherwise(numbered)


def indexed(items: DataFrame, id_col: str, text_col: str, radius: int) -> DataFrame:
    """One row per distinct item text of five words or more: identifier, size, shingles, fingerprint, blocks."""
    texts = items.filter(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("text")).agg(F.min(id_col).alias("item_id"))
    rows = computed_once(computed_once(texts, "words", _words(F.col("text"))), "shingles", _shingles(F.col("words"), F.lit(1)))
    rows = computed_once(rows.filter(F.size("shingles") > 0), "mark", _fingerprint(F.col("shingles")))
    return rows.select("item_id", F.xxhash64("text").alias("item"), F.size("words").alias("n"), "shingles",
                       _weighted(F.col("shingles")).alias("weighted"), "mark", _blocks(F.col("mark"), radius).alias("blocks"))


def _looked_up(table: DataFrame, keys: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join whose small side is broadcast only after it has been counted."""
    return table.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, on, how)


def leaks(documents: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
          similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``key, item_id, similarity, start`` by distinct text (its hash ``key``) and item that it holds.

    Windows of an item's size are taken where a looked-up shingle of the text lies
    in an item, aligned with it and moved inside the text; SimHash marks window and
    item; blocks of the marks find all pairs within the radius, and the exact
    weighted similarity of all their shingles decides. ``start`` is the first word
    of the best window, the earliest of equals.
    """
    index = stored(indexed(items, item_id_col, item_text_col, radius), "items")
    least = index.agg(F.min(F.size("shingles"))).first()[0]
    stride = STRIDE if least is not None and least >= STRIDE else 1
    # All offsets of a shingle that an item repeats: each aligns another window.
    places = index.select("item", F.posexplode("shingles").alias("offset", "shingle"))
    places = stored(places.join(index.select("item", "n"), "item"), "item-shingles")

    keyed = documents.filter(F.col(text_col).isNotNull()).select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    split = computed_once(keyed, "words", _words(F.col("text"))).select("key", "words").filter(F.size("words") >= SHINGLE)
    step = F.when(F.size("words") <= SHORT, 1).otherwise(stride)
    sampled = split.select("key", F.size("words").alias("size"), step.alias("step"), F.posexplode(_shingles(F.col("words"), step)).alias("at", "shingle"))
    hits = _looked_up(sampled, places, "shingle")
    start = F.greatest(F.lit(0), F.least(F.col("at") * F.col("step") - F.col("offset"), F.col("size") - F.col("n")))
    hits = stored(hits.select("key", "item", "n", start.alias("start")).distinct(), "leak-windows")

    texts = _looked_up(keyed, hits.select("key").distinct(), "key").dropDuplicates(["key"])
    texts = stored(texts.select("key", _words(F.col("text")).alias("words")), "leak-texts")
    # Windows are cut out before the second join, so that it never moves whole texts.
    windows = computed_once(texts.join(hits, "key"), "window", F.slice("words", F.col("start") + 1, F.col("n")))
    windows = windows.select("key", "item", "start", "window").join(index.drop("n", "shingles"), "item")
    windows = computed_once(windows, "own", _shingles(F.col("window"), F.lit(1)))
    windows = computed_once(windows.drop("window"), "own_mark", _fingerprint(F.col("own")))
    near = windows.filter(F.arrays_overlap(_blocks(F.col("own_mark"), radius), "blocks")) \
        .filter(F.bit_count(F.col("own_mark").bitwiseXOR(F.col("mark"))) <= radius)
    near = computed_once(near, "shared", F.size(F.array_intersect(_weighted(F.col("own")), "weighted")))
    value = F.col("shared") / (F.size("own") + F.size("weighted") - F.col("shared"))
    best = near.select("key", "item_id", value.alias("similarity"), "start").filter(F.col("similarity") >= similarity) \
        .groupBy("key", "item_id").agg(F.max(F.struct("similarity", -F.col("start"))).alias("best"))
    return best.select("key", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.col2")).alias("start"))


def contaminated(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, start`` for every document row and item it holds; clean documents have no row.

    Of items with equal texts the smallest identifier is named. Items and texts of
    fewer than five words, null or empty, take no part. Rows with a null identifier
    are reported under null; repeated rows are reported as often as they occur;
    extra columns are not carried; empty tables give no rows.
    """
    found = stored(leaks(documents, items, text_col, item_id_col, item_text_col, similarity), "leaks")
    rows = documents.filter(F.col(text_col).isNotNull()).select(F.col(id_col), F.xxhash64(text_col).alias("key"))
    return rows.join(found, "key").select(id_col, "item_id", "similarity", "start")


def clean(documents: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, whose text holds no item.

    Null and empty texts hold none and stay; repeated rows stay or go together; columns may have any
    names; an empty table of items keeps all rows.
    """
    leak, = fresh(documents, "leak")
    found = stored(leaks(documents, items, text_col).select(F.col("key").alias(leak)).distinct(), "leaks")
    return documents.join(found, F.xxhash64(text_col) == F.col(leak), "left_anti")
