"""Line dedup by a deletion-neighbourhood join; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.once import computed_once
from reviewmill.llm.common import fresh, stored

#: Shorter lines have no near copies, equal ones only: one word in five is the most that near copies may differ in.
LEAST_WORDS = 5
#: Places of lines (some 40 bytes each) up to this many are sent to all tasks; beyond that they are joined.
BROADCAST_LINES = 200_000
#: A line that makes up this share of all lines or more is handed out by broadcast; there are ``HOT`` of them at most.
HOT = 1_000
#: Words whose hashes are chained at a time. Longer lines chain block by block, with the same result: one chain
#: copies itself for every word.
BLOCK = 64


def _normal(line: Column) -> Column:
    """The words of a line, one blank between them. Lines that are so already, which are most, are not rebuilt."""
    rough = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | F.contains(line, F.lit("  "))
    for blank in "\t\x0b\x0c\r":
        rough |= F.contains(line, F.lit(blank))
    return F.when(rough, F.trim(F.regexp_replace(line, r"[\x20\x09\x0B-\x0D]+", " "))).otherwise(line)


def _count(normal: Column) -> Column:
    return F.when(normal == "", 0).otherwise(F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit(""))) + 1)


def _halves(normal: Column, n: Column) -> list[Column]:
    """Hashes of the first and last half, for a shorter partner of ``n - 1`` and of ``n`` words.

    If two lines are one word edit apart and the shorter has ``m`` words (or both
    have ``m`` or ``m + 1``), the edit lies behind the first ``m div 2`` words or
    before the last ``m - m div 2``, so they share one of the two hashes for ``m``.
    Null for lines of fewer than ``LEAST_WORDS`` words.
    """
    keys = []
    for m in (n - 1, n):
        first = F.floor(m / 2).cast("int")
        keys += [F.xxhash64(F.lit("first"), m, F.call_function("substring_index", normal, F.lit(" "), first)),
                 F.xxhash64(F.lit("last"), m, F.call_function("substring_index", normal, F.lit(" "), first - m))]
    return [F.when(n >= LEAST_WORDS, k) for k in keys]


def _variants(words: Column) -> Column:
    """Hash keys of the deletion neighbourhood of a line.

    Taking out the i-th word leaves a prefix and a suffix; the key holds both, the
    words that are left, and i. A line also has a key for every gap, as what a
    longer line becomes when the word in that gap is taken out. So lines that share
    a key differ in that one place only. Prefixes and suffixes are hashed by the
    exclusive or of their words, each hashed with its place from that end.
    """
    def chained(hashes: Column) -> Column:
        return F.aggregate(hashes, F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1).bitwiseXOR(x)))

    def joined(blocks: Column) -> Column:
        before = chained(F.transform(blocks, lambda b: F.element_at(b, -1)))
        pairs = F.arrays_zip(blocks.alias("block"), F.slice(before, 1, F.size(blocks)).alias("before"))
        return F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform(
            pairs, lambda p: F.transform(F.slice(p["block"], 2, BLOCK), lambda x: x.bitwiseXOR(p["before"])))))

    def running(hashes: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words), F.lit(BLOCK))
        blocks = F.transform(F.array(hashes), lambda h: F.transform(places, lambda i: chained(F.slice(h, i, BLOCK))))
        return F.when(F.size(words) <= BLOCK, chained(hashes)).otherwise(F.flatten(F.transform(blocks, joined)))

    n = F.size(words)
    prefix = running(F.transform(words, lambda w, i: F.xxhash64(F.lit("p"), w, i)))
    suffix = running(F.transform(F.reverse(words), lambda w, i: F.xxhash64(F.lit("s"), w, i)))
    both = F.struct(n.alias("n"), prefix.alias("p"), suffix.alias("s"))
    return F.flatten(F.transform(F.array(both), lambda x: F.concat(
        F.transform(F.sequence(F.lit(1), x.n), lambda i: F.xxhash64(F.element_at(x.p, i), F.element_at(x.s, x.n - i + 1), x.n - 1, i)),
        F.transform(F.sequence(F.lit(1), x.n + 1), lambda i: F.xxhash64(F.element_at(x.p, i), F.element_at(x.s, x.n - i + 2), x.n, i)))))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one inserted, deleted or replaced word apart."""
    replaced = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda z: z)) <= 1

    def inserted(short: Column, long: Column) -> Column:
        parts = F.zip_with(short, F.slice(long, 1, F.size(short)), lambda x, y: x != y)
        place = F.coalesce(F.nullif(F.array_position(parts, True), F.lit(0)), F.size(short) + 1).cast("int")
        return F.slice(short, place, F.size(short)) == F.slice(long, place + 1, F.size(short))

    return (F.when(F.size(a) == F.size(b), replaced).when(F.size(a) + 1 == F.size(b), inserted(a, b))
            .when(F.size(a) == F.size(b) + 1, inserted(b, a)).otherwise(False))


def _lines(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line that is not blank: its document and place, its normal form and number of words."""
    rows = documents.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The key hashes the whole text, so it must not be computed for every line.
    rows = computed_once(rows, "row", row_key("id", "text"))
    rows = rows.select("id", "row", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    rows = computed_once(rows, "normal", _normal(F.col("line"))).drop("line").filter("normal <> ''")
    return computed_once(rows, "n", _count(F.col("normal")))


def row_key(id_col: str, text_col: str) -> Column:
    """Hash of identifier and text. Rows equal in both are one document."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _order() -> Column:
    """What earlier means: the smaller identifier, null last, then the smaller place."""
    return F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "place")


def _texts(documents: DataFrame, chosen: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``h, h2, first, words`` of the ``chosen`` lines, cut out of their documents only."""
    wanted = chosen.groupBy(F.col("first.row").alias("of")).agg(F.collect_set(F.struct("first", "h", "h2")).alias("wanted"))
    wanted = F.broadcast(wanted) if chosen.count() <= BROADCAST_LINES else wanted
    rows = computed_once(documents.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "row", row_key("id", "text"))
    met = rows.join(wanted, F.col("row") == F.col("of")).select(F.split("text", "\n").alias("lines"), "wanted")
    cut = F.transform("wanted", lambda w: F.struct(w["h"].alias("h"), w["h2"].alias("h2"), w["first"].alias("first"), F.get("lines", w["first"]["place"]).alias("line")))
    found = met.select(F.inline(cut)).dropDuplicates(["h", "h2"])
    return found.select("h", "h2", "first", F.split(_normal(F.col("line")), " ").alias("words"))


def repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, places``: for every document (by ``row_key``) that loses lines, their places from 0 on."""
    names = ["k1", "k2", "k3", "k4"]
    halves = [h.alias(k) for h, k in zip(_halves(F.col("normal"), F.col("n")), names)]
    lines = _lines(documents, id_col, text_col)
    seen = stored(lines.select("id", "row", "place", F.xxhash64("normal").alias("h"), F.xxhash64(F.lit("check"), F.col("normal")).alias("h2"), *halves), "lines")
    distinct = stored(seen.groupBy("h", "h2").agg(
        F.min(_order()).alias("first"), F.count(F.lit(1)).alias("n"), *[F.first(k).alias(k) for k in names]), "distinct-lines")

    halves = distinct.filter("k1 is not null").select("h", "h2", "first", F.explode(F.array_distinct(F.array(*names))).alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("half")
    chosen = stored(halves.join(shared, "half").select("h", "h2", "first").distinct(), "lines-with-partners")
    partners = stored(_texts(documents, chosen, text_col, id_col), "partner-texts", (chosen,))

    keyed = partners.select("h", "h2", "first", F.explode(_variants(F.col("words"))).alias("variant"))
    # Most variants stand alone: they are counted by hash only before anything else is moved.
    twice = keyed.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("variant")
    keyed = stored(keyed.join(twice, "variant"), "shared-variants")
    groups = keyed.groupBy("variant").agg(F.min(F.struct("first", "h", "h2")).alias("best"))
    later = keyed.join(groups, "variant").filter(F.col("best.first") < F.col("first"))
    pairs = later.groupBy("h", "h2").agg(F.min("best").alias("best"))
    own = partners.select("h", "h2", "words")
    earlier = partners.select(F.col("h").alias("eh"), F.col("h2").alias("eh2"), F.col("words").alias("other"))
    near = pairs.join(own, ["h", "h2"]).join(earlier, (F.col("best.h") == F.col("eh")) & (F.col("best.h2") == F.col("eh2")))
    near = stored(near.filter(one_edit(F.col("words"), F.col("other"))).select("h", "h2", F.lit(True).alias("near")), "near-lines")

    known = distinct.join(near, ["h", "h2"], "left").filter(F.col("near") | (F.col("n") > 1)).select("h", "h2", "first", "near", "n")
    known = stored(known, "lines-with-copies", (keyed, partners, distinct))
    # Lines that fill a task by themselves go out by broadcast, HOT of them at most; all others are met in a join.
    least = max(2, seen.count() // HOT)
    hot = F.broadcast(known.filter(F.col("n") >= least))
    rows = seen.select("id", "row", "place", "h", "h2")
    met = rows.join(hot, ["h", "h2"]).unionByName(rows.join(hot, ["h", "h2"], "left_anti").join(known.filter(F.col("n") < least), ["h", "h2"]))
    return met.filter(F.col("near") | (_order() != F.col("first"))).groupBy("row").agg(F.collect_set("place").alias("places"))


def dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``documents`` with repeated lines taken out, plus ``n_lines`` and ``n_removed``.

    Lines are compared by their words. A line is removed if an earlier one, in the
    order of identifier (null last) and place, has the same words or, among lines
    of ``LEAST_WORDS`` words or more, is one inserted, deleted or replaced word
    away. Blank lines always stay.
    Candidates share half a line; their deletion neighbourhoods are joined by hash
    and the edit distance is verified on the words.

    Equal lines are reduced to their first place before anything is joined, and a
    neighbourhood is reduced to its earliest line, so no pairs within a group are
    ever made. A null text stays null with 0 lines; an empty one keeps its one
    empty line. Rows equal in identifier and text count as one document and lose
    the same lines; of rows with a null identifier the order is by a hash. Columns
    named ``n_lines`` or ``n_removed`` are replaced. An empty table stays empty.
    """
    row, places = fresh(documents, "row", "places")
    found = stored(repeats(documents, id_col, text_col), "repeated-lines").toDF(row, places)
    rows = documents.join(found, row_key(id_col, text_col) == F.col(row), "left")
    lines = F.split(text_col, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    rest = F.array_join(F.transform(F.transform(F.array(F.struct(lines.alias("l"), kept.alias("k"))), lambda x: F.transform(x.k, lambda i: F.get(x.l, i)))[0], lambda l: l), "\n")
    carried = [F.col(c) for c in documents.columns if c not in ("n_lines", "n_removed", text_col)]
    return rows.select(
        *carried, F.when(F.col(places).isNull(), F.col(text_col)).otherwise(rest).alias(text_col),
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(F.size(places), F.lit(0)).alias("n_removed"))
