"""Cheapest repair of conversations whose turns are missing, blank, repeated, cut off or out of order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from reviewmill.llm.common import stored

#: Costs of the edits, and of a cut-off turn that stays.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Letters of the edits in ASCII order; a letter's digit is its place here, from 1, and 0 is the padding after the end.
LETTERS = "DIKR"
#: States between turns: nothing yet, after the system turn, after a user turn, after a complete pair.
NONE, SYSTEM, ASKED, PAIR = range(4)
STEPS = {(NONE, "s"): SYSTEM, (NONE, "u"): ASKED, (SYSTEM, "u"): ASKED, (PAIR, "u"): ASKED, (ASKED, "a"): PAIR}
#: The role that a state waits for.
WANTED = {NONE: "u", SYSTEM: "u", ASKED: "a", PAIR: "u"}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Turns of one block at most, and characters of text after which a block ends.
BLOCK, BLOCK_TEXT = 256, 1 << 20
#: Bits of one letter's digit, and inserts that can precede a turn without passing a state twice.
BITS, MOST = 3, 3
BLANKS = " \t\n\x0b\x0c\r"

_TO_DIGITS = str.maketrans(LETTERS, "1234")
_TO_LETTERS = str.maketrans("1234", LETTERS)
_PATH = "array<struct<start:int,stop:int,cost:long,audit:string>>"
_COUNTS = "least long, most long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def weight(cost: int, audit: str, places: int) -> int:
    """One integer that orders like the cost and then the letters: cost in the high digits, letters below, zeros to the end."""
    digits = int(audit.translate(_TO_DIGITS), 8) if audit else 0
    return cost << BITS * places | digits << BITS * (places - len(audit))


def read_weight(value: int, places: int) -> tuple[int, str]:
    digits = value & (1 << BITS * places) - 1
    return value >> BITS * places, f"{digits:o}".zfill(places).rstrip("0").translate(_TO_LETTERS)


def before(cost: int, audit: str, value: int, places: int) -> int:
    """The weight of an edit path (``cost``, ``audit``) followed by one of weight ``value``: all later letters move down."""
    digits = value & (1 << BITS * places) - 1
    return weight(cost + (value >> BITS * places), audit, places) | digits >> BITS * len(audit)


def _least(values: list[int | None]) -> int | None:
    return min((v for v in values if v is not None), default=None)


def back(pattern: str, values: list[int | None], places: int) -> list[int | None]:
    """Least weights from every state ahead of a block, given those after it (None where there is no way).

    ``pattern`` has one letter a turn: ``D`` for one that must go, else the initial of
    its role (``o`` for any other than s, u, a), a capital where the turn is cut off. Turns are taken from the last
    to the first; every state takes the least integer among its edits, then among its inserts.
    """
    width = BITS * places
    low, top = (1 << width) - 1, width - BITS
    letter = {x: (i + 1) << top for i, x in enumerate(LETTERS)}

    def ahead(cost: int, mark: str, value: int | None) -> int | None:
        return None if value is None else (value >> width) + cost << width | letter[mark] | (value & low) >> BITS

    for turn in reversed(pattern):
        extra, role = (CUT if turn.isupper() else 0), turn.lower()
        rows = []
        for s in range(4):
            edits = [ahead(DELETE, "D", values[s])]
            if turn != "D":
                if (s, role) in STEPS:
                    edits.append(ahead(extra, "K", values[STEPS[s, role]]))
                edits.append(ahead(REROLE + extra, "R", values[STEPS[s, WANTED[s]]]))
            rows.append(_least(edits))
        for _ in range(MOST):
            rows = [_least([rows[s], ahead(INSERT, "I", rows[STEPS[s, WANTED[s]]])]) for s in range(4)]
        values = rows
    return values


@lru_cache(maxsize=1 << 14)
def paths(pattern: str) -> tuple[tuple[int, int, int, str], ...]:
    """Cheapest edits of a block between every two states: ``(start, stop, cost, audit)``."""
    places, found = len(pattern) * (1 + MOST), []
    for stop in range(4):
        values = back(pattern, [0 if s == stop else None for s in range(4)], places)
        found += [(s, stop, *read_weight(v, places)) for s, v in enumerate(values) if v is not None]
    return tuple(found)


#: Inserts that complete a conversation in every state: state, state after them, cost, letters.
CLOSING = [(s, PAIR if s else NONE, INSERT * n, "I" * n) for s, n in ((NONE, 0), (SYSTEM, 2), (ASKED, 1), (PAIR, 0))]


@lru_cache(maxsize=1 << 16)
def repair_of(pattern: str) -> tuple[int, str]:
    """Cost and letters of a whole conversation."""
    places = len(pattern) * (1 + MOST) + 2
    return read_weight(back(pattern, [weight(cost, audit, places) for _, _, cost, audit in CLOSING], places)[NONE], places)


def chosen(blocks: list[list]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and letters of a conversation from the paths of its blocks, and of each block its first state and letters.

    The last of the list closes the conversation, with inserts where a pair is open. Weights have the
    digits of the whole conversation here, so that blocks decide as turns do.
    """
    steps = [*blocks, CLOSING]
    places = sum(max((len(p[3]) for p in b), default=0) for b in steps)
    values: list[int | None] = [0, None, None, 0]
    ways = []
    for block in reversed(steps):
        best: list[tuple | None] = [None] * 4
        for start, stop, cost, audit in block:
            if values[stop] is not None:
                value = before(cost, audit, values[stop], places)
                if best[start] is None or value < best[start][0]:
                    best[start] = (value, stop, audit)
        ways.append(best)
        values = [None if b is None else b[0] for b in best]
    state, taken = NONE, []
    for best in reversed(ways):
        _, stop, audit = best[state]
        taken.append((state, audit))
        state = stop
    return values[NONE] >> BITS * places, "".join(a for _, a in taken), taken


def edited(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """``edit, role, text`` of the turns that a block's letters leave, from its first state on."""
    at = 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        initial = roles[at][:1] if letter == "K" else "a" if state == ASKED else "u"
        state = STEPS[state, initial]
        yield letter, roles[at] if letter == "K" else NAMES[initial], "" if letter == "I" else texts[at]
        at += letter != "I"


def ordered(turns: DataFrame, conversations: DataFrame | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, copies, fault`` in order of conversation, turn (nulls first), role and text.

    Equal rows are counted before they are moved. ``copies`` is 0 in the one row that stands for a conversation
    of ``conversations``. ``fault`` is that of the first copy; the others repeat it. A turn repeats an
    earlier one if its role and text (by digest) have a lesser turn number somewhere in the conversation.
    Ranges of the order are dealt to tasks, so a conversation of any size is shared by many.
    """
    space = F.lit(" ")
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, space).alias("role"),
        F.coalesce(text_col, space).alias("text"), F.lit(1).cast("long").alias("copies"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    marked = rows.withColumn("bare", F.length(bare)).filter("bare > 0").withColumn("digest", F.sha2("text", 256))
    number = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = marked.groupBy(F.col("conv").alias("of"), F.col("role").alias("by"), "digest").agg(F.min(number).alias("earliest"))
    if conversations is not None:
        null = F.lit(None)
        rows = rows.union(conversations.select(
            F.col(conv_col), null.cast("long"), null.cast("string"), null.cast("string"), F.lit(0).cast("long")).distinct())
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.withColumn("key", F.when(F.length(bare) > 0, F.sha2("text", 256)))
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("key") == F.col("digest"))
    fault = F.when(F.length(bare) == 0, "blank").when(F.col("earliest") < number, "duplicate") \
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    judged = counted.join(firsts, same, "left").select("conv", "turn", "role", "text", "copies", fault.alias("fault"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role")]
    # Bounds of the ranges hold the beginning of a text only, as they pass through the driver.
    return judged.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")


class _Conversation:
    """One conversation as far as a task has it, cut into blocks as it grows."""

    def __init__(self, key):
        self.key, self.blocks = key, []
        self.clear()

    def clear(self) -> None:
        self.pattern, self.roles, self.texts, self.size = [], [], [], 0
        self.least = self.most = self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str | None) -> None:
        if len(self.pattern) >= BLOCK or self.size >= BLOCK_TEXT:
            self.flush()
        initial = role[:1]
        self._count(turn, initial, fault, 1)
        plain = initial if initial in ("s", "u", "a") else "o"
        self.pattern.append("D" if fault in ("blank", "duplicate") else plain.upper() if fault == "truncated" else plain)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        if copies > 1:
            again = "blank" if fault == "blank" else "duplicate"
            if copies > BLOCK:  # a block of its own, all of it deleted
                self.flush()
                self._count(turn, initial, again, copies - 1)
                self.flush(copies - 1)
            else:
                self._count(turn, initial, again, copies - 1)
                self.pattern += ["D"] * (copies - 1)
                self.roles += [""] * (copies - 1)
                self.texts += [""] * (copies - 1)

    def _count(self, turn, initial, fault, n) -> None:
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        if fault is not None:
            setattr(self, fault, getattr(self, fault) + n)
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (n - 1) * (2 * initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial

    def flush(self, run: int = 0) -> None:
        if run or self.pattern:
            self.blocks.append((
                self.least, self.most, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
                "".join(self.pattern), run, self.roles, self.texts))
            self.clear()

    def rows(self, part: int, number: int, edge: bool) -> list[tuple]:
        """Its blocks, numbered from ``number`` on; one block without paths if there is no turn.

        What is one block only is solved at once; paths are left out where no other task (``edge``) can have more of it.
        """
        self.flush()
        if not self.blocks:
            return [(self.key, part, number, None, None, 0, 0, 0, 0, 0, None, None, [], [], [], 0, "", sha256().hexdigest())]
        found = []
        for i, (*counts, pattern, run, roles, texts) in enumerate(self.blocks):
            cost = audit = digest = None
            ways = []
            if len(self.blocks) == 1 and not run:
                cost, audit = repair_of(pattern)
                digest = digest_of(f"{role}:{text}" for _, role, text in edited(audit, NONE, roles, texts))
            if edge or digest is None:
                ways = [(s, s, DELETE * run, "D" * run) for s in range(4)] if run else paths(pattern)
            found.append((self.key, part, number + i, *counts, [dict(zip(("start", "stop", "cost", "audit"), p)) for p in ways], roles, texts, cost, audit, digest))
        return found


def digest_of(lines: Iterator[str]) -> str:
    digest, first = sha256(), True
    for line in lines:
        digest.update((line if first else "\n" + line).encode("utf-8", "surrogatepass"))
        first = False
    return digest.hexdigest()


def blocks(rows: DataFrame) -> DataFrame:
    """The ordered rows as blocks of turns, numbered by ``part`` and ``n``; ``alone`` is the digest of a conversation of this block only."""
    ids = rows.schema["conv"]
    schema = StructType([ids, *_parsed(f"part int, n long, {_COUNTS}, paths {_PATH}, roles array<string>, texts array<string>, alone_cost long, alone_audit string, alone string")])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, at, edge, ready = TaskContext.get().partitionId(), 0, None, True, []
        for batch in batches:
            for key, turn, role, text, copies, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if at is None or at.key != key:
                    if at is not None:
                        ready += at.rows(part, number, edge)
                        number, edge = ready[-1][2] + 1, False
                    at = _Conversation(key)
                if copies:
                    at.add(turn, role, text, copies, fault)
            if ready:
                yield _batch(ready, arrow)
                ready = []
        if at is not None:
            yield _batch(at.rows(part, number, True), arrow)

    return rows.mapInArrow(run, schema)


def _parsed(ddl: str) -> list[StructField]:
    return list(StructType.fromDDL(ddl).fields)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def decided(table: DataFrame) -> DataFrame:
    """One row a conversation from its stored blocks: counts, cost, letters, digest if it is one block, and ``slices`` for its blocks."""
    schema = StructType([table.schema["conv"], *_parsed(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, alone string, "
        "slices array<struct<part:int,n:long,state:int,audit:string>>")])
    arrow = _arrow(schema)
    dealt = table.drop("roles", "texts").repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "n")

    def summed(key, held: list[tuple]) -> tuple:
        full = [h for h in held if h[9] is not None]
        known = [h for h in full if h[2] is not None]
        turns = sum(h[4] for h in known) - sum(a[3] == b[2] for a, b in zip(known, known[1:]))
        gaps = known[-1][3] - known[0][2] + 1 - turns if known else 0
        illegal = sum(h[8] for h in full) + sum(a[10] + b[9] not in LEGAL for a, b in zip(full, full[1:]))
        alone = held[0][14] if len(held) == 1 else None
        if alone is not None:
            cost, audit = held[0][12:14]
            taken = [(NONE, audit)]
        else:
            cost, audit, taken = chosen([[tuple(p.values()) for p in h[11]] for h in full])
        places = [(h[0], h[1]) for h in full] + [(None, None)]
        slices = [{"part": p, "n": n, "state": s, "audit": a} for (p, n), (s, a) in zip(places, taken)]
        counts = [sum(h[i] for h in full) for i in (5, 6, 7)]
        return key, min(gaps, (1 << 63) - 1), *counts, illegal, cost, audit, alone, slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready = None, [], []
        for batch in batches:
            for conv, *values in zip(*[c.to_pylist() for c in batch.columns]):
                if held and conv != key:
                    ready.append(summed(key, held))
                    held = []
                key = conv
                held.append(tuple(values))
            if ready:
                yield _batch(ready, arrow)
                ready = []
        if held:
            yield _batch([summed(key, held)], arrow)

    return dealt.mapInArrow(run, schema)


def _lines(table: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``conv, part, n, edit, role, text, place`` of the repaired turns of the conversations in ``verdicts``."""
    slices = verdicts.select(F.col("conv").alias("of"), F.explode("slices").alias("s")).select("of", "s.*")
    met = table.select("conv", F.col("part").alias("p"), F.col("n").alias("m"), "roles", "texts").join(
        slices.filter("n is not null"), F.expr("part = p and n = m")).select("conv", "part", "n", "state", "audit", "roles", "texts")
    # The closing inserts follow all blocks.
    closing = slices.filter("n is null and audit <> ''").select(
        F.col("of").alias("conv"), F.lit((1 << 31) - 1).alias("part"), F.lit(0).cast("long").alias("n"), "state", "audit",
        F.array().cast("array<string>").alias("roles"), F.array().cast("array<string>").alias("texts"))
    schema = StructType([table.schema["conv"], *_parsed("part int, n long, place int, edit string, role string, text string")])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, part, n, state, audit, roles, texts in zip(*[c.to_pylist() for c in batch.columns]):
                rows = [(conv, part, n, i, *x) for i, x in enumerate(edited(audit, state, roles, texts))]
                if rows:
                    yield _batch(rows, arrow)

    return met.union(closing).mapInArrow(run, schema)


def _digests(lines: DataFrame) -> DataFrame:
    """``of, digest`` of conversations in several blocks. One hash has one order: a task streams each of these, holding one turn at a time."""
    dealt = lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "n", "place").select("conv", "role", "text")
    schema = StructType([StructField("of", lines.schema["conv"].dataType), *_parsed("digest string")])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if digest is not None and conv != key:
                    yield _batch([(key, digest.hexdigest())], arrow)
                    digest = None
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if digest is None:
                    key, digest = conv, sha256(line)
                else:
                    digest.update(b"\n" + line)
        if digest is not None:
            yield _batch([(key, digest.hexdigest())], arrow)

    return dealt.mapInArrow(run, schema)


def _prepared(turns, conversations, columns) -> tuple[DataFrame, DataFrame]:
    table = stored(blocks(ordered(turns, conversations, *columns)), "conversation-blocks")
    return table, stored(decided(table), "conversation-verdicts")


def audits(turns: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    Turns go by number, nulls first, then by role and text. A turn's first fault counts: blank; duplicate (role and text
    occur earlier); truncated (its last character but blanks is not ``.``, ``!`` or ``?``). ``gaps`` are missing
    turn numbers, ``illegal`` neighbours whose initials are not su, ua or au. ``audit`` are the letters of the
    cheapest edits (Keep, Rerole, Delete, Insert; ties to the ASCII-least) after which the initials read ``(s?(ua)+)?``.

    Null roles and texts count as one space, null identifiers as a conversation of their own. Repeated rows are
    turns like others. ``conversations`` names identifiers that are answered even without any turn: zeros, no letters, the hash of
    nothing. Other columns do not matter; an empty table gives no row. The letters and the hash of a conversation are one value
    each, and so are made in one task; all else of it is shared by blocks of ``BLOCK`` turns.
    """
    table, verdicts = _prepared(turns, conversations, (conv_col, turn_col, role_col, text_col))
    several = verdicts.filter("alone is null")
    digests = _digests(_lines(table, several))
    whole = several.join(digests, F.col("conv").eqNullSafe(F.col("of")), "left").select(
        *several.columns[:8], F.coalesce("digest", F.lit(sha256().hexdigest())).alias("alone"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return verdicts.filter("alone is not null").select("conv", *names, "alone").union(whole).toDF(conv_col, *names, "repaired_sha256")


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns of every conversation after its cheapest edits, as in ``audits``: ``conv_col, block, place, edit, role, text``.

    Turns follow each other by ``block`` and ``place``. Deleted turns are gone, inserted ones (``I``) have no text.
    """
    lines = _lines(*_prepared(turns, None, (conv_col, turn_col, role_col, text_col)))
    return lines.select(F.col("conv").alias(conv_col), F.struct("part", "n").alias("block"), "place", "edit", "role", "text")
