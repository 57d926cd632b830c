"""Conversation repair against a search over all edits, and against itself in small blocks."""

import random
import re
import zlib
from hashlib import sha256
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import conversation_repair as repair
from reviewmill.llm.common import prepare
from reviewmill.llm.queries import QUERIES, damaged

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def plain(rows):
    """One conversation by a forward search that keeps all letters as text: best (cost, letters, lines) of every state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, letters, lines) in list(best.items()):
                for r in "ua":
                    if (state, r) in steps:
                        put(best, steps[state, r], (cost + 5, letters + "I", lines + [names[r] + ":"]))
        return best

    def put(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, letters, lines) in inserted(best).items():
            put(new, state, (cost + 2, letters + "D", lines))
            if fault in ("b", "d"):
                continue
            extra = 5 if fault == "t" else 0
            if (state, role[:1]) in steps:
                put(new, steps[state, role[:1]], (cost + extra, letters + "K", lines + [f"{role}:{text}"]))
            for r in "ua":
                if (state, r) in steps:
                    put(new, steps[state, r], (cost + 1 + extra, letters + "R", lines + [f"{names[r]}:{text}"]))
        best = new
    best = inserted(best)
    cost, letters, lines = min((best[s] for s in ("", "p") if s in best), key=lambda v: v[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, sha256("\n".join(lines).encode()).hexdigest()


def conversations(rng, count, most=9):
    for conv in range(count):
        for i in range(rng.randrange(1, most)):
            turn = rng.choice((i, i, i, i + 1, None))
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", None, "", "auditor"))
            text = rng.choice(("Yes.", "No!", "What?", "cut off", " \n", "", None, f"Turn {rng.randrange(9)}.", "Yes. \t", "a.b", "é…"))
            yield (None if conv == 7 else conv, turn, role, text)


def expected(rows):
    groups = {c: [] for c, *_ in rows}
    for conv, *row in damage(rows):
        groups[conv].append(tuple(row))
    return {c: plain(g) for c, g in groups.items()}


def test_forward_search_is_least_of_all_edits():
    """The forward search of these tests against every string of edits, on tiny conversations."""
    rng = random.Random(2)

    def every(rows):
        faults, seen = [], set()
        for role, text in rows:
            faults.append("b" if not text.strip() else "d" if (role, text) in seen else "t" if text.strip()[-1] not in ".!?" else "")
            seen.add((role, text))
        found = []

        def walk(at, roles, cost, letters):
            if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, letters))
            if len(letters) - at < 2:
                walk(at, roles + "u", cost + 5, letters + "I")
                walk(at, roles + "a", cost + 5, letters + "I")
            if at < len(rows):
                walk(at + 1, roles, cost + 2, letters + "D")
                if faults[at] not in ("b", "d"):
                    extra = 5 if faults[at] else 0
                    walk(at + 1, roles + (rows[at][0][:1] or "?"), cost + extra, letters + "K")
                    for r in "ua":
                        walk(at + 1, roles + r, cost + 1 + extra, letters + "R")

        walk(0, "", 0, "")
        return min(found)

    for _ in range(120):
        rows = [(rng.choice(("user", "assistant", "system", "x")), rng.choice(("Hi.", "Hm", "So?", "", "No."))) for _ in range(rng.randrange(5))]
        cost, letters = plain([(i, *r) for i, r in enumerate(rows)])[5:7]
        assert (cost, letters) == every(rows)


@pytest.mark.parametrize("block", [256, 2])
def test_audits_against_a_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(6)
    rows = list(conversations(rng, 150)) + [(900, i % 40, "user", f"Same {i % 5}.") for i in range(300)] + [(901, 3, "user", "Copied.")] * 40
    given = prepare(spark).createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit("x").alias(c) for c in ("conv", "copies", "fault", "kind", "copy")])
    found = {r.conv_id: tuple(r)[1:] for r in repair.audits(damaged(given), given).collect()}
    assert found == expected(rows)


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(1, i // 2, rng.choice(("user", "assistant", "system")), f"{rng.choice(('What', 'So', 'Well'))} {rng.randrange(3000)}{rng.choice('.!? ')}") for i in range(4000)]
    given = prepare(spark).createDataFrame(rows, SCHEMA).repartition(6)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = repair.blocks(repair.ordered(damaged(given), given, "conv_id", "turn", "role", "text")).select("part").distinct().count()
        found = {r.conv_id: tuple(r)[1:] for r in repair.audits(damaged(given), given).collect()}
        lines = repair.repaired(damaged(given)).orderBy("block", "place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert table > 1 and found == expected(rows)
    assert sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest() == found[1][-1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines))


def test_weights_order_like_cost_and_letters():
    rng = random.Random(3)
    pairs = [(rng.randrange(3), "".join(rng.choice("DIKR") for _ in range(rng.randrange(5)))) for _ in range(300)]
    assert sorted(pairs) == sorted(pairs, key=lambda p: repair.weight(*p, 6)) and all(repair.read_weight(repair.weight(*p, 6), 6) == p for p in pairs)
    for cost, letters in pairs[:50]:
        for after in pairs[:20]:
            assert repair.read_weight(repair.before(cost, letters, repair.weight(*after, 9), 9), 9) == (cost + after[0], letters + after[1])


def test_inserts_where_they_are_cheap(monkeypatch):
    """With other costs inserts win; the block form has to agree with the whole."""
    monkeypatch.setattr(repair, "DELETE", 9)
    repair.paths.cache_clear()
    repair.repair_of.cache_clear()
    try:
        rng = random.Random(9)
        for _ in range(150):
            pattern = "".join(rng.choice("suaoSUAD") for _ in range(rng.randrange(1, 12)))
            cut = rng.randrange(len(pattern) + 1)
            parts = [list(repair.paths(p)) for p in (pattern[:cut], pattern[cut:]) if p]
            assert repair.chosen(parts)[:2] == repair.repair_of(pattern)
    finally:
        repair.paths.cache_clear()
        repair.repair_of.cache_clear()


def test_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()} == expected(rows)


def test_edges(spark):
    table = prepare(spark).createDataFrame([(1, 0, "user", "x"), (None, None, None, None)], SCHEMA)
    assert repair.audits(table.limit(0)).count() == 0
    nothing = repair.audits(table.limit(0), table).collect()
    assert {tuple(r) for r in nothing} == {(c, 0, 0, 0, 0, 0, 0, "", sha256().hexdigest()) for c in (1, None)}
    assert [k for k, _ in groupby(sorted(str(r.conv_id) for r in repair.audits(table).collect()))] == ["1", "None"]
    assert repair.repaired(table).count() == 0
