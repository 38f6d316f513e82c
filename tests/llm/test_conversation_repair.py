"""Conversation repair against a search over all edits."""

import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfline.llm import conversation_repair as cr
from shelfline.llm.queries import QUERIES
from tests.conftest import SMALL

ROWS = "conv_id long, turn long, role string, text string"


def search(rows):
    """(cost, least audit, repaired turns) by trying every edit; at most two
    turns are ever inserted in a row."""
    @lru_cache(None)
    def best(i, seen, inserted):
        options = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "ua"[:0] if not seen else {"s": "s", "u": "u", "a": "ua"}[seen]):
            options.append((0, "", ()))
        expected = "a" if seen == "u" else "u"
        def then(cost, letter, turn, j, after, ins):
            c, audit, turns = best(j, after, ins)
            options.append((c + cost, letter + audit, ((turn,) if turn else ()) + turns))
        name = {"u": "user", "a": "assistant"}[expected]
        if inserted < 2:
            then(2, "I", (name, ""), i, expected, inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            then(3, "D", None, i + 1, seen, 0)
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                then(2 + extra, "R", (name, text), i + 1, expected, 0)
                if role[:1] == expected or (role[:1] == "s" and seen == ""):
                    then(extra, "K", (role, text), i + 1, role[:1], 0)
        return min(options, default=(10 ** 9, "~", ()))
    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def by_hand(table, damage):
    """Reports of conversations given as (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        convs[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        judged, seen, n = [], set(), defaultdict(int)
        for _, role, text in rows:
            core = text.strip("\t\n\x0b\x0c\r ")
            fault = ("blank" if not core else "duplicate" if (role, text) in seen else
                     "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
            n[fault] += 1
            judged.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, turns = search(tuple(judged))
        repaired = "\n".join(f"{r}:{t}" for r, t in turns)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    sha256(repaired.encode()).hexdigest(), repaired))
    return sorted(out, key=repr)


def reports(df):
    key = F.when(F.col("key") != " ", F.col("key")).cast("long")
    return sorted(map(tuple, df.select(key, *[c for c in df.columns if c != "key"]).collect()), key=repr)


def test_query_by_hand(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, SMALL).collect()), key=repr)
    assert got == [r[:-1] for r in by_hand(table, True)]
    assert any(r[7].strip("K") for r in got)


def made_up(seed, convs=40, longest=14):
    """Conversations with every fault, equal turns, null fields and odd roles."""
    rng = random.Random(seed)
    texts = ["yes.", "no", "why? ", "", " \t", None, "ok!", "same", "É.", "　"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv in range(convs):
        for i in range(rng.randrange(1, longest)):
            turn = rng.choice([i, i, i, i, i + rng.randrange(3), None])
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts) if rng.random() < .6 else f"t {conv} {i}."))
    return rows + rows[:4]


@pytest.mark.parametrize("block, damage", [(2, False), (3, True), (4096, True)])
def test_repair_against_search(spark, block, damage):
    """Blocks of a few rows run the same conversations through the matrices."""
    table = made_up(block)
    df = spark.createDataFrame(table, ROWS).repartition(5).withColumns(
        {c: F.lit("clash") for c in ("key", "live", "initial", "pos", "block", "copy", "draw")})
    rows = cr.rows_of(df)
    rows = cr.damaged(rows) if damage else rows
    wanted = by_hand(table, damage)
    assert reports(cr.audits(rows, block)) == [r[:-1] for r in wanted]
    turns = defaultdict(list)
    for r in cr.repaired(rows, block).collect():
        turns[r.key].append((r.pos, r.n, f"{r.role}:{r.text}"))
    for conv, *_, text in wanted:
        assert "\n".join(t for _, _, t in sorted(turns.get(" " if conv is None else str(conv), []))) == text


def test_one_conversation_of_most_rows(spark):
    """Blocks of blocks: 300 rows in blocks of 4, beside short ones."""
    rng = random.Random(5)
    table = [(7, i, rng.choice(["user", "assistant", "assistant"]), f"line {i % 90}" + rng.choice([".", "!", ""])) for i in range(300)]
    table += [(8, 0, "user", "x" * 400_000 + "."), (8, 1, "assistant", "fine.")]
    rows = cr.damaged(cr.rows_of(spark.createDataFrame(table, ROWS)))
    assert reports(cr.audits(rows, 4)) == [r[:-1] for r in by_hand(table, True)]


def test_defined_cases(spark):
    empty = spark.createDataFrame([], ROWS)
    assert cr.audits(cr.rows_of(empty)).collect() == []
    assert cr.repaired(cr.rows_of(empty)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = [(gone, 0, "user", "all rows are dropped.")] * 3
    rows = cr.damaged(cr.rows_of(spark.createDataFrame(table, ROWS)))
    assert reports(cr.audits(rows)) == [(gone, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
    assert cr.audits(cr.rows_of(spark.createDataFrame([(1, 0, "user", "hi.")], ROWS))).first().audit == "KI"
    ties = cr.audits(cr.rows_of(spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "assistant", "b.")], ROWS))).first()
    assert (ties.cost, ties.audit) == (2, "RK")
