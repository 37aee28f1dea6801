"""Conversation repair against a plain search over edits, and odd inputs."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conformkit.llm import turn_repair
from conformkit.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines): Dijkstra over (cost, audit so far), on whole strings."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, seq, lines = heapq.heappop(heap)
        shape = "" if not seq else ("s" if seq == "s" else seq[-1])
        if (i, shape) in seen:
            continue
        seen.add((i, shape))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", seq):
            return cost, audit, list(lines)
        wanted = "assistant" if shape == "u" else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", i, seq + wanted[0], (*lines, wanted + ":")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, seq, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] == wanted[0] or role[:1] == "s" and not seq:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, seq + role[0], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, seq + wanted[0], (*lines, f"{wanted}:{text}")))
    raise AssertionError


def plain_repair(original, rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn, role, text))
    out = set()
    for conv in {r[0] for r in original}:
        seen, coded, count = set(), [], defaultdict(int)
        turns = sorted(of[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        for _, role, text in turns:
            ends = re.sub(r"[\x20\x09-\x0D]*\Z", "", text)
            fault = ("blank" if not ends else "duplicate" if (role, text) in seen
                     else "truncated" if ends[-1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] += 1
            coded.append((role, text, fault))
        starts = [r[0][:1] for r in coded]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit, lines = cheapest(coded)
        out.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def check(spark, rows, block=turn_repair.BLOCK):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "code", "cost", "copy", "salt")})
    damaged = turn_repair.damaged(df)
    assert sorted(map(repr, map(tuple, damaged.drop("copy").collect()))) == sorted(map(repr, plain_damage(rows)))
    got = [tuple(r) for r in turn_repair.repair(df, damaged, block).collect()]
    want = plain_repair(rows, plain_damage(rows))
    assert len(got) == len(want) and set(got) == want


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in turn_repair.op13_turn_repair(spark, SF).collect()]
    want = plain_repair(rows, plain_damage(rows))
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("block", [turn_repair.BLOCK, 3, 1])
def test_random_conversations(spark, block):
    rng = random.Random(block)
    roles = ["user", "assistant", "system", "tool", "", "u", None]
    texts = ["Yes.", "No!", "and", "", " \n", "Why? ", "x. y", None, "é…", "ok."]
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(0, 14)):
            text = rng.choice(texts)
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), rng.choice(roles[:rng.choice([2, 3, 7])]),
                         f"{text} {turn}." if text and rng.random() < 0.7 else text))
    check(spark, rows, block)


def test_odd_rows(spark):
    long_text = "word " * 200_000
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (1, None, "user", "a."), (1, None, None, None),
            (2, None, "user", "b."), (3, 5, "user", long_text), (3, 6, "assistant", long_text + "."),
            (4, 1, "user", "same."), (4, 1, "user", "same."), (4, 2, "assistant", "z."), (5, -3, "system", "s."),
            (5, 9, "user", "q?")]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair(empty, turn_repair.damaged(empty)).count() == 0


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["a.", "b", "c.", f"{t}.", f"{t}!", ""]))
            for t in range(900)]
    check(spark, rows + [(8, 0, "user", "a."), (8, 1, "assistant", "b.")], 64)
