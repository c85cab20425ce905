"""Conversation repair against all edit sequences, and on odd input."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from obsgrid.llm import conversations as C
from obsgrid.llm.catalog import QUERIES
from obsgrid.llm.common import table
from tests.conftest import SF001

LEGAL = re.compile(r"(s?(ua)+)?")


def all_edits(rows):
    """The best of every edit sequence, tried one by one: rows are (role, text, fault). Two inserts in a row never pay in the middle,
    so at most two stand before each row and at the end."""
    best = None
    per_row = []
    for role, text, fault in rows:
        own = [("D", 2, None)]
        if fault in ("clean", "truncated"):
            more = 5 if fault == "truncated" else 0
            own += [("K", more, (role, text))] + [("R", 1 + more, (r, text)) for r in ("user", "assistant")]
        per_row.append(own)
    inserts = [()] + [p for n in (1, 2) for p in itertools.product(("user", "assistant"), repeat=n)]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 3:
            continue
        for edits in itertools.product(*per_row):
            made, audit, cost = [], "", 0
            for gap, edit in zip(gaps, (*edits, None), strict=True):
                made += [(r, "") for r in gap]
                audit += "I" * len(gap)
                cost += 5 * len(gap)
                if edit:
                    audit += edit[0]
                    cost += edit[1]
                    made += [edit[2]] if edit[2] else []
            if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in made)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in made)
    return best


def faults(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "clean"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    """Expected result rows for (conv_id, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x, t) for c, t, r, x, n in rows if c == conv
                      for _ in range(n)), key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = [r[4] for r in own if r[4] is not None]
        judged = faults([(r[2], r[3]) for r in own])
        count = [sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, text = all_edits(judged)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def ours(spark, rows, block):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    df = df.select("*", *[F.lit(9).alias(c) for c in ("copies", "fault", "nth", "cost", "audit")])
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in C.repair(df, F.col("n"), block).collect()}


@pytest.mark.parametrize("block", [1, 2, 64])
def test_against_all_edits(spark, block):
    rng = random.Random(block)
    rows = []
    for conv in range(120):
        for turn in range(rng.choice([0, 1, 2, 3, 4, 4])):
            at = rng.choice([turn, turn, 3 * turn, None, 1])
            rows.append((conv, at, rng.choice(["user", "assistant", "system", "usher", "tool", "", None, "assistant", "user"]),
                         rng.choice(["Yes.", "No!", "é?", "cut", "", " \t", None, f"t{conv % 7}.", "end.\n "]), 1))
    rows += [(500, 1, "user", "only named", 0), (None, 2, "assistant", "a.", 1), (None, 1, "user", "b.", 2), (501, 2, "user", "x", 2),
             (502, None, "user", "q.", 1), (502, None, "assistant", "r.", 1), (503, -2**62, "user", "q.", 1), (503, 2**62, "assistant", "r.", 1)]
    assert ours(spark, rows, block) == brute(rows)


def test_blocks_do_not_show(spark):
    """Long conversations give the same repair in blocks of different size; the dynamic program over places is the second opinion."""
    rng = random.Random(4)
    for weights in ([1, 5, 5, 1], [0, 1, 0, 0], [1, 1, 1, 5]):
        rows = [(rng.choices("suax", weights)[0], rng.choices(range(4), [6, 1, 1, 2])[0]) for _ in range(700)]
        results = set()
        for block in (1, 7, 64):
            own = C.Repair(block)
            for i, (role, fault) in enumerate(rows):
                own.add(i, role, "t.", fault)
            results.add(own.result())
        assert len(results) == 1
        best = {C.START: (0, "")}
        for role, fault in rows:
            best = _inserted(best)
            new = {}
            for place, (cost, audit) in best.items():
                for c, letter, to in C._branches(place, role, fault):
                    new[to] = min(new.get(to, (10**9, "")), (cost + c, audit + letter))
            best = new
        best = _inserted(best)
        (_, _, _, _, _, cost, audit, _), = results
        assert (cost, audit) == min(best[p] for p in (C.START, C.AFTER_A) if p in best)


def _inserted(best):
    best = dict(best)
    for _ in range(2):
        for place, (cost, audit) in list(best.items()):
            to = C._NEXT[place][0]
            best[to] = min(best.get(to, (10**9, "")), (cost + 5, audit + "I"))
    return best


def test_hot_conversation_and_empty_table(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}." + "x" * (100_000 if i == 3 else 0) + ".", 1) for i in range(3000)]
    rows += [(2, 0, "user", "same.", 1)] * 500
    found = ours(spark, rows, 64)
    assert found[1][:7] == (0, 0, 0, 0, 0, 0, "K" * 3000)
    assert found[1][7] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t, _ in rows[:3000]).encode()).hexdigest()
    assert found[2][2] == 499 and found[2][5] == 500 * 2
    assert ours(spark, [], 64) == {}


def test_query_damages_and_repairs(spark):
    rows = []
    for r in table(spark, SF001, "conversations").collect():
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = " " if r.text is None else r.text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows.append((r.conv_id, r.turn, "user" if kind == 4 else r.role, text, {0: 0, 3: 2}.get(kind, 1)))
    short = {c for c in {r[0] for r in rows} if sum(r[4] for r in rows if r[0] == c) <= 4}
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, SF001).collect()}
    assert set(found) == {r[0] for r in rows}
    expected = brute([r for r in rows if r[0] in short])
    assert len(expected) > 5 and {c: found[c] for c in expected} == expected
