"""Conversation repair: the cheapest edits that make turns alternate, by depth-first branch and bound.

A conversation is legal if its role initials, in order of turn, read
``(s?(ua)+)?``. Its rows can be kept (K, cost 0), given the role user or
assistant (R, 1) or deleted (D, 2), and empty user or assistant rows inserted
anywhere (I, 5). Blank and duplicate rows must be deleted; a truncated row that
stays adds 5. Of the cheapest edits, those whose initials in order are least in
ASCII are taken.

The search walks nodes (rows done, place in the pattern) depth first on an
explicit stack, cheapest branch first. A table holds the best prefix (cost,
audit) that reached each node: a worse one is dropped, whatever came later. A
prefix also ends where its cost and the least cost of the rows left (0 for a
clean row, 2 for a faulty one) exceed the incumbent's. Two prefixes of one
node and cost are never one the start of the other (that would take an insert,
which costs), so comparing them decides every continuation.

Rows reach a task dealt and sorted by conversation, and stream through it: the
search runs over blocks of ``BLOCK`` rows, and between blocks only the best
prefix for each place in the pattern is held, with the hash of its repaired text
so far. A conversation is never gathered; a task holds one block of rows and
the ends of four audits. Its rows share one task, as the repaired text's SHA-256 and the
order ask for one reader; that reader's memory does not grow with it, apart
from the audit, which is the result's own.

Defined results: a NULL reads as one space in role and text; rows with a NULL
turn come first, rows of one turn in order of role and text. A NULL
conversation id is a conversation. Repeated rows are duplicates. A conversation
without rows has zeros, an empty audit and the hash of the empty string. An
empty table gives no rows. Gaps ignore NULL turns; a span beyond a long counts
as the largest long. Columns beside the four named are neither read nor
returned.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
#: rows of a conversation that are searched at once; the search may take far more than linear time in them
BLOCK = 64
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
#: places in the pattern: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
PLACES = (START, AFTER_S, AFTER_U, AFTER_A)
#: the place and the role that a user or assistant row leads to
_NEXT = {START: (AFTER_U, "user"), AFTER_S: (AFTER_U, "user"), AFTER_U: (AFTER_A, "assistant"), AFTER_A: (AFTER_U, "user")}
_WHITE = r"[\x20\x09-\x0D]"

#: a prefix: (cost, audit)
Prefix = tuple[int, str]


def _branches(place: int, initial: str, fault: int) -> list[tuple[int, str, int]]:
    """(cost, letter, next place) of each edit of a row."""
    out = [(DELETE, "D", place)]
    if fault in (CLEAN, TRUNCATED):
        more = CUT_SHORT if fault == TRUNCATED else 0
        to, role = _NEXT[place]
        out.append((REROLE + more, "R", to))
        if initial == role[0]:
            out.append((KEEP + more, "K", to))
        elif initial == "s" and place == START:
            out.append((KEEP + more, "K", AFTER_S))
    return out


def search(rows: Sequence[tuple[str, int]], begin: dict[int, Prefix], last: bool) -> dict[int, Prefix]:
    """Best prefixes after ``rows`` (initial, fault), by place, from the best prefixes before them.

    ``last``: the rows end their conversation, so only the places where the pattern may end count, together.
    """
    n = len(rows)
    least = [0] * (n + 1)                               # of the rows from i on: the cost that no edits undercut
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (0 if rows[i][1] == CLEAN else DELETE)
    best: dict[tuple[int, int], Prefix] = {}            # dominance: the best prefix that reached a node
    ends = (START, AFTER_A) if last else PLACES
    found: dict[int, Prefix] = {}
    incumbent: Prefix | None = None                     # where last: the best way through; else: the dearest of all places' best ones
    stack = [(0, place, prefix) for place, prefix in sorted(begin.items(), key=lambda x: x[1], reverse=True)]
    for _, place, prefix in stack:
        best[0, place] = prefix
    while stack:
        i, place, prefix = stack.pop()
        if best[i, place] != prefix:                    # a better prefix came meanwhile
            continue
        cost, audit = prefix
        if incumbent is not None and cost + least[i] > incumbent[0]:
            continue
        if i == n and place in ends:
            if place not in found or prefix < found[place]:
                found[place] = prefix
                if last:
                    incumbent = min(found.values())
                elif len(found) == len(PLACES):
                    incumbent = max(found.values())
        steps = [(cost + INSERT, audit + "I", i, _NEXT[place][0])]
        if i < n:
            steps += [(cost + c, audit + letter, i + 1, to) for c, letter, to in _branches(place, *rows[i])]
        steps.sort(reverse=True)                        # the cheapest, and of those the ASCII-least, is popped first
        for c, a, j, to in steps:
            if incumbent is not None and c + least[j] > incumbent[0]:
                continue
            known = best.get((j, to))
            if known is None or (c, a) < known:
                best[j, to] = (c, a)
                stack.append((j, to, (c, a)))
    if last:
        place = min(found, key=found.get)
        return {place: found[place]}
    return found


def apply_edits(audit: str, rows: Sequence[tuple[str, str]], place: int = START) -> tuple[list[str], int]:
    """The ``role:text`` lines that edits make of rows (role, text), and the place they lead to."""
    out, i = [], 0
    for letter in audit:
        to, role = _NEXT[place]
        if letter == "I":
            out.append(f"{role}:")
            place = to
            continue
        own, text = rows[i]
        i += 1
        if letter == "R":
            out.append(f"{role}:{text}")
            place = to
        elif letter == "K":
            out.append(f"{own}:{text}")
            place = AFTER_S if own[:1] == "s" else to
    return out, place


class Repair:
    """One conversation, fed row by row in order."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.before: str | None = None
        self.turns: list[int] = []                      # least, largest, distinct
        self.rows: list[tuple[str, str, int]] = []
        # for each place: the best prefix after the letters that all share, and the hash of its lines so far with whether it has any
        self.begin: dict[int, Prefix] = {START: (0, "")}
        self.shared: list[str] = []
        self.digests = {START: (hashlib.sha256(), False)}

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if len(self.rows) == self.block:
            self._advance(False)
        self.rows.append((role, text, fault))

    def _advance(self, last: bool) -> None:
        ways = search([(role[:1], fault) for role, _, fault in self.rows], self.begin, last)
        if AFTER_A in ways:
            # whatever follows s or nothing can follow a; all that a lacks is to keep an s, which it may delete instead
            for place, more in ((START, DELETE), (AFTER_S, 0)):
                if place in ways and ways[AFTER_A][0] + more < ways[place][0]:
                    del ways[place]
        pairs = [(role, text) for role, text, _ in self.rows]
        digests = {}
        for place, (_, audit) in ways.items():
            # the place this way began at is the one whose prefix its audit continues
            for source, (_, start) in self.begin.items():
                if audit.startswith(start) and apply_edits(audit[len(start):], pairs, source)[1] == place \
                        and sum(c != "I" for c in audit[len(start):]) == len(pairs):
                    lines, _ = apply_edits(audit[len(start):], pairs, source)
                    digest, some = self.digests[source]
                    digest = digest.copy()
                    for line in lines:
                        digest.update((f"\n{line}" if some else line).encode("utf-8", "surrogatepass"))
                        some = True
                    digests[place] = (digest, some)
        shared = os.path.commonprefix([audit for _, audit in ways.values()])
        self.shared.append(shared)
        self.begin = {place: (cost, audit[len(shared):]) for place, (cost, audit) in ways.items()}
        self.digests, self.rows = digests, []

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
        self._advance(True)
        (place, (cost, rest)), = self.begin.items()
        gaps = min(self.turns[1] - self.turns[0] + 1 - self.turns[2], 2**63 - 1) if self.turns else 0
        return gaps, *self.faults[1:], self.illegal, cost, "".join(self.shared) + rest, self.digests[place][0].hexdigest()


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``nth``, a row's number among its equals, and ``fault``, that of its first copy; later copies are duplicates or blank."""
    bare = F.regexp_replace("text", f"{_WHITE}+$", "")
    earlier = Window.partitionBy("conv_id", "role", F.sha2("text", 256), F.col("copies") > 0).orderBy(F.col("turn").asc_nulls_first())
    return (rows.withColumn("nth", F.row_number().over(earlier))
            .withColumn("fault", F.when(bare == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
                        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)))


def repair(rows: DataFrame, copies: Column | None = None, block: int = BLOCK) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text; ``copies``, by default 1, says how often each row occurs. Rows that occur
    0 times only name their conversation.
    """
    importable(rows.sparkSession)
    blank = F.lit(" ")
    source = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                         F.coalesce(F.col("text").cast("string"), blank).alias("text"), (F.lit(1) if copies is None else copies).alias("copies"))
    # one shuffle: the window's keys begin with the conversation, and so does the order within a task
    dealt = with_faults(source.repartition("conv_id")).sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "nth")
    kind = rows.schema["conv_id"].dataType
    longs = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, done = None, []
        own, conversation = None, None

        def batch() -> pa.RecordBatch:
            ids, results = [x for x, _ in done], list(zip(*[r for _, r in done], strict=True))
            arrays = [pa.array(ids, schema), *[pa.array(c, pa.int64()) for c in results[:6]], pa.array(results[6]), pa.array(results[7])]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                                                             "audit", "repaired_sha256"])

        for data in batches:
            schema = data.schema.field("conv_id").type
            for conv_id, turn, role, text, n, fault in zip(*[data.column(c).to_pylist() for c in
                                                             ("conv_id", "turn", "role", "text", "copies", "fault")], strict=True):
                if own is None or conv_id != conversation:
                    if own is not None:
                        done.append((conversation, own.result()))
                    own, conversation = Repair(block), conv_id
                for i in range(n):
                    own.add(turn, role, text, DUPLICATE if i and fault != BLANK else fault)
            if len(done) >= 1000:
                yield batch()
                done = []
        if own is not None:
            done.append((conversation, own.result()))
        if done:
            yield batch()

    return dealt.select("conv_id", "turn", "role", "text", "copies", "fault").mapInArrow(
        stream, f"conv_id {kind.simpleString()}, {longs}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn``, modulo 20: (conv_id, turn, role, text, copies)."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    kind = F.crc32(key.cast("binary")) % 20
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                       F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
