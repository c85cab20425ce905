"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Two monoids are reduced by halving. A text's value is the list of its pattern
matches: halves are split recursively, then joined by splitting a window
around the cut anew; the window grows to the right until one of its matches
ends where a match of the right half does, from where on both must agree, as
the pattern never looks back. A match's value is its list of token ids: halves
are encoded recursively, then joined by encoding a window of tokens around the
cut anew; the window grows on either side until the token pair at its edge is
stable, that is, encodes to itself. A sequence all of whose neighbours are
stable is the encoding of its bytes, so no token outside can change.

Decoding concatenates the tokens' bytes up the same kind of tree.

Matches come back often, so a worker remembers the ids of a bounded number of
them. No shuffle is needed.

Defined results: NULL and empty texts give no ids and the digests of nothing.
Rows pass one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

LEAF_BYTES = 4
LEAF_CHARS = 1 << 15
#: characters a match may look beyond its own end
LOOK_AHEAD = 3
#: matches that a worker remembers before it starts anew, some 200 bytes each, and windows
REMEMBERED = 1_000_000
WINDOWS = 200_000
#: windows up to this many bytes come back often
SHORT = 12

_state: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines: base64 of a token, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Known(dict):
    """Ids of matches, worked out when first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, match: str) -> bytes:
        ids = self.codec.encode_bytes(match.encode("utf-8", "surrogatepass"))
        raw = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= 64:
            self[match] = raw
        return raw


class Codec:
    """Encoder and decoder for one table of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_bytes: int = LEAF_BYTES, leaf_chars: int = LEAF_CHARS):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.decimal = [str(rank) for rank in range(len(self.token))]
        self.leaf_bytes, self.leaf_chars = leaf_bytes, leaf_chars
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.known = _Known(self)

    # -- ids of one match ---------------------------------------------------
    def merge(self, raw: bytes) -> tuple[int, ...]:
        """The plain rule: merge the neighbours of lowest rank, leftmost first, until none has a rank."""
        if len(raw) > SHORT:
            return self._merge_short(raw) if len(raw) <= 64 else self._merge_long(raw)
        found = self.windows.get(raw)
        if found is None:
            if len(self.windows) > WINDOWS:
                self.windows.clear()
            found = self.windows[raw] = self._merge_short(raw)
        return found

    def _merge_short(self, raw: bytes) -> tuple[int, ...]:
        get = self.ranks.get
        parts = [raw[i:i + 1] for i in range(len(raw))]
        none = len(self.ranks)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = min(scores)
            if best == none:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, raw: bytes) -> tuple[int, ...]:
        """The same rule with a heap, for long windows."""
        get, n = self.ranks.get, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not alive[i] or mid >= n or end[mid] != stop or not alive[mid]:
                continue
            alive[mid], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := get(raw[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        return tuple([self.ranks[raw[i:end[i]]] for i in range(n) if alive[i]])

    def stable(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens encode to themselves."""
        return self.merge(self.token[a] + self.token[b]) == (a, b)

    def join_ids(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        i, j, token = 1, 1, self.token
        while True:
            if i == j == 1:
                window = self.merge(token[left[-1]] + token[right[0]])
            else:
                window = self.merge(b"".join([token[t] for t in left[-i:] + right[:j]]))
            calm_left = i == len(left) or window[0] == left[-i] or self.stable(left[-i - 1], window[0])
            calm_right = j == len(right) or window[-1] == right[j - 1] or self.stable(window[-1], right[j])
            if calm_left and calm_right:
                return left[:len(left) - i] + window + right[j:]
            if not calm_left:
                i = min(len(left), 2 * i)
            if not calm_right:
                j = min(len(right), 2 * j)

    def encode_bytes(self, raw: bytes) -> tuple[int, ...]:
        """Ids of one match."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        if len(raw) <= self.leaf_bytes:
            return self.merge(raw)
        mid = len(raw) // 2
        return self.join_ids(self.encode_bytes(raw[:mid]), self.encode_bytes(raw[mid:]))

    # -- matches of a text --------------------------------------------------
    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        tail, held = [], 0
        while left and held < LOOK_AHEAD:       # matches that what follows may change
            tail.append(left.pop())
            held += len(tail[-1])
        head, j = "".join(reversed(tail)), 1
        while True:
            j = min(j, len(right))
            window = head + "".join(right[:j])
            found = self.find(window)
            starts, at = {}, len(head)
            for k in range(j + 1):
                starts[at] = k
                at += len(right[k]) if k < j else 0
            at, last = 0, len(window) if j == len(right) else len(window) - LOOK_AHEAD
            for n, match in enumerate(found):
                at += len(match)
                if at > last:
                    break
                if at in starts and at > len(head):
                    return left + found[:n + 1] + right[starts[at]:]
            if j == len(right):
                return left + found
            j *= 2

    def matches(self, text: str) -> list[str]:
        """The pattern's matches in a text; together they are the text."""
        if len(text) <= self.leaf_chars:
            return self.find(text)
        mid = len(text) // 2
        return self.join_matches(self.matches(text[:mid]), self.matches(text[mid:]))

    # -- whole texts --------------------------------------------------------
    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.matches(text)))

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of a list of ids."""
        if len(ids) <= self.leaf_chars:
            return b"".join(map(self.token.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def codec(path: str, pattern: str) -> Codec:
    """The worker's own codec for a file of ranks."""
    key = path, pattern
    if key not in _state:
        _state[key] = Codec(read_ranks(path), pattern)
    return _state[key]


def encode(spark: SparkSession, path: str, pattern: str, text: Column) -> Column:
    """A column of id lists."""
    importable(spark)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        own = codec(path, pattern)
        return pd.Series([np.frombuffer(own.encode(t or ""), dtype="<u4").astype(np.int32) for t in texts])

    return ids(text)


def decode(spark: SparkSession, path: str, pattern: str, ids: Column) -> Column:
    """A column of bytes from id lists; a NULL list gives NULL."""
    importable(spark)

    @F.pandas_udf("binary")
    def raw(lists: pd.Series) -> pd.Series:
        own = codec(path, pattern)
        return pd.Series([None if x is None else own.decode(x.tolist()) for x in lists], dtype=object)

    return raw(ids)


def digests(spark: SparkSession, path: str, pattern: str, text: Column) -> Column:
    """A struct column (n_tokens, ids_sha256, decoded_sha256): encodes each text, then decodes its ids."""
    importable(spark)

    def row(own: Codec, text: str) -> tuple[int, str, str]:
        ids = np.frombuffer(own.encode(text), dtype="<u4").tolist()
        decimal = " ".join(map(own.decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.DataFrame([row(own, t or "") for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return made(text)
