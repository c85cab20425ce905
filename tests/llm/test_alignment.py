"""Cross-tokenizer alignment against a token by token version, and on odd input."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsgrid.llm import alignment
from obsgrid.llm.catalog import QUERIES
from obsgrid.llm.common import table
from tests.conftest import SF001

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def letters():
    """Bytes of the letters of a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in shown:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


@functools.cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens_of(text):
    """(id, start, end) lists of both tokenizers, by the libraries."""
    a, b = libraries()
    if not text:
        return [], []
    table = letters()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    whole, out = (" " + text).encode(), []
    for ids, raw in ((a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(table[c] for c in a.id_to_token(i))),
                     (b.encode(text), piece)):
        at, own = 0, []
        for i in ids:
            own.append((i, at, at + len(raw(i))))
            at += len(raw(i))
        if b"".join(raw(i) for i in ids) != whole:
            return [], []
        out.append(own)
    return out


def brute(docs):
    per, holds = [], Counter()
    for doc, text in docs:
        a, b = tokens_of(text)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        before, groups = 0, []
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if before <= s and e <= cut) for side in (a, b)))
            before = cut
        links = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        holds.update(set(links))
        per.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    highest = {}
    for (x, _), n in holds.items():
        highest[x] = max(n, highest.get(x, 0))
    return sorted(((doc, n_a, n_b, n, len(links), sum(holds[p] == highest[p[0]] for p in links), sum(holds[p] for p in links),
                    hashlib.sha256(s.encode()).hexdigest() if n_a else "") for doc, n_a, n_b, n, links, s in per), key=repr)


def texts(rng):
    signs = ["ab", "the", " ", "  ", "\n", "é", "ß", "日本", "😀", "ı", "ﬁ", "\t", "'s", "12", "…", "٣", "ա", "\x85", "x", "tokenization", "<s>", "</s>",
             "<|endoftext|>", "　", "Ⅻ", "​"]
    out = [(i, "".join(rng.choice(signs) for _ in range(rng.choice([1, 3, 12, 40])))) for i in range(40)]
    out += [(100, None), (101, ""), (102, " "), (103, "▁"), (104, "a ▁ b"), (105, "<0x41>"), (106, "<|endoftext|>"), (107, "\x00"), (108, "é"),
            (None, "the the"), (7, out[7][1]), (7, out[7][1]), (7, "the other")]
    return out


@pytest.mark.parametrize("limit,chunk", [(1_500_000, 1 << 20), (0, 50)])
def test_against_tokens_one_by_one(spark, monkeypatch, limit, chunk):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    docs = texts(random.Random(limit))
    df = spark.createDataFrame(docs, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("row", "pairs", "n", "best", "times")])
    found = sorted((tuple(r) for r in alignment.align(df, A, B).collect()), key=repr)
    assert found == brute(docs)
    assert alignment.align(df.where("false"), A, B).collect() == []


def test_pointers_double_to_the_terminal():
    """Tokens that overlap in one long chain, each reaching over the next one's start, are one group found in few rounds."""
    n = 5000
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n - 1, 2), 2 * n)
    end_a, end_b = alignment.terminals(a, b)
    assert set(end_a) == set(end_b) == {len(b) - 1}
    at_a, at_b = alignment.linked(a, np.concatenate([[0], a[:-1]]), b)
    assert len(at_a) == len(a) + len(b) - 1


def test_rank_encoder_only_for_files_with_its_rules(tmp_path):
    own = alignment.ByteLevel(A)
    assert own.fast is not None
    rng = random.Random(2)
    pool = [chr(c) for c in [*range(0x528), *range(0x2010, 0x2028), *range(0x2030, 0x203B)]]
    for _ in range(300):
        t = "".join(rng.choice(pool if rng.random() < 0.5 else " \n's l12") for _ in range(50))
        assert own.ids(t) == own.library.encode(t, add_special_tokens=False).ids
    import json

    with open(A, encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = {"type": "Lowercase"}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    changed = alignment.ByteLevel(str(other))
    assert changed.fast is None and changed.ids(" The") == own.ids(" the")


def test_very_long_text_and_query(spark):
    long = "the tokenization of 日本 " * 20_000
    row = alignment.align(spark.createDataFrame([(1, long)], "doc_id long, text string"), A, B).first()
    assert row.n_a > 80_000 and row.n_links == row.n_a + row.n_b - row.n_groups
    docs = [tuple(r) for r in table(spark, SF001, "documents").select("doc_id", "text").collect() if len(r.text or "") < 3000][:60]
    small = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in alignment.align(small, A, B).collect()), key=repr) == brute(docs)
    rows = QUERIES["op12_tokenizer_alignment"](spark, SF001).collect()
    assert len(rows) == table(spark, SF001, "documents").count()
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in rows)
