"""Dedup, scan, packing and search operators against brute force, and on odd input."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from obsgrid.llm import exact_dedup, license_scan, line_dedup, packing, simhash, topk
from obsgrid.llm.catalog import QUERIES
from obsgrid.llm.common import table
from obsgrid.llm.components import components
from tests.conftest import SF01

P = pytest.importorskip("public_tokenizers")
WORDS = P.path("word_bpe_49k.json")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, n, signs):
    out = list(text)
    for _ in range(n):
        at = rng.randint(0, len(out))
        if rng.random() < 0.34 or at == len(out):
            out.insert(at, rng.choice(signs))
        elif rng.random() < 0.5:
            out[at] = rng.choice(signs)
        else:
            del out[at]
    return "".join(out)


def clashing(df):
    """Extra columns named like results and helpers."""
    return df.select("*", *[F.lit(7).alias(c) for c in ("key", "fp", "line", "h", "d", "norm", "piece", "rank", "words", "task")])


# -- exact dedup --------------------------------------------------------------
@pytest.mark.parametrize("key_bits,capacity", [(64, 4096), (64, 3), (6, 2), (1, 1)])
def test_exact_dedup(spark, key_bits, capacity):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a b", "a  b", "a\tb", " a b", "é", None, ""]) if i % 2 else f"t{i % 90}") for i in range(200)]
    rows += [(3, rows[3][1]), (None, "only null id"), (None, "t0")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    expected = []
    for i, t in norm:
        own = [j for j, u in norm if u == t]
        keep = min((j for j in own if j is not None), default=None)
        expected.append((i, keep, len(own), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.duplicates(docs, key_bits=key_bits, capacity=capacity).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_exact_dedup_directory(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    buckets = exact_dedup.directory(keys, capacity=8).collect()
    assert sum(b["keys"] for b in buckets) == 500 and max(b["keys"] for b in buckets) <= 8
    assert len({b["depth"] for b in buckets}) > 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.duplicates(empty).count() == 0


def test_exact_dedup_goes_by_its_directory(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 150}") for i in range(300)], "doc_id long, text string")
    expected = sorted(tuple(r) for r in exact_dedup.duplicates(docs, capacity=8).collect())
    assert {r[2] for r in expected} == {2} and sum(r[3] for r in expected) == 150
    entries = docs.select("doc_id", exact_dedup._key(exact_dedup.normalised(docs["text"]), 64).alias("key"))
    buckets, index = exact_dedup.build_index(entries, capacity=8)
    # a bucket has one owner, and each key is within the bucket that it's filed under
    files = index.withColumn("file", F.input_file_name()).groupBy("depth", "prefix").agg(F.count_distinct("file").alias("owners"), F.count("*").alias("keys"))
    assert files.count() > 10 and files.where("owners > 1 OR keys > 8").isEmpty()
    assert index.where("shiftright(key, 64 - depth) <> prefix").isEmpty()
    whole = exact_dedup.directory

    def damaged(*args, **kwargs):
        found = whole(*args, **kwargs)
        first = found.orderBy("depth", "prefix").first()
        return found.where((F.col("depth") != first["depth"]) | (F.col("prefix") != first["prefix"]))

    monkeypatch.setattr(exact_dedup, "directory", damaged)
    with pytest.raises(Exception, match="leads to no bucket"):
        exact_dedup.duplicates(docs, capacity=8).collect()


def test_exact_dedup_very_long_texts(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(2, long), (1, long.replace(" ", " \t")), (3, long + "x")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicates(docs).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True)}


def test_exact_dedup_keeps_rows(spark):
    docs = spark.createDataFrame([(2, "x  y"), (1, "x y"), (3, "z"), (1, "x y")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.deduplicated(docs).collect()) == [1, 1, 3]


# -- simhash ------------------------------------------------------------------
def plain_simhash(text):
    words = [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints, distance):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            root[max(find(a), find(b))] = min(find(a), find(b))
    lowest = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            r = find(i)
            lowest[r] = min(lowest.get(r, ids[i]), ids[i])
    return [lowest.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("parts,block", [(4, 4096), (4, 3), (2, 5), (8, 2)])
def test_simhash_links(spark, parts, block):
    rng = random.Random(parts + block)
    prints = [0, (1 << 64) - 1]
    while len(prints) < 220:
        base = rng.choice(prints) if rng.random() < 0.6 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 4)):
            base ^= 1 << rng.randrange(64)
        prints.append(base)
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)
    found = {r.node: r.root for r in components(simhash.links(frame, 2, parts, block)).collect()}
    expected = plain_components(list(range(len(prints))), prints, 2)
    groups = {}
    for i, p in enumerate(signed):
        groups.setdefault(found.get(p, p), set()).add(i)
    wanted = {}
    for i, c in enumerate(expected):
        wanted.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_simhash_documents(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice(["sea", "LAND", "sky", "Éa", "of", "the"]) + str(rng.randint(0, 30)) for _ in range(200))
            for _ in range(6)]
    rows = [(100 - i, changed(rng, rng.choice(base), rng.choice([0, 0, 1, 2]), "xyz ")) for i in range(60)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (204, "ONE"), (None, "one"), (None, "else where now")]
    rows += [(205, "long text " * 30000)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")), "component_id").collect()), key=str)
    prints = [plain_simhash(t) for _, t in rows]
    roots = plain_components([i for i, _ in rows], prints, 2)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, roots)), key=str)
    kept = simhash.unique_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (i for (i, _), c in zip(rows, roots) if c is None or i == c), key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 299), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(60))
    assert found[300] == found[299] == 299
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- license scan -------------------------------------------------------------
def test_license_scan(spark):
    long_text = license_scan.TEMPLATES["GPL-3.0"][1]
    cut = " ".join(long_text.split()[:38])
    rows = [(1, "x y\nReleased under the MIT license!\nz"), (2, "released under mit license"), (3, None), (4, ""), (5, "a b c"),
            (6, "intro words here " + long_text + " and more"), (7, cut), (8, " ".join(long_text.split()[:25])),
            (9, "w " * 40000 + "Licensed under the Apache License, Version 2.0 " + "v " * 40000), (1, "licensed under cc by nc 4.0")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.license, r.template) for r in license_scan.scan(docs).collect()}
    assert got == {(1, "MIT", 0), (6, "GPL-3.0", 1), (7, "GPL-3.0", 1), (9, "Apache-2.0", 0), (1, "CC-BY-NC-4.0", 0)}
    assert license_scan.scan(docs.limit(0)).count() == 0
    assert license_scan.scan(docs, templates={}).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(docs, templates={"x": ["too short"]})
    places = license_scan.scan(docs).where("doc_id = 9").first()
    assert (places.first_word, places.last_word) == (40000, 40007)


def test_license_retrieval_of_single_shingles(spark):
    rng = random.Random(2)
    rows = [(i, " ".join([str(rng.random()) for _ in range(6)] + ["released under the mit license"] + [str(rng.random()) for _ in range(6)]))
            for i in range(400)]
    assert license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).count() == 400


def test_license_scan_short_templates(spark):
    rows = [(1, "x\nAll rights reserved.\ny"), (2, "ALL Rights, reserved"), (3, "all rights are reserved"), (4, "overall rights reserved"),
            (5, "some rights reserved here all rights"), (6, "all rights"), (7, None), (8, "Released under the MIT License. All rights reserved.")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    templates = {**license_scan.NOTICES, "MIT": license_scan.TEMPLATES["MIT"], "four": ["Some rights reserved here"]}
    got = {(r.doc_id, r.license, r.matched, r.of, r.first_word, r.last_word) for r in license_scan.scan(docs, templates).collect()}
    assert got == {(1, "All-rights-reserved", 1, 1, 1, 3), (2, "All-rights-reserved", 1, 1, 0, 2), (5, "four", 1, 1, 0, 3),
                   (8, "MIT", 1, 1, 0, 4), (8, "All-rights-reserved", 1, 1, 5, 7)}


def test_license_scan_planted_lines(spark):
    """Every line of the tables that is a notice gives a row, and no other document has one."""
    planted = {"All rights reserved.": "All-rights-reserved", "Released under the MIT License.": "MIT",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    docs = table(spark, SF01, "documents")
    wanted = {(r.doc_id, planted[x.strip()]) for r in docs.collect() for x in (r.text or "").split("\n") if x.strip() in planted}
    got = [QUERIES[q](spark, SF01).collect() for q in ("op5_license_scan", "op5_short_notices")]
    assert {x for _, x in wanted} == set(planted.values())
    assert {(r.doc_id, r.license) for rows in got for r in rows} == wanted


BSD_PREAMBLE = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                "following conditions are met: ")
BSD_SECOND = ("2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
              "disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission. ")
DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'


def test_license_scan_equals_its_sql_on_neighbours(spark, workdir):
    import duckdb

    from obsgrid.llm.catalog import ORACLES

    gpl = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
           "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
    texts = {1: (gpl.format("", ";", "2"), {"GPL-2.0"}), 2: (gpl.format("", ",", "3"), {"GPL-3.0"}),
             3: (gpl.format("Lesser ", ",", "3"), {"LGPL-3.0"}), 4: (gpl.format("Affero ", ",", "3"), {"AGPL-3.0"}),
             5: (BSD_PREAMBLE + BSD_SECOND + DISCLAIMER, {"BSD", "BSD-2-Clause"}),
             6: (BSD_PREAMBLE + BSD_SECOND + BSD_THIRD + DISCLAIMER, {"BSD", "BSD-3-Clause"}),
             7: (BSD_PREAMBLE, {"BSD"}), 8: ("(c) me. All rights reserved. All rights reserved", {"All-rights-reserved"}),
             9: ("all rights", set()), 10: (None, set()), 11: ("Released under the MIT License", {"MIT"}), 12: ("", set())}
    path = f"{workdir}/documents.parquet"
    spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string").coalesce(1).write.parquet(path)
    found = QUERIES["op5_license_scan"](spark, workdir)
    got = sorted(tuple(r) for r in found.collect())
    for i, (_, wanted) in texts.items():
        assert {r[1] for r in got if r[0] == i} == wanted, i
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert got == sorted(con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in found.columns)} FROM ({ORACLES['op5_license_scan']})").fetchall())


def test_license_scan_tells_neighbours_apart(spark):
    header = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as "
              "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
    line = "This work is licensed under the GNU {} Public License, version {}."
    families = {"General": {"2": "GPL-2.0", "3": "GPL-3.0"}, "Lesser General": {"2.1": "LGPL-2.1", "3": "LGPL-3.0"},
                "Library General": {"2": "LGPL-2.0"}, "Affero General": {"3": "AGPL-3.0"}}
    cases = [(text.format(family, version), name) for family, own in families.items() for version, name in own.items()
             for text in (header, line) if (text, name) != (line, "AGPL-3.0")]
    cases += [("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               f"http://www.apache.org/licenses/LICENSE-{v}", n) for v, n in (("2.0", "Apache-2.0"), ("1.1", None))]
    cases += [(header.format("General", "3").replace("of the License", "of this License"), "GPL-3.0")]
    docs = spark.createDataFrame([(i, "some words " + t + " and more") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()}
    assert got == {(i, n) for i, (_, n) in enumerate(cases) if n}


# -- packing ------------------------------------------------------------------
def naive_rooms(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [i for i, r in enumerate(rooms) if r >= length]
            at = min(fit, key=lambda i: rooms[i]) if fit else len(rooms)
            if not fit:
                rooms.append(capacity)
            rooms[at] -= length
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([1, 2, 5, 16, 31, 64])
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}
        fill, ranks = {}, {}
        for length, rank, n, first, offset in packing.plan(counts, capacity):
            for k in range(n):
                assert ranks.setdefault(length, 0) == rank + k and fill.get(first + k, 0) == offset
                ranks[length] += 1
                fill[first + k] = offset + length
        assert ranks == counts
        assert sorted(capacity - f for f in fill.values()) == naive_rooms(counts, capacity)


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    own, rng = packing.WordIds(WORDS), random.Random(6)
    signs = list("abzİÅKÅHªµŁʰ̱AZ019 '.,!?<|>\n\t\r\x0b\x0c\x1c\x1f\x85  　éßΣσςıñ中한ﬁ½😀") + ["'s", "'re", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 24)))
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_word_ids_of_a_file_with_other_rules(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as f:
        rules = json.load(f)
    rules["normalizer"] = None
    other = tmp_path / "other.json"
    other.write_text(json.dumps(rules), encoding="utf-8")
    own, whole = packing.WordIds(str(other)), Tokenizer.from_file(str(other))
    for text in ("The SEA", "a  b\n", "", "x <|endoftext|> Y"):
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    rows = [(i, "sea land sky " * (i % 13)) for i in range(60)] + [(60, None), (61, ""), (61, ""), (None, "x"), (62, "word " * 700)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    got = packing.pack(docs, WORDS, capacity=64).collect()
    expected = []
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            expected.append((i, k, at, len(ids[at:at + 64]), zlib.crc32(np.array(ids[at:at + 64], dtype="<u4").tobytes())))
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(expected, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    counts = {}
    for e in expected:
        counts[e[3]] = counts.get(e[3], 0) + 1
    assert len(by) == len(naive_rooms(counts, 64))
    assert packing.pack(docs.limit(0), WORDS).count() == 0


# -- line dedup ---------------------------------------------------------------
def plain_lines(rows, tau, least):
    where = {}
    for d, t in rows:
        for i, raw in enumerate(t.split("\n") if t is not None else ()):
            line = raw.strip(" \t\r")
            if line:
                at = ((1 << 63) - 1 if d is None else d, i)
                where[line] = min(where.get(line, at), at)
    near = {s: [] for s in where}
    for a, b in itertools.combinations([s for s in where if len(s) >= least], 2):
        if abs(len(a) - len(b)) <= tau and edits(a, b) <= tau:
            near[a].append(b)
            near[b].append(a)
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        keep, gone, links, at = [], 0, 0, (1 << 63) - 1 if d is None else d
        for i, raw in enumerate(t.split("\n")):
            line = raw.strip(" \t\r")
            if line:
                links += len(near[line])
            if line and (where[line] < (at, i) or any(where[x] < where[line] for x in near[line])):
                gone += 1
            else:
                keep.append(raw)
        out.append((d, "\n".join(keep), gone, links))
    return sorted(out, key=str)


@pytest.mark.parametrize("tau,least", [(1, 10), (2, 30)])
def test_line_dedup(spark, tau, least):
    rng = random.Random(tau)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.choice([5, 12, 30, 31, 32]))) for _ in range(30)]
    rows = [(d, "\n".join(rng.choice(["", " "]) + changed(rng, rng.choice(base), rng.choice([0, 0, 0, 1, 2, 3]), "abcdeé")
                          for _ in range(rng.randint(0, 7)))) for d in range(90)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (7, rows[7][1]), (None, base[20] + "\n" + base[21]), (503, "z" * 30000)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = line_dedup.dedup_lines(docs, tau, least)
    assert got.columns == docs.columns + ["dropped_lines", "line_links"]
    assert sorted(((r.doc_id, r.text, len(r.dropped_lines), r.line_links) for r in got.collect()), key=str) == plain_lines(rows, tau, least)


def test_edit_automaton(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(400):
        signs = rng.choice(["ab", "abcdefé😀"])
        a = "".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 3, 16, 17, 33, 60])))
        pairs.append((a, changed(rng, a, rng.randint(0, 4), signs)))
    got = {(r.a, r.b): r.distance for r in line_dedup.verified(spark.createDataFrame(pairs, "a string, b string"), "a", "b", 2).collect()}
    assert got == {(a, b): n for a, b in pairs if (n := edits(a, b)) <= 2}


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- top k --------------------------------------------------------------------
def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(30)] + [(400, [0.0] * 6), (401, [0.0] * 6)]
    odd = [(500, None), (600, [1.0, None] + [0.0] * 4), (700, [float("nan")] * 6), (800, [float("inf")] + [0.0] * 5),
           (900, [1.0, 2.0]), (901, [2.0, 1.0]), (902, []), (1000, []), (None, [1.0] * 6)]
    vectors = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    ints = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v in rows + odd[4:8]}
    expected = []
    for q in ints:
        if q % 100 == 0:
            scored = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:10])]
    for block, chunk in ((32768, 512), (64, 2)):
        got = topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), block_rows=block, chunk_queries=chunk)
        assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("rows,fails", [
    ([(0, [70000.0, 0.0]), (1, [70000.0, 1.0]), (2, [-70000.0, 2.0])], False),
    ([(0, [30000.0] * 4096), (1, [-30000.0] * 4096), (2, [29999.0] * 4096)], False),
    ([(0, [65000.0] * 4096), (1, [1.0] * 4096), (2, [65000.0] * 4096)], True),
    ([(0, [1e6] * 3), (1, [-1e14, 1e14, 5e6]), (2, [-8e14, 1.0, -8e14]), (100, [0.0, 0.0, 1e15])], False),
    ([(0, [1e6] * 3), (1, [1e300, 0.0, 0.0])], True)])
def test_top_k_of_large_components(spark, rows, fails):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 100 = 0")
    if fails:
        with pytest.raises(Exception, match="beyond a long"):
            topk.top_k(vectors, asked, k=2).collect()
        return
    exact = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    expected = []
    for q in exact:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(exact[q], exact[c])), c) for c in exact if c != q)[:2]
            expected += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    if any(abs(s) >= 1 << 63 for *_, s in expected):
        expected = None
    if expected is None:
        with pytest.raises(Exception, match="beyond a long"):
            topk.top_k(vectors, asked, k=2).collect()
    else:
        assert sorted(tuple(r) for r in topk.top_k(vectors, asked, k=2).collect()) == sorted(expected)
