"""The pipeline's stages against brute force, on odd input, and the entry point's guard."""

import inspect
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from obsgrid.llm import langid, quality
from obsgrid.llm.catalog import ORACLES, QUERIES
from obsgrid.llm.common import fold, table, written
from tests.conftest import SF001, SF01
from tests.llm.test_search_operators import plain_components, plain_lines, plain_simhash

pytest.importorskip("public_tokenizers")


def test_stages_by_brute_force(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}

    kept = written(P.keep_languages(spark, docs, SF001), "t")
    assert kept.columns == columns
    model = langid.learn(docs.where(fold(F.col("doc_id"), 4) != 2))
    found = {r.doc_id: r.p for r in docs.select("doc_id", langid.predict(spark, model, F.col("text")).alias("p")).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in found.items() if p.lang_pred != "und" and p.score >= 0.05}

    good = written(P.keep_quality(spark, kept, SF001), "t")
    scorer = quality.fit(kept, table(spark, SF001, "labels").where(fold(F.col("doc_id"), 5) != 0))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in kept.collect() if scorer.score(quality.features(r.text)) >= 0.3}
    labels = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    clean = [i for i, q in labels.items() if q == 1 and i in before]
    assert sum(i in {r.doc_id for r in good.collect()} for i in clean) >= 0.97 * len(clean)

    lines = written(P.drop_repeated_lines(spark, good, SF001), "t")
    assert lines.columns == columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted((d, t) for d, t, _, _ in plain_lines(rows, 2, 50))
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    unique = written(P.drop_near_duplicates(spark, lines, SF001), "t")
    assert unique.columns == columns
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    roots = plain_components([i for i, _ in rows], [plain_simhash(t) for _, t in rows], 2)
    assert {r.doc_id for r in unique.collect()} == set(roots)

    packed = P.pack_sequences(spark, unique, SF001).collect()
    assert {r.doc_id for r in packed} == set(roots)
    assert P.run(spark, SF001).count() == len(packed)


def test_stages_on_odd_input(spark):
    rows = [(1, None, None, "s", 0), (2, "", "en", None, 0), (3, "word " * 50000, "en", "s", 1), (4, "the cat sat", "en", "s", 1),
            (4, "the cat sat", "en", "s", 1), (None, "the cat sat on", "en", "s", 1), (5, "12 !!", "de", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", *[F.lit(1).alias(c) for c in ("score", "fp", "line", "h", "task", "found", "length")])
    for frame in (docs, docs.limit(0)):
        now = frame
        for name, stage in P.STAGES:
            out = written(stage(spark, now, SF001), "odd")
            assert name == "packing" or out.columns == docs.columns
            now = out
        assert (now.count() > 0) == (frame is docs)


def test_queries_equal_their_sql(spark):
    from oracle_check import compare

    res = compare(spark, SF01, sorted(ORACLES))
    assert len(res) == len(ORACLES) and not {k: v for k, v in res.items() if not v["ok"]}


def test_names_and_native_operators():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 11))
    from obsgrid.llm import exact_dedup, license_scan, line_dedup

    for module in (exact_dedup, license_scan, line_dedup):
        source = inspect.getsource(module)
        assert not any(word in source for word in ("pandas", "pyarrow", "udf(", ".rdd", "mapIn", "localCheckpoint"))


def test_entry_point_without_the_subpackage():
    """With the subpackage and the pipeline out of reach the entry point still lists all other queries."""
    code = textwrap.dedent("""
        import sys

        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name.startswith("obsgrid.llm") or name == "corpus_pipeline":
                    raise ModuleNotFoundError(name)

        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert len(e.queries()) > 30 and not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
    """)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
