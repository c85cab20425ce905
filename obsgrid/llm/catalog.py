"""Registered queries of the corpus operators, and their SQL where SQL can say the same.

Every query reads its whole table; the parameters here are the production
parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm import alignment, bpe, conversations, decontaminate, exact_dedup, html_extract, langid, license_scan, line_dedup, packing, quality, simhash, topk
from obsgrid.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query
    return add


def _one_byte(line: str) -> str:
    """SQL for a line with one byte for each accented letter of the tables, as the SQL distance counts bytes."""
    letters = "éèêçñóíäöüßÉÈÊÇÑÓÍÄÖÜ"
    codes = [c for c in range(1, 32) if c not in (9, 10, 13)][:len(letters)]
    return f"translate({line}, '{letters}', {' || '.join(f'chr({c})' for c in codes)})"


def _vocabulary(name: str) -> tuple[str, str]:
    """Path of a public tokenizer's file, and the pattern of the rank files."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@register("op1_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = _vocabulary("byte_bpe_50k.tiktoken")
    return (table(spark, sf_dir, "documents")
            .select("doc_id", bpe.digests(spark, path, pattern, F.col("text")).alias("made"))
            .select("doc_id", "made.n_tokens", "made.ids_sha256", "made.decoded_sha256"))


@register("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = langid.learn(docs.where(~F.col("held_out")))
    return (docs.select("doc_id", "held_out", langid.predict(spark, model, F.col("text")).alias("found"))
            .select("doc_id", "held_out", "found.lang_pred", "found.score"))


@register("op3_exact_dedup", r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
""")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


@register("op4_simhash")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def _license_sql() -> str:
    """Exact containment of every template in every document, with a shingle for each deciding phrase."""
    known = license_scan.TEMPLATES | license_scan.NOTICES
    rows = ", ".join("('{}', {}, '{}')".format(name, i, text.replace("'", "''"))
                     for name, texts in known.items() for i, text in enumerate(texts))
    phrases = ", ".join(f"('{name}', '{phrase}')" for name, listed in license_scan.DECIDING.items() for phrase in listed)

    def words(source: str) -> str:
        return f"SELECT *, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {source}"

    return f"""
WITH notices(license, template, text) AS (VALUES {rows}), phrases(license, phrase) AS (VALUES {phrases}),
t AS (SELECT *, least(len(w), 5) AS size FROM ({words("notices")})),
s AS (SELECT license, template, size, list_distinct([array_to_string(w[i + 1:i + size], ' ') FOR i IN range(len(w) - size + 1)]) AS s FROM t),
x AS (SELECT license, template, size, CAST(len(s) AS INTEGER) AS "of", unnest(s) AS one FROM s),
d AS (
    SELECT doc_id, size, i, array_to_string(w[i + 1:i + size], ' ') AS one
    FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS i FROM ({words("documents")}), (SELECT DISTINCT size FROM t) WHERE len(w) >= size)
), f AS (
    SELECT doc_id, size, i, license, template, "of", one FROM d JOIN x USING (size, one)
), m AS (
    SELECT doc_id, license, template, CAST(count(DISTINCT one) AS INTEGER) AS matched, "of",
           CAST(min(i) AS INTEGER) AS first_word, CAST(max(i) + size - 1 AS INTEGER) AS last_word
    FROM f GROUP BY doc_id, license, template, "of", size
), p AS (
    SELECT license, template, one, phrase FROM x JOIN phrases USING (license) WHERE contains(' ' || one || ' ', ' ' || phrase || ' ')
), need AS (
    SELECT license, template, count(DISTINCT phrase) AS n FROM p GROUP BY license, template
), got AS (
    SELECT doc_id, license, template, count(DISTINCT phrase) AS n FROM f JOIN p USING (license, template, one) GROUP BY doc_id, license, template
)
SELECT m.* FROM m LEFT JOIN need USING (license, template) LEFT JOIN got USING (doc_id, license, template)
WHERE matched >= 0.8 * "of" AND coalesce(got.n, 0) = coalesce(need.n, 0)
"""


@register("op5_license_scan", _license_sql())
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register("op5_short_notices", r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), p AS (
    SELECT doc_id, [i FOR i IN range(len(w) - 2) IF w[i + 1] = 'all' AND w[i + 2] = 'rights' AND w[i + 3] = 'reserved'] AS places FROM d
)
SELECT doc_id, 'All-rights-reserved' AS license, 0 AS template, 1 AS matched, 1 AS "of",
       CAST(list_min(places) AS INTEGER) AS first_word, CAST(list_max(places) + 2 AS INTEGER) AS last_word
FROM p WHERE len(places) > 0
""")
def short_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices shorter than a shingle alone; ``op5_license_scan`` has them among its rows."""
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.NOTICES)


@register("op6_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract(spark, F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@register("op7_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return (docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
                        quality.score(spark, model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


@register("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json")[0])


@register("op9_line_dedup", """
WITH a AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), l AS (
    SELECT doc_id, CAST(i AS INTEGER) AS line_no, doc_id * 2147483648 + i AS place,
           trim(parts[i + 1], ' ' || chr(9) || chr(13)) AS line
    FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM a)
), d AS (
    SELECT line, min(place) AS first, length(line) AS n
    FROM (SELECT line, place FROM l WHERE line <> '') GROUP BY line
), p AS (
    SELECT x.line AS one, y.line AS other, x.first AS one_first, y.first AS other_first
    FROM d x JOIN (SELECT *, unnest([n, n + 1, n + 2]) AS m FROM d WHERE n >= 50) y ON x.n = y.m
    WHERE x.n >= 50 AND x.line <> y.line AND (x.n > y.n OR x.first < y.first)
      AND levenshtein(PLAIN_X, PLAIN_Y) <= 2
), k AS (
    SELECT line, max(earlier) AS earlier, count(*) AS links FROM (
        SELECT one AS line, CAST(other_first < one_first AS INTEGER) AS earlier FROM p
        UNION ALL SELECT other, CAST(one_first < other_first AS INTEGER) FROM p) GROUP BY line
), v AS (
    SELECT l.doc_id, l.line_no, l.line <> '' AND (l.place > d.first OR coalesce(k.earlier, 0) = 1) AS gone, coalesce(k.links, 0) AS links
    FROM l LEFT JOIN d USING (line) LEFT JOIN k USING (line)
), g AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, CAST(sum(links) AS BIGINT) AS n_links,
           coalesce(list(line_no ORDER BY line_no) FILTER (WHERE NOT coalesce(gone, false)), []) AS stay
    FROM v GROUP BY doc_id
)
SELECT doc_id, n_lines, n_dropped, n_links,
       sha256(coalesce(array_to_string(list_transform(stay, lambda i: parts[i + 1]), chr(10)), '')) AS text_sha256
FROM g JOIN a USING (doc_id)
""".replace("PLAIN_X", _one_byte("x.line")).replace("PLAIN_Y", _one_byte("y.line")))
def line_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").withColumn("whole", F.col("text")))
    return found.select("doc_id", F.size(F.split("whole", "\n", -1)).cast("long").alias("n_lines"),
                        F.size("dropped_lines").cast("long").alias("n_dropped"), F.col("line_links").alias("n_links"),
                        F.sha2("text", 256).alias("text_sha256"))


@register("op10_exact_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
    WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@register("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json")[0], _vocabulary("piece_bpe_32k.model")[0])


@register("op13_decontamination", r"""
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), x AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS one
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), p AS (
    SELECT row_no, i, n, array_to_string(w[i:i + n - 1], ' ') AS one
    FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM x) WHERE len(w) >= n)
), m AS (
    SELECT row_no, i, n, item FROM p JOIN x USING (n, one)
), h AS (
    SELECT row_no, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT row_no, unnest(range(i, i + n)) AS k FROM m) GROUP BY row_no
), s AS (
    SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_no, item FROM m) GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row_no) LEFT JOIN s USING (row_no)
""")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@register("op11_conversation_repair", r"""
WITH RECURSIVE t AS (
    SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                          lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
    FROM conversations
), z AS (
    SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM k, t
), g AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM z
), n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
    FROM g
), r AS (
    SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
           CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'c' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM n
), s AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
           count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM r GROUP BY conv_id
), pre(place, into_, cost, letters, made) AS (
    VALUES ('-', '-', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
           ('-', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('u', 'a', 5, 'I', ['assistant:']), ('a', 'u', 5, 'I', ['user:']),
           ('-', 'a', 10, 'II', ['user:', 'assistant:']), ('s', 'a', 10, 'II', ['user:', 'assistant:'])
), w AS (
    SELECT conv_id, 0 AS i, '-' AS place, {'cost': 0, 'audit': '', 'made': []::VARCHAR[]} AS best FROM s
    UNION ALL
    SELECT conv_id, any_value(i), place, min(best) FROM (
        SELECT w.conv_id, CAST(r.i AS INTEGER) AS i, e.place,
               {'cost': w.best.cost + pre.cost + e.cost, 'audit': w.best.audit || pre.letters || e.letter,
                'made': w.best.made || pre.made || e.made} AS best
        FROM w JOIN pre USING (place) JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1,
             LATERAL (SELECT unnest([
                 {'place': pre.into_, 'cost': 2, 'letter': 'D', 'made': []::VARCHAR[], 'ok': true},
                 {'place': CASE pre.into_ WHEN 'u' THEN 'a' ELSE 'u' END, 'cost': 1 + CASE fault WHEN 't' THEN 5 ELSE 0 END, 'letter': 'R',
                  'made': [CASE pre.into_ WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || r.text], 'ok': fault IN ('c', 't')},
                 {'place': initial, 'cost': CASE fault WHEN 't' THEN 5 ELSE 0 END, 'letter': 'K', 'made': [r.role || ':' || r.text],
                  'ok': fault IN ('c', 't') AND pre.into_ || initial IN ('-s', '-u', 'su', 'ua', 'au')}], recursive := true)) AS e
        WHERE e.ok
    ) GROUP BY conv_id, place
), f AS (
    SELECT w.conv_id, min({'cost': w.best.cost + pre.cost, 'audit': w.best.audit || pre.letters, 'made': w.best.made || pre.made}) AS best
    FROM w JOIN s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = s.n JOIN pre USING (place) WHERE pre.into_ IN ('-', 'a') GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(f.best.cost, 0) AS BIGINT) AS cost, coalesce(f.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(f.best.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, F.col("copies"))
