"""Corpus pipeline: documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet in the cluster's shared folder and read again as the next one's docs.
All but the last return the columns of ``documents``. Other columns of the
input pass through. What each stage does with NULLs, empty texts, repeated
rows and empty tables is its operator's defined result; a document whose lines
all went stays with an empty text until near-duplicates are dropped, which
keeps one empty document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm import langid, line_dedup, packing, quality, simhash
from obsgrid.llm.common import fold, fresh, table, written

#: a text's cosine with its language must be more than chance
LEAST_LANGUAGE_SCORE = 0.05
LEAST_QUALITY = 0.3


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; what has no letters, or looks like none of them, goes."""
    model = langid.learn(docs.where(fold(F.col("doc_id"), 4) != 2))
    found = fresh("found")
    return (docs.withColumn(found, langid.predict(spark, model, F.col("text")))
            .where((F.col(f"{found}.lang_pred") != langid.UNDECIDED) & (F.col(f"{found}.score") >= LEAST_LANGUAGE_SCORE))
            .drop(found))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0))
    return docs.where(quality.score(spark, model, F.col("text")) >= LEAST_QUALITY)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that stand earlier in the corpus."""
    gone, links = fresh("gone"), fresh("links")
    out = line_dedup.dedup_lines(docs, dropped=gone, n_links=links).drop(gone, links)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.unique_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, packed into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: the models and fingerprints have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
