"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next stage's docs. All but the last return
the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.llm import langid, linededup, packing, simhash, tiling
from kinfold.llm.common import remainder
from kinfold.session import configure, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Compression sizes, bit links and tiles are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Rejected: no letter at all, a tie between languages, or a margin narrower than nearly all clean texts have."""
    dictionaries, margins = langid.fit(docs, remainder("doc_id", 4) != 2)
    return langid.recognised(docs, dictionaries, min_margin=margins).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has too. Every document stays."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest doc_id."""
    return simhash.one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return tiling.without_leaks(docs, benchmark).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 words without two documents of one source or two copies."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result stored before the next one reads it."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
