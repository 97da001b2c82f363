"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. The order of the mix is the order of the rows in its files, which the
last stage packs front to back.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import mixing, packing, passages, quality, simhash
from tablesync.llm.common import Scratch
from tablesync.llm.queries import WEIGHTS, quality_model

# Tokens, hashes and models have no counterpart in SQL; tests compare run() with brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives 0.3 or more."""
    return quality.accepted(docs, quality_model(docs, spark, sf_dir), least=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of a smaller id has."""
    return passages.cut_passages(docs, passages.shared_passages(docs), length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.in_mixed_order(docs, WEIGHTS, rest=1)


def file_order(docs: DataFrame) -> list:
    """Where each row lies in the files that docs reads; nothing if it reads none."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return []
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in sequences of 2048 tokens."""
    return packing.pack(docs, order=file_order(docs))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        done, done_at = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(path)
        docs, path = done, done_at
    return STAGES[-1][1](spark, docs, sf_dir)
