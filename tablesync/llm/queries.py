"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balanced, covertree, mixing, packing, passages, quality, quotes, repair, simhash, sketches, spelling, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups that links of three bits make."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query()
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text, and how alike they are."""
    return sketches.compare_with_next(table(spark, sf_dir, "documents"))


def held_out(id_column: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> quality.Model:
    return quality.train(docs, table(spark, sf_dir, "labels"), learn_from=~held_out("id"))


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, by a model learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_score(docs, quality_model(docs, spark, sf_dir))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document shares with one of a smaller id."""
    return passages.shared_passages(table(spark, sf_dir, "documents"))


# Target shares of the sources; what has none of its own shares one.
WEIGHTS = {f"src{i}": 1 + i % 4 for i in range(20)}


@query(mixing.sql(WEIGHTS, rest=1))
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, window, slot and position in the mix."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"), WEIGHTS, rest=1)


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query(urls.sql(RULES))
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page's URL."""
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query()
def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page's response record."""
    record = warc.response_record(F.col("page_id"), F.col("url"), F.col("html"), "2024-01-01T00:00:00Z")
    return warc.build_derivatives(table(spark, sf_dir, "pages").withColumn("record", record), keep=["page_id"])


@query()
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 or more between all vectors of equal label, and the groups they make."""
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query()
def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, sent as mail that quotes two levels, put in reply order without quotes."""
    return quotes.conversations(quotes.with_quotes(table(spark, sf_dir, "conversations")))


@query()
def op11_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 4096 whose attention costs are alike, none padded."""
    return balanced.pack(table(spark, sf_dir, "documents"))


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of seven letters or more, some with a letter lost, with the forms and roots they vary."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), damage_one_in=31)
    return spelling.group_variants(words, min_length=7)


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, with faults put in: their faults, the cheapest repair and a digest of its result."""
    rows = table(spark, sf_dir, "conversations")
    found = repair.audits(repair.repair(repair.damaged(rows)))
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return every.select("conv_id", *[F.coalesce(c, none.get(c, F.lit(0))).alias(c) for c in repair.AUDIT])
