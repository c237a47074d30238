"""Training-data pipeline over ``documents``: language, near copies, benchmark leaks, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns documents; the last adds its shard columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontamination, langid, mixing, neardup, sharding
from millrace.sources.tables import table
from millrace.workspace import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ROW = "_row"


def with_row(docs: DataFrame) -> DataFrame:
    """Documents with a key of each row, its id and the hash of its text: a null id has one too, and
    rows that share an id but not the text are judged apart. Equal rows share their key."""
    return docs.withColumn(ROW, F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that language identification does not reject; texts that are null or without a letter go."""
    rows = with_row(docs)
    refused = langid.identify(rows, key=ROW).where("rejected").select(ROW).distinct()
    return rows.join(refused, ROW, "left_anti").select(COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each class of near copies; repeated rows of that id stay, and so do rows without an id."""
    rest = neardup.near_duplicates(docs).where("class_id != doc_id").select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    rows = with_row(docs)
    leaks = decontamination.contaminated(rows, table(spark, sf_dir, "benchmark"), key=ROW).select(ROW).distinct()
    return rows.join(leaks, ROW, "left_anti").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; equal rows stand together for the copies of all of them."""
    rows = with_row(docs)
    taken = mixing.mix(rows, key=ROW).groupBy(ROW).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    once = rows.join(taken, ROW)
    lone = once.where("rows = 1").unionByName(once.where("rows > 1").dropDuplicates([ROW]))
    return lone.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard of each row, with its place in the shard."""
    return sharding.shard(docs, 8).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
