"""The registered queries of this package: (spark, sf_dir) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import checks, decontamination, langid, licences, linededup, mixing, neardup, pii, resampling, sharding, suffixdedup, tokenfiles, topk, vectorcodes
from millrace.sources.tables import table

TOKENIZER = "word_bpe_49k.json"


def op1_top_k_search(spark: SparkSession, root: str) -> DataFrame:
    """The 20 best inner products of quantised vectors for every row whose id 20 divides."""
    found = topk.top_k(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0, 20, scale=64)
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op2_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Documents without 100-byte strings that stand earlier too."""
    rest = suffixdedup.remove_repeats(table(spark, root, "documents"))
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Class of near copies of every document."""
    return neardup.near_duplicates(table(spark, root, "documents"))


def op4_language(spark: SparkSession, root: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32 of the id leaves a rest other than 1."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = table(spark, root, "documents")
    found = langid.identify(docs, learn=~held_out)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op5_personal_data(spark: SparkSession, root: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, root, "documents")
    spans = pii.find_spans(docs, pii.train(docs, "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def listed(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return spans.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_mixing(spark: SparkSession, root: str) -> DataFrame:
    """How often the mix takes each document, sources weighing 5, 2, 1 in turn."""
    return mixing.mix(table(spark, root, "documents"), [5.0, 2.0, 1.0], 3).drop("source")


def op7_sharding(spark: SparkSession, root: str) -> DataFrame:
    """Eight shards of nearly equal bytes."""
    placed = sharding.shard(table(spark, root, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Benchmark items whose five-word runs stand to 0.8 in a document."""
    return decontamination.contaminated(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op9_token_files(spark: SparkSession, root: str) -> DataFrame:
    """Token ids of all documents, written as Arrow files and read back."""
    import public_tokenizers

    docs = table(spark, root, "documents")
    folder = tokenfiles.token_folder(docs)
    parts = tokenfiles.write_token_files(docs, public_tokenizers.path(TOKENIZER), folder)
    return tokenfiles.read_token_files(parts, folder)


def op10_licences(spark: SparkSession, root: str) -> DataFrame:
    """Licence families named in every document."""
    docs = table(spark, root, "documents")
    return licences.scan(docs, licences.train(docs, "doc_id", "text"))


def op11_vector_codes(spark: SparkSession, root: str) -> DataFrame:
    """Product codes of all vectors over codebooks of 256 entries for 4 parts."""
    return vectorcodes.encode(table(spark, root, "embeddings"))


def op12_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Documents without the long lines that five or more of them share."""
    rest = linededup.drop_shared_lines(table(spark, root, "documents"))
    return rest.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_resampling(spark: SparkSession, root: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark."""
    return resampling.resample(table(spark, root, "documents"), table(spark, root, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    **{f.__name__: f for f in (
        op1_top_k_search, op2_suffix_dedup, op3_near_duplicates, op4_language, op5_personal_data, op6_mixing, op7_sharding, op8_decontamination, op9_token_files,
        op10_licences, op11_vector_codes, op12_line_dedup, op13_resampling)},
}
SQL: dict[str, str] = {
    name: sql for name, sql in {
        "pipeline": corpus_pipeline.ORACLE_SQL, "op1_top_k_search": checks.TOP_K, "op8_decontamination": checks.DECONTAMINATION, "op11_vector_codes": checks.vector_codes(), "op12_line_dedup": checks.LINE_DEDUP, "op13_resampling": checks.RESAMPLING,
    }.items() if sql}
