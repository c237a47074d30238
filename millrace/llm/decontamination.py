"""Benchmark decontamination: size-partitioned MinHash containment search, exact verification.

Only DataFrame functions run on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.workspace import cut_lineage

SHINGLE = 5
CONTAINED = 0.8
MINIMA = 6  # minimum hashes published per item of the smallest size class, one more per class
BROADCAST_ROWS = 500_000  # 16 bytes each; above it the sketch meets the documents in a shuffle


def words(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _once(value: Column, made) -> Column:
    """``made(value)`` with the value computed once per row instead of at each of its places."""
    return F.element_at(F.transform(F.array(value), made), 1)


def shingles(word_list: Column, k: int) -> Column:
    """All runs of ``k`` words as texts; empty if there are fewer words."""
    return _once(word_list, lambda w: F.when(
        F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.array_join(F.slice(w, i, k), " "))).otherwise(
        F.array().cast("array<string>")))


def shingle_hashes(word_list: Column, k: int) -> Column:
    """64-bit hashes of all runs of ``k`` words, without building the texts."""
    def runs(h: Column) -> Column:
        return F.when(F.size(h) >= k, F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))

    return _once(F.transform(word_list, lambda w: F.xxhash64(w)), runs)


def item_sketches(items: DataFrame, k: int, minima: int = MINIMA) -> DataFrame:
    """(item, h): each item's smallest shingle hashes, their number fixed by its size class.

    Classes are powers of two of the number of distinct shingles. An item with at most ``minima``
    shingles publishes all of them.
    """
    hashes = F.array_sort(F.array_distinct(shingle_hashes(F.col("words"), k)))
    rows = items.select("item", hashes.alias("hashes"))
    size_class = F.floor(F.log2(F.greatest(F.size("hashes"), F.lit(1)))).cast("int")
    return rows.select("item", F.explode(F.slice("hashes", 1, F.lit(minima) + size_class)).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, k: int = SHINGLE, key: str = "doc_id",
                 text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Items found in documents: (doc key, item key, n_item, n_shared, containment).

    A pair is listed if at least ``contained`` of the item's distinct runs of ``k`` words stand in the
    document. Items publish minimum hashes by size class. Long documents are not sketched, since a
    short item would be lost in their minima: all their shingles are probed against the published
    hashes. An item contained to 0.8 then goes unseen only if none of its at least six minima is
    in the document, with probability below 0.2^6 for random losses and never for whole items of
    one class; every hit is verified on shingle texts.

    Items of fewer than ``k`` words count as one shingle of all their words; items without words
    (or null) are never found. Null and empty documents contain nothing. Repeated rows of a key are
    found once. Other columns do not matter.
    """
    listed = items.select(F.col(item_key).alias("item"), words(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    listed = cut_lineage(listed.withColumn("k", F.least(F.size("words"), F.lit(k))))
    lengths = sorted(r["k"] for r in listed.select("k").distinct().collect())  # k values at most
    out = None
    for length in lengths:
        part = _contaminated(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), listed.where(F.col("k") == length), contained, length)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select(F.col(key).alias("doc")).limit(0).crossJoin(F.broadcast(items.select(F.col(item_key).alias("item")).limit(0))).selectExpr(
            "doc", "item", "0L AS n_item", "0L AS n_shared", "0D AS containment")
    return out.withColumnsRenamed({"doc": key, "item": item_key})


def _contaminated(docs: DataFrame, items: DataFrame, contained: float, k: int) -> DataFrame:
    sketch = cut_lineage(item_sketches(items, k))
    small = sketch.count() <= BROADCAST_ROWS
    bounded = F.broadcast if small else (lambda df: df)
    probes = docs.select("doc", F.explode(shingle_hashes(words(F.col("text")), k)).alias("h"))
    found = cut_lineage(probes.join(bounded(sketch), "h").select("doc", "item").distinct())
    wanted = items.select("item", F.array_distinct(shingles(F.col("words"), k)).alias("wanted"))
    pairs = found.join(bounded(wanted), "item")
    # equal keys may stand on several rows: the best row counts
    held = docs.join(found.select("doc").distinct(), "doc", "left_semi").select("doc", shingles(words(F.col("text")), k).alias("held"))
    checked = pairs.join(held, "doc").select(
        "doc", "item", F.size("wanted").cast("long").alias("n_item"), F.size(F.array_intersect("wanted", "held")).cast("long").alias("n_shared"))
    best = checked.groupBy("doc", "item", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return best.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= contained)
