"""Importance resampling towards a target: hashed n-gram features, gains per bucket, Gumbel draw.

Corpus counts come from distinct lines: newlines separate words, so a text is cut at them, equal
lines of all texts are counted before the features of each are taken once and multiplied, and the
n-grams that cross a newline are added from the texts themselves.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.workspace import cut_lineage

BUCKETS = 10_000
#: Words of any case; only A-Z is lower-cased before they are hashed.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
MIN_WORDS, PERCENT, SEED = 20, 10, "2024"
KNOWN_WORDS, KNOWN_LINES = 200_000, 20_000  # what a task remembers of the words and lines it has hashed
ROW_INDEX = (1 << 33) - 1  # the part of a monotonically increasing id that counts rows of a partition


class Known(dict):
    """What a function gives for each key, worked out at the first use."""

    def __init__(self, work, most: int = KNOWN_WORDS):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.work(key)
        return value


def word_bytes(raw: str) -> bytes:
    return raw.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only


class Hasher:
    """Buckets of the n-grams of word lists, remembering single words."""

    def __init__(self, max_n: int, buckets: int):
        self.max_n, self.buckets = max_n, buckets
        self.bucket = Known(lambda raw: zlib.crc32(word_bytes(raw)) % buckets)
        self.bytes = Known(word_bytes)

    def line(self, text: str) -> list[int]:
        """Buckets of all runs of 1 to ``max_n`` words of one line."""
        found = WORD.findall(text)
        out = [*map(self.bucket.__getitem__, found)]
        if self.max_n > 1:
            words = [*map(self.bytes.__getitem__, found)]
            for n in range(2, self.max_n + 1):
                out += [zlib.crc32(b" ".join(words[i:i + n])) % self.buckets for i in range(len(words) - n + 1)]
        return out

    def across(self, lines: list[str]) -> list[int]:
        """Buckets of the runs of words that begin in one line and end in a later one."""
        if self.max_n < 2 or len(lines) < 2:
            return []
        words, home = [], []
        for number, line in enumerate(lines):
            found = WORD.findall(line)
            words += map(self.bytes.__getitem__, found)
            home += [number] * len(found)
        return [
            zlib.crc32(b" ".join(words[i:i + n])) % self.buckets
            for n in range(2, self.max_n + 1) for i in range(len(words) - n + 1) if home[i] != home[i + n - 1]]


def _tallies(rows: DataFrame, max_n: int, buckets: int, across: bool) -> DataFrame:
    """(bucket, n) per task: of distinct ``line`` with its ``times``, or of texts in ``line`` across their newlines."""

    def settle(total: np.ndarray, found: list[int], times: list[tuple[int, int]]) -> None:
        if times:
            long, n = np.array(times, np.int64).T
            np.add.at(total, np.array(found, np.int64), np.repeat(n, long))
        found.clear()
        times.clear()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(max_n, buckets), np.zeros(buckets, np.int64)
        found, times = [], []
        for batch in batches:
            for line, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                these = hasher.across(line.split("\n")) if across else hasher.line(line)
                found += these
                times.append((len(these), n))
                if len(found) > 1_000_000:
                    settle(total, found, times)
        settle(total, found, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return rows.mapInArrow(tally, "bucket long, n long")


def bucket_counts(docs: DataFrame, text: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; ``buckets`` numbers reach the driver.

    Lines are counted in the tasks that read them before equal ones meet, so a line in a third of
    all documents is one row per task.
    """
    texts = docs.select(F.col(text).alias("line")).where("line is not null")
    lines = texts.select(F.explode(F.split("line", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    counts = _tallies(lines, max_n, buckets, False)
    if max_n > 1:
        counts = counts.unionByName(_tallies(texts.withColumn("times", F.lit(1).cast("long")), max_n, buckets, True))
    total = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) of every bucket."""
    size, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t + 1) * float(all_source + size)) / (float(s + 1) * float(all_target + size))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", max_n: int = 1) -> DataFrame:
    """(key, n_words, n_features, weight) of every row; a task sums the gains of a repeated line once."""
    kind = dict(docs.dtypes)[key]
    table = gains.tolist()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(max_n, len(table))
        seen: dict[str, tuple[int, int, int]] = {}
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = features = weight = 0
                lines = (text or "").split("\n")
                for line in lines:
                    found = seen.get(line)
                    if found is None:
                        buckets = hasher.line(line)
                        n = len(buckets)
                        found = (n if max_n == 1 else len(WORD.findall(line))), n, sum(map(table.__getitem__, buckets))
                        if len(line) < 1000:
                            if len(seen) >= KNOWN_LINES:
                                seen.clear()
                            seen[line] = found
                    words, features, weight = words + found[0], features + found[1], weight + found[2]
                crossing = hasher.across(lines)
                out.append((words, features + len(crossing), weight + sum(map(table.__getitem__, crossing))))
            sums = [pa.array(list(c), pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums], names=[key, "n_words", "n_features", "weight"])

    return docs.select(key, text).mapInArrow(weigh, f"`{key}` {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the sha256 of ``seed:key``; a null key counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], limit: int, out: str = "rank") -> DataFrame:
    """Number the first ``limit`` rows of a total order from 1; the others get null.

    Rows are range-partitioned by the order and written; a row's number is its place in its sorted
    partition behind the rows of the partitions before, one number per partition.
    """
    placed = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    numbered = placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33).cast("int"))
    before, offsets = 0, []
    for part, n in sorted((r["_part"], r["n"]) for r in numbered.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets.append((part, before))
        before += n
    first = rows.sparkSession.createDataFrame(offsets, "_part int, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit(ROW_INDEX)) + 1
    return numbered.join(F.broadcast(first), "_part").withColumn(out, F.when(rank <= limit, rank)).drop("_at", "_part", "_before")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", max_n: int = 1,
    buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every document; drawn ones have a rank.

    Of the N documents with at least ``min_words`` words the floor(percent N / 100) highest scores
    are drawn, ties to the smaller id, null ids last. Texts that are null, empty or without a word
    have no feature and weight 0. Repeated rows count each and get ranks of their own. An empty
    target gives gains from the source alone, an empty table an empty result. Other columns do not
    matter.
    """
    gains = bucket_gains(bucket_counts(docs, text, max_n, buckets), bucket_counts(target, target_text, max_n, buckets))
    scored = cut_lineage(weights(docs, gains, key, text, max_n).withColumn("score", F.col("weight") + gumbel(F.col(key), seed)))
    able = F.col("n_words") >= min_words
    n = scored.where(able).count()
    order = [F.desc("score"), F.col(key).asc_nulls_last(), F.col("n_features"), F.col("weight")]
    drawn = ranked(scored.where(able), order, percent * n // 100)
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(key, "n_features", "weight", "score", "rank")
