"""Dropping lines that many documents share, decided on sorted line hashes.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys
become 128-bit hashes; texts stay where they are. Hashes are range-partitioned together with the
document, so one line that stands in a third of all documents still falls into many partitions, and
sorted by document (largest first) inside each. One pass over a partition streams the runs of equal
hashes: rows of the first document stay, the others go once enough documents have been seen. A run
that crosses a partition border is left open and settled from one summary per border. Decisions come
back as one compressed bitmap per document that loses a line.

Different lines with one 128-bit hash are not told apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from millrace.workspace import scratch_path

BLANK = bytes([0x20, *range(0x09, 0x0E)])
MIN_CHARS, MIN_DOCS = 40, 5
HELD_ROWS = 50_000  # undecided rows of one run a task keeps; above, the run is settled with the open ones
DROP, OPEN, SUMMARY = 1, 2, 3
RUN = ["h1", "h2"]


def line_hashes(text: bytes, min_chars: int = MIN_CHARS) -> tuple[int, dict[tuple[int, int], list[int]]]:
    """Number of lines, and the positions of every key of at least ``min_chars`` code points by its hash."""
    lines = text.split(b"\n")
    found: dict[tuple[int, int], list[int]] = {}
    for place, line in enumerate(lines):
        if len(line) < min_chars:
            continue
        key = line.strip(BLANK).lower()
        if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
            continue
        digest = blake2b(key, digest_size=16).digest()
        pair = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
        found.setdefault(pair, []).append(place)
    return len(lines), found


def packed(dropped: np.ndarray, n_lines: int) -> bytes:
    """Keep bitmap: bit i is 1 where line i stays, compressed."""
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


class Run:
    """The rows of one hash as they stream by, largest document first."""

    def __init__(self, first: bool, min_docs: int, held_rows: int):
        self.open = first  # the run may have begun in the partition before
        self.min_docs, self.held_rows = min_docs, held_rows
        self.n_docs, self.held, self.n_held = 0, [], 0

    def add(self, rows: pa.RecordBatch, fresh: np.ndarray) -> Iterator[tuple[pa.RecordBatch, int]]:
        """``fresh`` marks rows whose document is not that of the row before."""
        number = self.n_docs + np.cumsum(fresh)
        if not self.n_docs:
            self.head = rows.slice(0, 1)
        self.n_docs, self.tail = int(number[-1]), rows.slice(len(rows) - 1, 1)
        if self.open:
            yield rows, OPEN
            return
        rest = rows.slice(int(np.searchsorted(number, 1, side="right")))
        if self.n_docs >= self.min_docs:
            yield from self.release(DROP)
            yield rest, DROP
        elif len(rest):
            self.held.append(rest)
            self.n_held += len(rest)
            if self.n_held > self.held_rows:
                self.open = True
                yield from self.release(OPEN)

    def release(self, state: int) -> Iterator[tuple[pa.RecordBatch, int]]:
        yield from ((rows, state) for rows in self.held)
        self.held, self.n_held = [], 0

    def close(self, last: bool) -> Iterator[tuple[pa.RecordBatch, int]]:
        if last:  # it may go on in the next partition
            yield from self.release(OPEN)
        if self.open or last:
            yield self.head, SUMMARY


def stream_runs(batches: Iterator[pa.RecordBatch], doc: str, min_docs: int, held_rows: int) -> Iterator[tuple[pa.RecordBatch, int, Run | None]]:
    """Rows to drop, open rows and run summaries of one sorted partition."""
    run, before = None, None
    for batch in batches:
        if not len(batch):
            continue
        h1, h2, ids = (batch.column(batch.schema.get_field_index(c)) for c in (*RUN, doc))
        null = ids.is_null().to_numpy(zero_copy_only=False)
        values = pd.factorize(ids.to_pandas(), use_na_sentinel=True)[0]
        a, b = h1.to_numpy(), h2.to_numpy()
        new_run = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        new_doc = new_run | np.r_[True, (values[1:] != values[:-1]) | (null[1:] != null[:-1])]
        if before is not None and before[:2] == (a[0], b[0]):
            new_run[0], new_doc[0] = False, before[2] != ids[0].as_py()
        before = a[-1], b[-1], ids[-1].as_py()
        starts = np.flatnonzero(new_run)
        if not new_run[0]:  # goes on with the run of the batch before
            stop = int(starts[0]) if len(starts) else len(batch)
            yield from ((rows, state, run) for rows, state in run.add(batch.slice(0, stop), new_doc[:stop]))
        if not len(starts):
            continue
        first = run is None
        if run is not None:
            yield from ((rows, state, run) for rows, state in run.close(False))
        if first and len(starts) > 1:  # the first run of the partition
            run = Run(True, min_docs, held_rows)
            yield from ((rows, state, run) for rows, state in run.add(batch.slice(0, int(starts[1])), new_doc[: starts[1]]))
            yield from ((rows, state, run) for rows, state in run.close(False))
            starts, first = starts[1:], False
        inner, last = starts[:-1], int(starts[-1])
        if len(inner):  # runs that begin and end in this batch
            low = int(inner[0])
            docs = np.add.reduceat(new_doc[low:last].astype(np.int64), inner - low)
            sizes = np.diff(starts)
            number = np.cumsum(new_doc[low:last]) - np.repeat(np.cumsum(docs) - docs, sizes)
            gone = np.repeat(docs >= min_docs, sizes) & (number > 1)
            if gone.any():
                yield batch.slice(low, last - low).filter(pa.array(gone)), DROP, None
        run = Run(first, min_docs, held_rows)
        yield from ((rows, state, run) for rows, state in run.add(batch.slice(last), new_doc[last:]))
    if run is not None:
        yield from ((rows, state, run) for rows, state in run.close(True))


def text_key(text: Column) -> Column:
    """Tells rows with one id and different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _occurrences(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, text_key, n_lines, places): one row per document and key."""
    kind = StructType([docs.schema[key]]).fields[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).cast("binary").alias("text")).where("text is not null")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("h1", "h2", "at", "n_lines", "places")}
            for at, text in enumerate(batch.column(2).to_pylist()):
                n_lines, found = line_hashes(text, min_chars)
                for (h1, h2), places in found.items():
                    for name, value in zip(out, (h1, h2, at, n_lines, places)):
                        out[name].append(value)
            at = pa.array(out["at"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["h1"], pa.int64()), pa.array(out["h2"], pa.int64()), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(out["n_lines"], pa.int32()), pa.array(out["places"], pa.list_(pa.int32()))],
                names=["h1", "h2", "doc", "text_key", "n_lines", "places"])

    return rows.mapInArrow(split, f"h1 long, h2 long, doc {kind}, text_key long, n_lines int, places array<int>")


def _judged(lines: DataFrame, min_docs: int, held_rows: int) -> DataFrame:
    """Range-partition, sort and stream: rows with their ``state``, summaries with their numbers."""
    kind = dict(lines.dtypes)["doc"]
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last(), F.col("text_key")]
    placed = lines.repartitionByRange(*order).sortWithinPartitions(*order)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, state, run in stream_runs(batches, "doc", min_docs, held_rows):
            n = len(rows)
            if not n:
                continue
            tail, docs = (run.tail.column(2), run.n_docs) if state == SUMMARY else (pa.nulls(n, rows.column(2).type), 0)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([state] * n, pa.int32()), pa.array([docs] * n, pa.int64()), tail],
                names=[*rows.schema.names, "state", "n_docs", "last_doc"])

    return placed.mapInArrow(judge, f"h1 long, h2 long, doc {kind}, text_key long, n_lines int, places array<int>, state int, n_docs long, last_doc {kind}").withColumn(
        "part", F.spark_partition_id())


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, held_rows: int = HELD_ROWS
) -> DataFrame:
    """(key, text_key, n_lines, n_dropped, keep) of every document that loses a line.

    A key of at least ``min_chars`` code points that stands in at least ``min_docs`` documents keeps
    its lines in the document with the largest id only. Rows with one id are one document and share
    its fate; a null id is an id of its own, below all others. Texts that are null, empty or without
    a long line lose nothing. An empty table gives an empty result. Other columns do not matter.
    """
    spark = docs.sparkSession
    paths = [scratch_path(spark, f"line-{name}") for name in ("hashes", "judged", "bitmaps")]
    _occurrences(docs, key, text, min_chars).write.parquet(paths[0])  # range bounds are sampled from it
    _judged(spark.read.parquet(paths[0]), min_docs, held_rows).write.parquet(paths[1])
    judged = spark.read.parquet(paths[1])

    pieces = judged.where(F.col("state") == SUMMARY)
    in_order = Window.partitionBy(*RUN).orderBy("part")
    went_on = (F.lag("part").over(in_order).isNotNull() & F.lag("last_doc").over(in_order).eqNullSafe(F.col("doc"))).cast("int")
    # Two summaries per partition at most, and one per ``held_rows`` rows of repeated ids.
    totals = pieces.select(*RUN, "part", "n_docs", "doc", went_on.alias("shared")).groupBy(*RUN).agg(
        (F.sum("n_docs") - F.sum("shared")).alias("_docs"), F.min_by(F.struct("doc"), "part").alias("_first"))
    many = F.broadcast(totals.where(F.col("_docs") >= min_docs))
    settled = judged.where(F.col("state") == OPEN).join(many, RUN).where(~F.col("_first.doc").eqNullSafe(F.col("doc")))
    dropped = judged.where(F.col("state") == DROP).select("doc", "text_key", "n_lines", "places").unionByName(settled.select("doc", "text_key", "n_lines", "places"))
    # Repeated rows name their lines once each; positions of one document are bounded by its text.
    lost = dropped.groupBy("doc", "text_key").agg(F.first("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))

    @F.pandas_udf("binary")
    def bitmap(places: pd.Series, n_lines: pd.Series) -> pd.Series:
        return pd.Series([packed(np.asarray(p, np.int64), n) for p, n in zip(places, n_lines)])

    lost.select(
        F.col("doc").alias(key), "text_key", F.col("n_lines").cast("long").alias("n_lines"), F.size("places").cast("long").alias("n_dropped"),
        bitmap("places", "n_lines").alias("keep"),
    ).write.parquet(paths[2])
    return spark.read.parquet(paths[2])


def kept_lines(docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_dropped, kept): every row of ``docs`` with the lines its bitmap keeps.

    The bitmaps are a written table, so Spark knows their size and sends them to the texts when they
    are small. A null text counts as one empty line.
    """
    @F.pandas_udf("string")
    def cut(texts: pd.Series, keep: pd.Series, n_lines: pd.Series) -> pd.Series:
        return pd.Series([
            None if bits is None else "\n".join(line for line, stays in zip(value.split("\n"), unpacked(bits, int(n))) if stays)
            for value, bits, n in zip(texts, keep, n_lines)], dtype=object)

    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), text_key(F.col(text)).alias("_key"))
    met = rows.join(bitmaps, F.col("_id").eqNullSafe(F.col(key)) & (F.col("_key") == F.col("text_key")), "left")
    changed = cut(F.when(F.col("keep").isNotNull(), F.col("_text")), F.col("keep"), F.coalesce("n_lines", F.lit(0)))
    whole = F.coalesce(F.col("_text"), F.lit(""))
    return met.select(
        F.col("_id").alias(key), F.size(F.split(whole, "\n")).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNotNull(), changed).otherwise(whole).alias("kept"))


def drop_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents without the lines that many share: ``keep_bitmaps``, then ``kept_lines``."""
    return kept_lines(docs, keep_bitmaps(docs, key, text, min_chars, min_docs), key, text)
