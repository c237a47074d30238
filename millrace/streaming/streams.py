"""Structured Streaming jobs: ingest, windows, late rows and refreshed summaries.

Batch writers put every micro-batch under its own ``batch=<id>`` folder and overwrite it, so a
replayed batch after a failure leaves no second copy. Summaries are merged into the partitions they
touch, and marks live in a table of one row, so neither grows with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.validate import (
    RowRules, TRANSACTION_RULES, dead_letters, enrich, message_columns, valid_rows, validated_messages,
)
from millrace.sources.sinks import MissingTable
from millrace.sources.tables import after_mark, typed
from millrace.streaming.state import TurnTable, merge_partitions, put_partitions, stored_rows

Route = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Stream over the Parquet files of a folder or glob."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Message bytes of a topic as ``raw`` with their unique position and arrival time."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.options(**options).load().select(
        F.col("value").alias("raw"),
        F.concat_ws("/", "topic", "partition", "offset").alias("position"),
        F.col("timestamp").alias("arrived"),
    )


# Drain what is there and stop; pass e.g. {"processingTime": "1 minute"} to keep running.
DRAIN = {"availableNow": True}


def write_batches(
    stream: DataFrame, checkpoint: str, writer: Callable[[DataFrame, int], None], mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .foreachBatch(writer).trigger(**(trigger or DRAIN)).start()
    )


def batch_folder(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def route_batches(
    stream: DataFrame, route: Route, good: str, refused: str, checkpoint: str,
    partition: str | None = None, trigger: dict | None = None, judge: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Split every micro-batch into rows to keep and dead letters, read once and written twice.

    ``judge`` does the work that both share, such as parsing: it is done once a batch, and ``route``
    gets its result.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch if judge is None else judge(batch)
        batch.persist()
        try:
            kept, dead = route(batch)
            out = kept.write.mode("overwrite")
            (out.partitionBy(partition) if partition else out).parquet(batch_folder(good, number))
            dead.write.mode("overwrite").json(batch_folder(refused, number))
        finally:
            batch.unpersist()

    return write_batches(stream, checkpoint, write, trigger=trigger)


def deduplicated(stream: DataFrame, key: list[str], arrived: str, delay: str = "1 hour") -> DataFrame:
    """First row per key within the delay; the state is dropped once the watermark has passed."""
    return stream.withColumn(arrived, F.col(arrived).cast("timestamp")).withWatermark(arrived, delay).dropDuplicatesWithinWatermark(key)


def ingest_stream(
    messages: DataFrame, good: str, refused: str, checkpoint: str, as_of: str, source: str = "pubsub_streaming",
    rules: RowRules = TRANSACTION_RULES, key: str = "transaction_id", delay: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Parse, validate, drop repeats, enrich, append; refused messages go to dead letters.

    ``messages`` has ``raw``, a unique ``position`` and the time it ``arrived``. Valid messages are
    deduplicated by their key; refused ones are all kept and take no room in the state.
    """
    checked = validated_messages(messages, rules)
    keyed = checked.where(F.size("errors") == 0).withColumn("_key", F.try_variant_get("record", f"$.{key}", "string"))
    refused_rows = checked.where(F.size("errors") > 0).withColumn("arrived", F.col("arrived").cast("timestamp"))
    unique = deduplicated(keyed, ["_key"], "arrived", delay).drop("_key").unionByName(refused_rows)

    def route(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        loaded = enrich(message_columns(valid_rows(batch)), as_of, source)
        return loaded.drop("position", "arrived"), dead_letters(batch, as_of)

    return route_batches(unique, route, good, refused, checkpoint, trigger=trigger)


def append_stream(stream: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append to a table that must already exist."""
    if not stream.sparkSession.catalog.tableExists(table):
        raise MissingTable(table)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).toTable(table)


def windowed(
    stream: DataFrame, ts: str, keys: list[str], aggs: dict[str, Column], window: str = "5 minutes", lateness: str = "1 hour"
) -> DataFrame:
    """Tumbling windows per key; rows later than ``lateness`` are not counted."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    totals = timed.groupBy(F.window(ts, window).alias("_w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return totals.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"), F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
        *keys, *aggs,
    )


def append_batches(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Final rows of a stream, one folder per batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, number))

    return write_batches(rows, checkpoint, write, trigger=trigger)


def summary_stream(
    totals: DataFrame, path: str, checkpoint: str, keys: list[str], partition: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep a summary table up to date with the changed groups of a running aggregate.

    The table is partitioned by ``partition`` (one of the groups' ``keys``, such as the day); a batch
    rewrites the partitions it touches and nothing else.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            merge_partitions(batch.sparkSession, batch, path, keys, partition, number)
        finally:
            batch.unpersist()

    return write_batches(totals, checkpoint, write, mode="update", trigger=trigger)


def summed_windows(
    stream: DataFrame, ts: str, keys: list[str], sums: dict[str, Column], path: str, checkpoint: str, partition: str, period: str = "day",
    window: str = "5 minutes", lateness: str = "1 hour", trigger: dict | None = None,
) -> StreamingQuery:
    """Tumbling windows per key, added up in a summary table instead of in state.

    For windows that are about as many as the rows: a micro-batch is summed by itself and its sums are
    added to the table, so no group stays in the memory of an executor. ``sums`` are counts and sums,
    ``partition`` is the day or month (``period``) of a window. Windows that ended ``lateness`` before
    the newest time of earlier batches get no more rows.

    A batch writes its sums and then a mark: the newest time, and whether the table was still missing.
    A replay after that mark adds the same sums to the same stored rows.
    """
    spark = stream.sparkSession
    groups = [partition, "window_start", "window_end", *keys]

    def write(batch: DataFrame, number: int) -> None:
        own, marks = TurnTable(spark, f"{path}__own"), TurnTable(spark, f"{path}__marks")
        done = marks.newest()
        if done is None or done[0] != number:
            earlier = marks.read(before=number)
            mark = earlier.first()["newest"] if earlier is not None else None
            newest = Observation()
            timed = batch.withColumn(ts, F.col(ts).cast("timestamp")).observe(newest, F.unix_micros(F.max(ts)).alias("newest"))
            timed = timed.withColumn("_w", F.window(ts, window)).withColumns({"_start": F.col("_w.start"), "_end": F.col("_w.end")})
            if mark is not None:
                timed = timed.where(F.col("_end") > F.timestamp_micros(F.lit(mark)) - F.expr(f"INTERVAL {lateness}"))
            totals = timed.groupBy("_start", "_end", *keys).agg(*[a.alias(n) for n, a in sums.items()]).select(
                F.col("_start").cast("timestamp_ntz").alias("window_start"), F.col("_end").cast("timestamp_ntz").alias("window_end"), *keys, *sums,
            ).withColumn(partition, F.to_date(F.date_trunc(period, "window_start")))
            missing = stored_rows(spark, path, totals.schema) is None
            own.write(totals, number)
            reached = max((t for t in (newest.get["newest"], mark) if t is not None), default=None)
            marks.write(spark.range(0, 1, 1, 1).select(F.lit(reached).cast("long").alias("newest"), F.lit(missing).alias("first")), number)
        if marks.read().first()["first"]:
            put_partitions(own.read(), path, partition)
        else:
            merge_partitions(spark, own.read(), path, groups, partition, number, added=list(sums))

    return write_batches(stream, checkpoint, write, trigger=trigger)


def split_late(
    stream: DataFrame, ts: str, on_time: str, late: str, marks: str, checkpoint: str, lateness: str = "1 hour",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rows older than the newest time of earlier batches minus ``lateness`` go to a side table.

    The newest time is one row, written with the batch that reached it; a replay reads the mark of
    the batch before, so it splits the same way again.
    """

    def write(batch: DataFrame, number: int) -> None:
        state = TurnTable(batch.sparkSession, marks)
        batch.persist()
        try:
            earlier = state.read(before=number)
            mark = earlier.first()["newest"] if earlier is not None else None
            limit = typed(mark, "timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
            is_late = F.coalesce(F.col(ts) < limit, F.lit(False))
            batch.where(~is_late).write.mode("overwrite").parquet(batch_folder(on_time, number))
            batch.where(is_late).write.mode("overwrite").parquet(batch_folder(late, number))
            newest = F.greatest(F.max(ts), typed(mark, "timestamp_ntz"))
            state.write(batch.agg(newest.cast("timestamp_ntz").alias("newest")), number)
        finally:
            batch.unpersist()

    return write_batches(stream, checkpoint, write, trigger=trigger)


def load_new(
    rows: DataFrame, column: str, path: str, marks: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> int:
    """Append the rows above the stored high-water mark of ``column`` and move the mark; returns the load's number.

    A load writes its own folder and then the mark with its number. After a crash between the two the
    next load has the same number and the same mark, so it writes that folder anew: nothing is lost or
    doubled. The mark is taken from what was written, not from the source, which may have grown.
    Rows without a value in ``column`` are not loaded.
    """
    spark = rows.sparkSession
    state = TurnTable(spark, marks)
    stored = state.read()
    last = stored.first() if stored is not None else None
    number = 0 if last is None else last["load"] + 1
    fresh = after_mark(rows.where(F.col(column).isNotNull()), column, None if last is None else last["mark"])
    folder = batch_folder(path, number)
    (fresh if prepare is None else prepare(fresh)).write.mode("overwrite").parquet(folder)
    top = spark.read.schema(rows.select(column).schema).parquet(folder).agg(F.max(column).alias("mark"))
    if last is not None:
        top = top.select(F.coalesce("mark", typed(last["mark"], dict(rows.dtypes)[column])).alias("mark"))
    state.write(top.withColumn("load", F.lit(number).cast("long")), number)
    return number


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HELD_ROWS = 1_000_000  # times and ids of one question that a task holds at once, 16 bytes each


def walk_times(times: np.ndarray, stored: int | None, ttl: int) -> tuple[np.ndarray, int]:
    """Hits of ascending ``times``, and the stored time after them; every stored time is one step."""
    hits = np.ones(len(times), bool)
    at = 0
    while at < len(times):
        if stored is None or times[at] - stored >= ttl:
            hits[at], stored = False, int(times[at])
        at = max(at + 1, int(np.searchsorted(times, stored + ttl)))
    return hits, stored


class ReuseProcessor(StatefulProcessor):
    """One stored time per question; a timer drops it once its time to live has passed."""

    def __init__(self, ttl: int, held_rows: int):
        self.ttl, self.held_rows = ttl, held_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("stored", "at long")

    def _expiry(self, stored: int) -> int:
        return (stored + self.ttl) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues):
        held, n = [], 0
        for batch in rows:
            held.append((batch["at"].to_numpy(np.int64), batch["row_id"].to_numpy(np.int64)))
            n += len(batch)
            if n >= self.held_rows:
                yield self._walk(key, held, timerValues)
                held, n = [], 0
        if n:
            yield self._walk(key, held, timerValues)

    def _walk(self, key, held, timerValues) -> pd.DataFrame:
        times, ids = (np.concatenate(parts) for parts in zip(*held))
        order = np.lexsort((ids, times))
        before = self.stored.get()[0] if self.stored.exists() else None
        hits, now = walk_times(times[order], before, self.ttl)
        if now != before:
            if before is not None:
                self.handle.deleteTimer(self._expiry(before))
            self.stored.update((now,))
            self.handle.registerTimer(max(self._expiry(now), timerValues.getCurrentWatermarkInMs() + 1))
        return pd.DataFrame({"key": key[0], "row_id": ids[order], "hit": hits})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.stored.clear()
        return iter([])

    def close(self) -> None:
        pass


def reuse_stream(
    questions: DataFrame, ts: str, row_id: str, ttl_seconds: int, lateness: str = "1 hour", held_rows: int = HELD_ROWS
) -> DataFrame:
    """Hit or miss per question of a stream with a ``key``; the state is one stored time per key.

    The rows of one question in a micro-batch arrive as Arrow batches; their times are walked in
    order, ``held_rows`` at a time, so a question asked without end needs no more memory. One that is
    older than the stored answer finds it. The state is dropped by an event-time timer when the
    answer's time to live has passed by ``lateness``.
    """
    # Timers and several state variables need this store; the choice is kept with the checkpoint.
    questions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = questions.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    rows = timed.select("key", F.col(row_id).cast("long").alias("row_id"), F.unix_micros(ts).alias("at"), ts)
    return rows.groupBy("key").transformWithStateInPandas(
        ReuseProcessor(ttl_seconds * 1_000_000, held_rows), "key string, row_id bigint, hit boolean", "append", "EventTime")
