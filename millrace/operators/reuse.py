"""Which questions a time-to-live store would have answered again.

A stored answer serves its question until ``ttl`` has passed and a hit does not renew it, so each
stored time follows from the one before: the next is the first question at least ``ttl`` later.
That chain is sequential per question text. It is cut into cells of length ``ttl``, which can hold
at most one stored time each, and into blocks that follow the rows (``ordered.slotted``), which are
summarised on their own: for every question that could be the first stored one of the block, the
last one it leads to. The few block rows are then walked in order, and the blocks filled in from
their entry times. A task sees about as many rows of a text as of any others, however often and
however fast it was asked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.text import question_key
from millrace.operators.ordered import slotted
from millrace.workspace import cut_lineage

FAN = 256  # blocks whose summaries are summarised together
SHORT_RUN = 4096
NEVER = -(2**62)


def reuse_labels(
    log: DataFrame, question: str, ts: str, row_id: str, ttl_seconds: float = 300, fan: int = FAN, short_run: int = SHORT_RUN,
) -> DataFrame:
    """Add ``key`` and ``hit`` to every question of a log; ``row_id`` must be unique."""
    ttl = int(ttl_seconds * 1_000_000)
    keyed = log.withColumn("key", question_key(F.col(question)))
    if ttl <= 0:
        return keyed.withColumn("hit", F.lit(False))
    instants = keyed.groupBy("key", F.unix_micros(F.col(ts).cast("timestamp")).alias("at")).agg(F.min(row_id).alias("first_id"))
    instants = instants.withColumn("cell", F.floor(F.col("at") / F.lit(ttl)).cast("bigint"))
    stored = instants.join(stored_times(instants, ttl, fan, short_run), ["key", "at"], "left_semi")
    misses = stored.select(F.col("first_id").alias(row_id), F.lit(True).alias("_miss"))
    return keyed.join(misses, row_id, "left").withColumn("hit", F.col("_miss").isNull()).drop("_miss")


def stored_times(
    instants: DataFrame, ttl: int, fan: int = FAN, short_run: int = SHORT_RUN
) -> DataFrame:
    """``(key, at)`` of the questions that were computed and stored.

    A question at least ``ttl`` after the one before it always starts a new chain, so a text's
    history falls into runs. A run of one cell stores its first question, a short run is folded as
    one bounded array, and only longer runs are cut into blocks.
    """
    cells = instants.groupBy("key", "cell").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("n"))
    by_cell = Window.partitionBy("key").orderBy("cell")  # at most one row per ttl of calendar time
    gap = F.lag("high").over(by_cell)
    fresh = cells.withColumn("_fresh", (gap.isNull() | (F.col("low") - gap >= ttl)).cast("int"))
    runs = fresh.withColumn("run", F.sum("_fresh").over(by_cell))
    same_run = Window.partitionBy("key", "run")
    runs = runs.withColumns({"_cells": F.count("*").over(same_run), "_n": F.sum("n").over(same_run)})
    alone = runs.where("_cells = 1").select("key", F.col("low").alias("at"))
    chained = runs.where("_cells > 1").select("key", "cell", "run", "_n")
    events = instants.join(chained, ["key", "cell"]).select(
        "key", "run", "_n", "at", F.col("cell").alias("part")
    )
    short = _folded(events.where(F.col("_n") <= short_run), ttl)
    long = events.where(F.col("_n") > short_run).select(F.concat_ws("/", "key", "run").alias("chain"), "part", "at")
    found = alone.unionByName(short)
    walked = _chained(slotted(long, ["chain"], ["at"]).withColumnRenamed("_slot", "block"), ttl, fan)
    return found if walked is None else found.unionByName(walked)


def _folded(events: DataFrame, ttl: int) -> DataFrame:
    """Stored times of runs that are known to be short."""
    arrays = events.groupBy("key", "run").agg(F.sort_array(F.collect_list("at")).alias("_ats"))
    start = F.struct(F.lit(NEVER).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("kept"))

    def step(state, at):
        stored = F.struct(at.alias("last"), F.concat(state["kept"], F.array(at)).alias("kept"))
        return F.when(at - state["last"] >= ttl, stored).otherwise(state)

    return arrays.select("key", F.explode(F.aggregate("_ats", start, step)["kept"]).alias("at"))


def _chained(events: DataFrame, ttl: int, fan: int) -> DataFrame | None:
    leaves = events.select("chain", F.col("block").cast("bigint").alias("block"), "part", F.col("at").alias("start"), F.col("at").alias("last"))
    # Both summaries are small against the log and read several times, so they are written out once.
    blocks = cut_lineage(_summarised(leaves, ttl))
    if blocks.isEmpty():
        return None
    groups = cut_lineage(_summarised(blocks_as_parts(blocks, fan), ttl))
    top = groups.select("chain", F.lit(0).cast("bigint").alias("block"), F.col("block").alias("part"), "start", "last")
    roots = top.select("chain", "block").distinct().withColumn("entry", F.lit(NEVER))
    group_entries = _entered(roots, top, ttl)
    block_entries = _entered(group_entries, blocks_as_parts(blocks, fan), ttl)
    found = _entered(block_entries, leaves, ttl, leaf=True)
    return found.select(F.split("chain", "/")[0].alias("key"), "at")


def blocks_as_parts(blocks: DataFrame, fan: int) -> DataFrame:
    return blocks.select(
        "chain", F.floor(F.col("block") / fan).cast("bigint").alias("block"), F.col("block").alias("part"), "start", "last"
    )


def _summarised(parts: DataFrame, ttl: int) -> DataFrame:
    """Per block: every possible first stored time and the last one it leads to."""

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "start"])
        start, last, part = (pdf[c].to_numpy() for c in ("start", "last", "part"))
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        bounds = list(zip(edges, np.r_[edges[1:], len(part)]))
        # What is stored before the block lies before its first time, so the next stored time is less
        # than one time to live after that, or the first one beyond.
        limit = int(np.searchsorted(start, start[0] + ttl))
        limit = min(limit + 1, len(start))
        where = np.searchsorted(edges, np.arange(limit), side="right") - 1
        leads = last[:limit].copy()
        for j, (low, high) in enumerate(bounds):
            place = np.searchsorted(start[low:high], leads + ttl)
            moved = (where < j) & (place < high - low)
            leads[moved] = last[low:high][place[moved]]
        return pd.DataFrame({"chain": key[0], "block": key[1], "start": start[:limit], "last": leads})

    return parts.groupBy("chain", "block").applyInPandas(summarise, "chain string, block bigint, start bigint, last bigint")


def _entered(entries: DataFrame, parts: DataFrame, ttl: int, leaf: bool = False) -> DataFrame:
    """Walk the parts of each block from its entry time: the entry of every part, or the stored times."""

    def walk(key: tuple, entry: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        state = int(entry["entry"].iloc[0])
        pdf = pdf.sort_values(["part", "start"])
        start, last, part = (pdf[c].to_numpy() for c in ("start", "last", "part"))
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        states, chosen = [], []
        for low, high in zip(edges, np.r_[edges[1:], len(part)]):
            states.append(state)
            place = low + int(np.searchsorted(start[low:high], state + ttl))
            if place < high:
                chosen.append(start[place])
                state = int(last[place])
        if leaf:
            return pd.DataFrame({"chain": key[0], "at": np.array(chosen, dtype=np.int64)})
        return pd.DataFrame({"chain": key[0], "block": part[edges], "entry": np.array(states, dtype=np.int64)})

    schema = "chain string, at bigint" if leaf else "chain string, block bigint, entry bigint"
    known = entries.select(F.col("chain").alias("_chain"), F.col("block").alias("_block"), "entry")
    return known.groupBy("_chain", "_block").cogroup(parts.groupBy("chain", "block")).applyInPandas(walk, schema)


def hit_rate(labelled: DataFrame) -> DataFrame:
    hits = F.count_if("hit")
    rate = F.coalesce(F.try_divide(hits.cast("double"), F.count("*").cast("double")), F.lit(0.0))
    return labelled.agg(F.count("*").alias("questions"), hits.alias("hits"), rate.alias("hit_rate"))
