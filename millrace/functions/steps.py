"""Keeping costly per-row work to one evaluation, on enough tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read instead of computing again.

    A filter on a derived column is normally pushed below it with its whole expression copied in.
    Going through a one-row generator stops that, at the price of one small array per row.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def spread_out(df: DataFrame) -> DataFrame:
    """Give costly per-row work at least one task per core.

    A table stored in few large files comes in few tasks; it is dealt out once before the work. A
    plan that already has enough tasks, or that shuffles anyway (its width is then adaptive), and
    a stream are left alone.
    """
    if df.isStreaming:
        return df
    try:
        plan = df._jdf.queryExecution()
        if "Exchange" in plan.executedPlan().toString():
            return df
        tasks = plan.toRdd().getNumPartitions()
        cores = df.sparkSession.sparkContext.defaultParallelism
    except AttributeError:
        return df
    return df.repartition(cores) if tasks < cores else df
