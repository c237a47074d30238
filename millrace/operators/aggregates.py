"""Grouped summaries that are not plain one-liners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.numbers import money_avg, money_sum, safe_ratio

TERABYTE = 1024**4
GIGABYTE = 1024**3
PRICE_PER_TERABYTE = 6.25


def key_profile(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """Rows per key, the largest first."""
    return df.groupBy(key).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), key).limit(top)


def skew_ratio(df: DataFrame, key: str) -> DataFrame:
    """Largest key against the median key."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    stats = counts.agg(F.max("n").alias("largest"), F.percentile_approx("n", 0.5, 10_000).alias("median"))
    return stats.withColumn("ratio", safe_ratio(F.col("largest"), F.col("median")))


def summary_by_day(df: DataFrame, day: str, segment: str, amount: str) -> DataFrame:
    return df.groupBy(day, segment).agg(
        F.count("*").alias("transactions"),
        money_sum(amount).alias("total_revenue"),
        money_avg(amount).alias("avg_revenue"),
    )


def top_share(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows held by the ``n`` largest keys, and their share of all rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), key).limit(n).agg(F.sum("n").alias("top_rows"))
    return top.select(
        "top_rows", counts.agg(F.sum("n").alias("s")).scalar().alias("all_rows")
    ).withColumn("share", safe_ratio(F.col("top_rows"), F.col("all_rows")))


def conditional_sum(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def scan_cost(bytes_billed: Column) -> Column:
    return F.sum(bytes_billed) / F.lit(float(TERABYTE)) * F.lit(PRICE_PER_TERABYTE)
