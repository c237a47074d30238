"""Joins that hold up when a side is larger or more skewed than expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int | None:
    """Size estimate of the optimised plan (file sizes for scans); null when it cannot be read."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = planned_bytes(df)
    return size is not None and size <= limit


def broadcast_join(
    large: DataFrame, small: DataFrame, on: str | list[str], how: str = "left", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Equi-join that broadcasts ``small`` only when its planned size is within ``limit``.

    Above the limit no hint is given: Spark shuffles both sides and splits skewed partitions.
    """
    return large.join(F.broadcast(small) if small_enough(small, limit) else small, on=on, how=how)


def hot_keys(df: DataFrame, keys: str | list[str], share: float = 0.01, min_rows: int = 0) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than ``1 / share`` of them.

    ``min_rows`` keeps keys out that are small in absolute terms.
    """
    names = [keys] if isinstance(keys, str) else keys
    counts = df.select(*names)
    for name in names:
        counts = counts.where(F.col(name).isNotNull())
    counts = counts.groupBy(*names).count()
    floor = counts.agg(F.greatest(F.sum("count") * F.lit(share), F.lit(min_rows)).alias("floor")).scalar()
    return counts.where(F.col("count") >= floor).select(*names)


def row_salt(columns: list[str], salt_range: int) -> Column:
    """A salt that a retried task computes again: row content plus the task's partition number.

    The partition number spreads exact copies of one row, which hash alike.
    """
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), F.lit(salt_range)).cast("int")


def salted_join(
    left: DataFrame, right: DataFrame, key: str, salt_range: int = 10, hot_share: float | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join that spreads every key over ``salt_range`` tasks, or only the hot ones.

    With ``hot_share`` given, a right side within ``limit`` bytes is sent to the left rows, which then
    stay where they are. Otherwise only keys holding that share of the left rows are salted and only
    their right rows repeated; they are found once, at most ``1 / hot_share`` of them, and sent to
    both sides.
    """
    salt = row_salt(left.columns, salt_range)
    salts = F.sequence(F.lit(0), F.lit(salt_range - 1))
    if hot_share is None:
        salted = left.withColumn("_salt", salt)
        spread = right.withColumn("_salt", F.explode(salts))
        return salted.join(spread, [key, "_salt"], "left").drop("_salt")
    if small_enough(right, limit):
        return left.join(F.broadcast(right), key, "left")
    hot = [r[0] for r in hot_keys(left, key, hot_share).collect()]  # at most 1 / hot_share values
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salted = left.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    spread = right.withColumn("_salt", F.explode(F.when(is_hot, salts).otherwise(F.array(F.lit(0)))))
    return salted.join(spread, [key, "_salt"], "left").drop("_salt")


def repeat_rows(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Every row ``times`` times, numbered from zero."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def known(df: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    return df.join(reference.select(on), on, "left_semi")


def unknown(df: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    return df.join(reference.select(on), on, "left_anti")


def reference_pairs(
    rows: DataFrame, pairs: DataFrame, entity: str, code: str, first: str, second: str
) -> DataFrame:
    """Entities that hold both codes of a reference pair.

    The pair list is put in ``least, greatest`` order and looked up from one side, so a row meets
    only the partners the reference names; pairs of one entity are never enumerated. Reference rows
    that differ in another column, such as the severity, are all kept.
    """
    ordered = pairs.where(F.col(first) != F.col(second)).withColumns(
        {"_a": F.least(first, second), "_b": F.greatest(first, second)}
    ).drop(first, second).distinct()
    held = rows.select(F.col(entity), F.col(code)).distinct()
    wanted = held.join(ordered, F.col(code) == F.col("_a")).drop(code)
    partner = held.select(F.col(entity).alias("_entity"), F.col(code).alias("_code"))
    met = wanted.join(partner, (F.col(entity) == F.col("_entity")) & (F.col("_b") == F.col("_code")))
    return met.drop("_entity", "_code").withColumnsRenamed({"_a": first, "_b": second})


def preaggregated_join(
    left: DataFrame, right: DataFrame, on: list[str], left_aggs: list[Column], right_aggs: list[Column]
) -> DataFrame:
    """Bring both sides to one row per key before a left join, so no key can multiply rows."""
    return left.groupBy(*on).agg(*left_aggs).join(right.groupBy(*on).agg(*right_aggs), on, "left")
