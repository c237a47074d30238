"""Writing tables, dead letters and audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


class MissingTable(RuntimeError):
    """The target of an append does not exist, and appends never create one."""


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_to_table(df: DataFrame, name: str) -> None:
    if not df.sparkSession.catalog.tableExists(name):
        raise MissingTable(name)
    df.write.mode("append").insertInto(name)


def write_clustered(
    df: DataFrame, path: str, partition: str, cluster: list[str], files_per_day: int = 1, mode: str = "append"
) -> None:
    """Partitioned write with rows sorted by the cluster columns inside every file.

    ``files_per_day`` spreads one large day over several tasks by a hash of the cluster columns.
    """
    keys = [F.col(partition)]
    if files_per_day > 1:
        keys.append(F.pmod(F.xxhash64(*cluster), F.lit(files_per_day)))
    (
        df.repartition(*keys)
        .sortWithinPartitions(partition, *cluster)
        .write.mode(mode)
        .partitionBy(partition)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Rewrite only the partitions present in ``df``; the rest of the table stays."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_dead_letters(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def audit_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A handful of run records as a table in its fixed schema."""
    return spark.createDataFrame(rows, schema)
