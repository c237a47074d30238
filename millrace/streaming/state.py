"""Small tables that belong to a stream: rewritten every batch, readable after any crash."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class TurnTable:
    """A table that each batch replaces as a whole, kept in two folders that take turns.

    A batch writes into the folder that does not hold the newest finished state before it and marks
    it as finished last. A crash at any point leaves that earlier state whole, and a replayed batch
    starts from it again. The number of folders does not grow with the batches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _finished(self, turn: int) -> int | None:
        try:
            row = self.spark.read.schema("batch long").parquet(f"{self.path}/turn{turn}/finished").first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row["batch"] if row else None

    def newest(self, before: int | None = None) -> tuple[int, int] | None:
        """(batch, turn) of the newest finished state, of batches before ``before`` if given."""
        marks = [(batch, turn) for turn in (0, 1) if (batch := self._finished(turn)) is not None and (before is None or batch < before)]
        return max(marks, default=None)

    def read(self, before: int | None = None) -> DataFrame | None:
        state = self.newest(before)
        return None if state is None else self.spark.read.parquet(f"{self.path}/turn{state[1]}/rows")

    def write(self, df: DataFrame, batch: int) -> None:
        earlier = self.newest(batch)
        folder = f"{self.path}/turn{0 if earlier is None else 1 - earlier[1]}"
        df.write.mode("overwrite").parquet(f"{folder}/rows")
        self.spark.range(0, 1, 1, 1).select(F.lit(batch).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{folder}/finished")


def stored_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The rows of a table of files, or nothing when it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def put_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Put whole partitions in place of those stored; a large one is written by several tasks."""
    rows.hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def merge_partitions(
    spark: SparkSession, changes: DataFrame, path: str, keys: list[str], partition: str, batch: int, added: list[str] | None = None
) -> None:
    """Replace the groups named in ``changes`` in a table partitioned by ``partition``.

    Only touched partitions are read and rewritten. The merged partitions are staged first and then
    put in place by a dynamic partition overwrite, so a replay after a crash between the two puts
    the same rows in place again. ``changes`` holds at most one row per group. The columns named in
    ``added`` are added to those stored instead; they are then all that a group has besides its keys.
    """
    staged = TurnTable(spark, f"{path.rstrip('/')}__staged")
    done = staged.newest()
    if done is None or done[0] != batch:
        touched = [r[0] for r in changes.select(partition).distinct().collect()]  # partitions of one batch
        merged = changes
        stored = stored_rows(spark, path, changes.schema)
        if stored is not None and touched:
            known = [v for v in touched if v is not None]
            near = F.col(partition).isin(known) if None not in touched else F.col(partition).isNull() | F.col(partition).isin(known)
            if added:
                kinds = dict(changes.dtypes)
                both = stored.where(near).select(changes.columns).unionByName(changes)
                merged = both.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in added]).select(changes.columns)
            else:
                same = F.lit(True)
                for k in keys:
                    same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
                rest = stored.where(near).alias("s").join(changes.alias("c"), same, "left_anti")
                merged = rest.select(changes.columns).unionByName(changes)
        staged.write(merged, batch)
    put_partitions(staged.read(), path, partition)
