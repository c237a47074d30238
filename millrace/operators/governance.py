"""Lineage, audit, access policies and cost reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.text import pseudonym
from millrace.operators.aggregates import GIGABYTE, TERABYTE, PRICE_PER_TERABYTE, scan_cost
from millrace.workspace import cut_lineage

LINEAGE_SCHEMA = (
    "source_table string, target_table string, pipeline_name string, transformation string, "
    "row_count bigint, executed_at string, executed_by string"
)


def lineage_row(
    spark: SparkSession, source: str, target: str, pipeline: str, transformation: str, row_count: int, as_of: str
) -> DataFrame:
    """One run of one step; ``row_count`` normally comes from an observation."""
    row = (source, target, pipeline, transformation, row_count, as_of, pipeline)
    return spark.createDataFrame([row], LINEAGE_SCHEMA)


def ai_query_audit(log: DataFrame, user: str, question: str, sql: str, tables: str, ts: str) -> DataFrame:
    """Audit rows of generated queries; ``tables`` is an array column, SQL is cut at 200 characters."""
    details = F.concat(F.lit("Question: "), F.col(question), F.lit(" | SQL: "), F.left(F.col(sql), F.lit(200)))
    return log.select(
        F.col(user).alias("user"), F.lit("ai_query").alias("action"), F.array_join(tables, ", ").alias("resource"),
        details.alias("details"), F.col(ts).alias("timestamp"),
    )


def data_access_audit(log: DataFrame, user: str, table: str, query: str, ts: str) -> DataFrame:
    return log.select(
        F.col(user).alias("user"), F.lit("data_access").alias("action"), F.col(table).alias("resource"),
        F.left(F.col(query), F.lit(500)).alias("details"), F.col(ts).alias("timestamp"),
    )


EVERYTHING = None


def apply_row_policies(df: DataFrame, column: str, policies: dict[str, list | None], groups: Iterable[str]) -> DataFrame:
    """Rows a member of ``groups`` may see.

    A policy lists the values of ``column`` open to a group; ``EVERYTHING`` opens all rows. With no
    matching policy nothing is visible.
    """
    allowed: set = set()
    for group in groups:
        if group in policies:
            values = policies[group]
            if values is EVERYTHING:
                return df
            allowed.update(values)
    return df.where(F.col(column).isin(sorted(allowed))) if allowed else df.where(F.lit(False))


def masked_columns(df: DataFrame, masks: dict[str, Column], is_steward: Column) -> DataFrame:
    """Protected columns as they are for stewards, masked for everyone else."""
    return df.withColumns({c: F.when(is_steward, F.col(c)).otherwise(mask) for c, mask in masks.items()})


def member(users: list[str], user: Column | None = None) -> Column:
    return (F.current_user() if user is None else user).isin(users)


def full_mask() -> Column:
    return F.lit("MASKED")


def prefix_mask(column: str, keep: int = 3) -> Column:
    return F.concat(F.left(F.col(column), F.lit(keep)), F.lit(" ***"))


def pseudonymised(df: DataFrame, column: str, salt: str) -> DataFrame:
    return df.withColumn(column, pseudonym(F.col(column), salt))


def lineage_reach(
    edges: DataFrame, roots: DataFrame, source: str = "source", target: str = "target"
) -> DataFrame:
    """Everything reachable from each root with its smallest depth: ``(root, node, depth)``.

    Links are doubled: round k joins the links of up to 2^k steps with themselves and appends them to
    what each root reaches, so a chain of n steps takes about log2(n) rounds. Only the shortest link
    of two nodes is kept, so cycles end. A round in which no root gains a node or a shorter way is
    the last. Links from or to null are left out, and a root is not its own successor.
    """
    ends = F.col("_from").isNotNull() & F.col("_to").isNotNull() & (F.col("_from") != F.col("_to"))
    links = edges.select(F.col(source).alias("_from"), F.col(target).alias("_to")).where(ends).distinct().withColumn("_steps", F.lit(1))
    links = cut_lineage(links)
    first = roots.select(F.col(roots.columns[0]).alias("root")).where(F.col("root").isNotNull()).distinct()
    reached, known = first.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")), None
    while True:
        onward = reached.join(links, F.col("node") == F.col("_from")).select("root", F.col("_to").alias("node"), (F.col("depth") + F.col("_steps")).alias("depth"))
        reached = cut_lineage(reached.unionByName(onward).groupBy("root", "node").agg(F.min("depth").alias("depth")))
        now = reached.agg(F.count("*").alias("n"), F.sum("depth").alias("steps")).first()
        if now == known:
            return reached.where(F.col("node") != F.col("root"))
        known = now
        second = links.select(F.col("_from").alias("_mid"), F.col("_to").alias("_end"), F.col("_steps").alias("_more"))
        longer = links.join(second, F.col("_to") == F.col("_mid")).select("_from", F.col("_end").alias("_to"), (F.col("_steps") + F.col("_more")).alias("_steps"))
        links = cut_lineage(links.unionByName(longer.where(F.col("_from") != F.col("_to"))).groupBy("_from", "_to").agg(F.min("_steps").alias("_steps")))


# --- cost ---------------------------------------------------------------------------------


def finished_queries(jobs: DataFrame) -> DataFrame:
    return jobs.where((F.col("job_type") == "QUERY") & (F.col("state") == "DONE"))


def total_scan_cost(jobs: DataFrame) -> DataFrame:
    done = finished_queries(jobs)
    return done.agg(
        (F.sum("total_bytes_billed") / F.lit(float(TERABYTE))).alias("tb_billed"),
        scan_cost(F.col("total_bytes_billed")).alias("estimated_cost_usd"),
    )


def daily_budget(jobs: DataFrame, budget: float = 50.0, warn_share: float = 0.8) -> DataFrame:
    """Scan cost per day against the budget."""
    cost = F.col("cost_usd")
    return (
        finished_queries(jobs).groupBy(F.to_date("creation_time").alias("day"))
        .agg(scan_cost(F.col("total_bytes_billed")).alias("cost_usd"))
        .withColumn("status", F.when(cost > budget, "ALERT").when(cost > budget * warn_share, "WARNING").otherwise("OK"))
    )


def costliest_queries(jobs: DataFrame, as_of: str, top: int = 10) -> DataFrame:
    """Largest scans of the last day."""
    end = F.lit(as_of).cast("timestamp_ntz")
    start = end - F.expr("INTERVAL 1 DAY")
    return (
        jobs.where((F.col("creation_time") >= start) & (F.col("creation_time") <= end))
        .orderBy(F.desc("total_bytes_billed"), "job_id").limit(top)
        .select("job_id", "user_email", "query", (F.col("total_bytes_billed") / F.lit(float(GIGABYTE))).alias("gb_billed"))
    )


def over_quota(jobs: DataFrame, quota_bytes: int) -> DataFrame:
    """Users whose scanned bytes of a day exceed the quota."""
    return jobs.groupBy("user_email", F.to_date("creation_time").alias("day")).agg(
        F.sum("total_bytes_billed").alias("bytes_billed")
    ).where(F.col("bytes_billed") > quota_bytes)
