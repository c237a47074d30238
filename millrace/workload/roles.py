"""The driver tables in their business roles, once for Spark and once as SQL for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.tables import table

DAY = "1998-07-21"            # "today" for transactions
EVENT_DAY = "2024-01-30"      # "today" for the event tables
EVENT_NOW = "2024-01-30 23:59:59"

TRANSACTIONS = """
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS amount,
       o_orderdate AS created_timestamp, CAST(o_orderdate AS DATE) AS created_date,
       CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'PENDING' ELSE 'COMPLETED' END AS status,
       CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'PAYMENT'
            WHEN '3' THEN 'WITHDRAWAL' WHEN '4' THEN 'DEPOSIT' ELSE 'LOAN_DISBURSEMENT' END AS transaction_type,
       o_orderpriority AS channel
FROM orders"""

ALERTS = """
SELECT event_id AS alert_id, user_id AS customer_id, value / 128 AS fraud_score,
       CASE WHEN value >= 100 THEN 'HIGH' WHEN value >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       ts AS created_timestamp, CAST(ts AS DATE) AS created_date
FROM events WHERE event_type = 'error'"""

FILLS = """
SELECT o_custkey AS patient, p_type AS molecule, l_partkey AS drug, l_suppkey AS pharmacy,
       CAST(l_shipdate AS DATE) AS fill_date, CAST(l_quantity AS INTEGER) AS days_supply
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""


def _mapped(column, pairs: dict, default: str):
    out = None
    for value, name in pairs.items():
        out = F.when(column == value, name) if out is None else out.when(column == value, name)
    return out.otherwise(default)


def transactions(spark: SparkSession, root: str) -> DataFrame:
    kinds = {"1": "TRANSFER", "2": "PAYMENT", "3": "WITHDRAWAL", "4": "DEPOSIT"}
    return table(spark, root, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("created_timestamp"),
        F.to_date("o_orderdate").alias("created_date"),
        _mapped(F.col("o_orderstatus"), {"F": "FAILED", "P": "PENDING"}, "COMPLETED").alias("status"),
        _mapped(F.substring("o_orderpriority", 1, 1), kinds, "LOAN_DISBURSEMENT").alias("transaction_type"),
        F.col("o_orderpriority").alias("channel"),
    )


def alerts(spark: SparkSession, root: str) -> DataFrame:
    level = F.when(F.col("value") >= 100, "HIGH").when(F.col("value") >= 30, "MEDIUM").otherwise("LOW")
    return table(spark, root, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("alert_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("value") / 128).alias("fraud_score"),  # seven more binary places, so scores have many decimals
        level.alias("risk_level"),
        F.col("ts").alias("created_timestamp"),
        F.to_date("ts").alias("created_date"),
    )


def customers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_nationkey").alias("account_id"),
    )


def accounts(spark: SparkSession, root: str) -> DataFrame:
    """Nations stand in for accounts: a small dimension reached through the customer."""
    return table(spark, root, "nation").select(
        F.col("n_nationkey").alias("account_id"),
        F.col("n_name").alias("branch_code"),
        F.col("n_regionkey").alias("region_id"),
    )


def fills(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem")
    orders = table(spark, root, "orders")
    parts = table(spark, root, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("patient"),
            F.col("p_type").alias("molecule"),
            F.col("l_partkey").alias("drug"),
            F.col("l_suppkey").alias("pharmacy"),
            F.to_date("l_shipdate").alias("fill_date"),
            F.col("l_quantity").cast("int").alias("days_supply"),
        )
    )


def read(name: str):
    def load(spark: SparkSession, root: str) -> DataFrame:
        return table(spark, root, name)

    return load


orders, lineitem, customer, nation, region, supplier, part, events, documents, embeddings, benchmark, conversations, labels = (
    read(n) for n in (
        "orders", "lineitem", "customer", "nation", "region", "supplier", "part", "events", "documents",
        "embeddings", "benchmark", "conversations", "labels",
    )
)
