"""Daily transaction jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from millrace.functions.numbers import exact_avg, money_sum
from millrace.operators.joins import broadcast_join
from millrace.operators.ordered import latest_per_key, total_order, transaction_features
from millrace.operators.validate import (
    RowRules, TRANSACTION_RULES, column_errors, dead_letters, enrich, valid_rows,
)


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row counter that fills in while the job itself runs; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def daily_transform(
    tx: DataFrame, customers: DataFrame, accounts: DataFrame,
    key: str = "transaction_id", ts: str = "created_timestamp",
) -> DataFrame:
    """Newest version of each transaction, customer features, both dimensions.

    Features read transaction columns only, so they come first and the wider joined rows are never
    shuffled. Dimensions must bring only columns of their own besides their key.
    """
    newest = latest_per_key(tx, [key], total_order(tx, F.desc(ts)))
    featured = transaction_features(newest, ts=ts, tie=key)
    return broadcast_join(broadcast_join(featured, customers, "customer_id"), accounts, "account_id")


def batch_ingest(
    tx: DataFrame, as_of: str, source: str, rules: RowRules = TRANSACTION_RULES, high_value: float = 1_000_000,
    key: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Validate, enrich and (with ``key``) keep one row per key; returns rows to load and dead letters."""
    checked = tx.withColumn("errors", column_errors(rules, tx.columns))
    record = F.to_json(F.struct(*tx.columns))
    refused = dead_letters(checked.withColumn("record", record), as_of, record="record")
    good = enrich(valid_rows(checked).drop("errors"), as_of, source, high_value=high_value)
    return (good if key is None else unique_rows(good, key)), refused


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """The largest row per key, column by column, so reruns agree; rows without a key stay apart."""
    with_key = latest_per_key(df.where(F.col(key).isNotNull()), [key], total_order(df))
    return with_key.unionByName(df.where(F.col(key).isNull()))


def alert_levels(alerts: DataFrame, day: str) -> DataFrame:
    """Alerts of a day by risk level."""
    return alerts.where(F.col("created_date") == F.lit(day).cast("date")).groupBy("risk_level").agg(
        F.count("*").alias("cnt"), exact_avg("fraud_score").alias("avg_score")
    )


def repeat_customers(alerts: DataFrame, customers: DataFrame, day: str, attribute: str, top: int = 10) -> DataFrame:
    """Customers with more than one alert on a day, worst score first."""
    per_customer = (
        alerts.where(F.col("created_date") == F.lit(day).cast("date"))
        .groupBy("customer_id")
        .agg(F.count("*").alias("alert_count"), F.max("fraud_score").alias("max_score"))
        .where("alert_count > 1")
    )
    return (
        per_customer.join(customers.select("customer_id", attribute), "customer_id")
        .orderBy(F.desc("max_score"), "customer_id")
        .limit(top)
    )


def top_customer_profile(
    tx: DataFrame, alerts: DataFrame, alert_day: str, tx_day: str, days: int = 7
) -> DataFrame:
    """Activity of the customer with the most alerts, over the days up to ``tx_day``."""
    top = (
        alerts.where(F.col("created_date") == F.lit(alert_day).cast("date"))
        .groupBy("customer_id").count()
        .orderBy(F.desc("count"), "customer_id").limit(1).select("customer_id")
    )
    end = F.lit(tx_day).cast("date")
    return (
        tx.where((F.col("customer_id") == top.scalar()) & (F.col("created_date") >= F.date_sub(end, days)))
        .groupBy("transaction_type", "channel")
        .agg(F.count("*").alias("cnt"), money_sum("amount").alias("total_amount"))
    )
