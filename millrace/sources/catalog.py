"""Table metadata as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def size_gate(df: DataFrame, minimum: int = 1000) -> DataFrame:
    """Bytes of the files behind a scan and what to do with them: skip, alert or proceed."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    total = F.coalesce(F.sum("file_size"), F.lit(0))
    return files.agg(total.alias("bytes"), F.count("*").alias("files")).withColumn(
        "action", F.when(F.col("bytes") == 0, "skip_no_data").when(F.col("bytes") < minimum, "alert_low_volume").otherwise("proceed")
    )


# The registered business tables, as (name, description, columns, example queries).
BUSINESS_TABLES = [
    (
        "analytics.fact_transactions",
        "All banking transactions including transfers, payments, withdrawals, and deposits",
        [
            ("transaction_id", "Unique transaction identifier"),
            ("account_id", "Source account ID (join key to dim_account)"),
            ("customer_id", "Customer ID (join key to dim_customer)"),
            ("transaction_type", "TRANSFER, PAYMENT, WITHDRAWAL, DEPOSIT, LOAN_DISBURSEMENT"),
            ("amount", "Transaction amount in INR"),
            ("currency", "Currency code (INR, USD, EUR)"),
            ("status", "COMPLETED, PENDING, FAILED, REVERSED"),
            ("channel", "MOBILE, WEB, ATM, BRANCH, UPI"),
            ("fraud_score", "ML-generated fraud probability (0.0 to 1.0)"),
            ("created_date", "Transaction date (partition key)"),
            ("created_timestamp", "Full timestamp with timezone"),
        ],
        [
            "SELECT customer_id, SUM(amount) as total FROM fact_transactions WHERE created_date >= DATE_SUB(CURRENT_DATE(), INTERVAL 30 DAY) GROUP BY 1",
            "SELECT transaction_type, COUNT(*) as cnt, AVG(amount) as avg_amt FROM fact_transactions WHERE created_date = CURRENT_DATE() GROUP BY 1",
        ],
    ),
    (
        "analytics.fact_fraud_alerts",
        "Fraud detection alerts generated by ML models and rule engines",
        [
            ("alert_id", "Unique alert identifier"),
            ("transaction_id", "Related transaction ID"),
            ("customer_id", "Flagged customer ID"),
            ("alert_type", "VELOCITY, AMOUNT_ANOMALY, GEO_ANOMALY, PATTERN_MATCH"),
            ("risk_level", "HIGH, MEDIUM, LOW"),
            ("fraud_score", "ML model confidence (0.0 to 1.0)"),
            ("status", "OPEN, INVESTIGATING, CONFIRMED_FRAUD, FALSE_POSITIVE"),
            ("created_date", "Alert date (partition key)"),
        ],
        ["SELECT risk_level, COUNT(*) FROM fact_fraud_alerts WHERE created_date = CURRENT_DATE() GROUP BY 1"],
    ),
    (
        "analytics.dim_customer",
        "Customer master data with KYC information and segmentation",
        [
            ("customer_id", "Unique customer identifier (join key)"),
            ("customer_name", "Full name (PII — column-level security applied)"),
            ("customer_segment", "RETAIL, HNI, CORPORATE, SME"),
            ("kyc_status", "VERIFIED, PENDING, EXPIRED, REJECTED"),
            ("risk_category", "LOW, MEDIUM, HIGH (AML risk rating)"),
            ("onboarding_date", "Account opening date"),
            ("region", "Geographic region"),
        ],
        [],
    ),
    (
        "analytics.dim_account",
        "Bank account details including type and status",
        [
            ("account_id", "Unique account identifier"),
            ("customer_id", "Owner customer ID"),
            ("account_type", "SAVINGS, CURRENT, LOAN, FIXED_DEPOSIT, DEMAT"),
            ("balance", "Current account balance in INR"),
            ("status", "ACTIVE, DORMANT, CLOSED, FROZEN"),
            ("branch_code", "Branch identifier"),
        ],
        [],
    ),
]

ENTRY_SCHEMA = (
    "table_name string, description string, columns array<struct<name:string,description:string>>, "
    "sample_queries array<string>"
)


def business_tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUSINESS_TABLES, ENTRY_SCHEMA)
