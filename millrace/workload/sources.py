"""Messages, scans, sinks and row validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import jsontext
from millrace.operators import validate
from millrace.plans import retail
from millrace.sources import catalog, sinks
from millrace.sources.tables import after_mark, day_partition, table
from millrace.workload import roles
from millrace.workload.registry import register
from millrace.workspace import scratch_path

# One raw message per order, in text both engines can build. Every sixteenth kind of order number
# carries a different fault; the rest are well formed.
RAW_MESSAGE = """
CASE o_orderkey % 16
 WHEN 1 THEN concat('{"transaction_id": "T', o_orderkey, '", "amount": ')
 WHEN 2 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "amount": 12.5, "transaction_type": "PAYMENT"}')
 WHEN 3 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": "12.5", "transaction_type": "PAYMENT"}')
 WHEN 4 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": -', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR(20)), ', "transaction_type": "PAYMENT"}')
 WHEN 5 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": 5, "transaction_type": "REFUND"}')
 WHEN 6 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": 5, "transaction_type": null}')
 WHEN 7 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": null, "amount": null, "transaction_type": "DEPOSIT"}')
 WHEN 8 THEN concat('{"transaction_id": "T', o_orderkey, '"} trailing')
 WHEN 9 THEN concat('{"transaction_id": ', o_orderkey, ', "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": true, "transaction_type": "DEPOSIT"}')
 WHEN 10 THEN concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A1", "customer_id": "C', o_custkey, '", "amount": 2000000, "transaction_type": "TRANSFER", "channel": "UPI"}')
 ELSE concat('{"transaction_id": "T', o_orderkey, '", "account_id": "A', o_custkey % 100, '", "customer_id": "C', o_custkey, '", "amount": ', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR(20)), ', "transaction_type": "WITHDRAWAL", "channel": "WEB", "status": "COMPLETED", "created_timestamp": "', substring(CAST(o_orderdate AS VARCHAR(30)), 1, 10), 'T08:30:00"}')
END"""

MESSAGES_SQL = f"""
WITH m AS (SELECT o_orderkey, {RAW_MESSAGE} AS raw FROM orders),
p AS (SELECT o_orderkey, raw, CASE WHEN json_valid(raw) THEN raw END AS j FROM m),
k AS (SELECT *, json_type(j, '$.transaction_id') AS k_id, json_type(j, '$.account_id') AS k_acc,
      json_type(j, '$.customer_id') AS k_cust, json_type(j, '$.amount') AS k_amt, json_type(j, '$.transaction_type') AS k_type,
      json_type(j, '$.channel') AS k_ch, json_type(j, '$.status') AS k_st, json_type(j, '$.created_timestamp') AS k_ts,
      json_extract_string(j, '$.amount') AS amt, json_extract_string(j, '$.transaction_type') AS typ FROM p),
e AS (SELECT *, CASE WHEN j IS NULL THEN ['Unparseable message'] ELSE list_filter([
  CASE WHEN coalesce(k_id, 'NULL') = 'NULL' THEN 'Missing required field: transaction_id' END,
  CASE WHEN coalesce(k_acc, 'NULL') = 'NULL' THEN 'Missing required field: account_id' END,
  CASE WHEN coalesce(k_cust, 'NULL') = 'NULL' THEN 'Missing required field: customer_id' END,
  CASE WHEN coalesce(k_amt, 'NULL') = 'NULL' THEN 'Missing required field: amount' END,
  CASE WHEN coalesce(k_type, 'NULL') = 'NULL' THEN 'Missing required field: transaction_type' END,
  CASE WHEN k_id NOT IN ('VARCHAR', 'NULL') THEN 'Type mismatch: transaction_id expected text' END,
  CASE WHEN k_acc NOT IN ('VARCHAR', 'NULL') THEN 'Type mismatch: account_id expected text' END,
  CASE WHEN k_cust NOT IN ('VARCHAR', 'NULL') THEN 'Type mismatch: customer_id expected text' END,
  CASE WHEN k_amt NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL') THEN 'Type mismatch: amount expected number' END,
  CASE WHEN k_type NOT IN ('VARCHAR', 'NULL') THEN 'Type mismatch: transaction_type expected text' END,
  CASE WHEN k_amt IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(amt AS DOUBLE) < 0 THEN concat('Invalid amount: ', amt, ' (must be >= 0)') END,
  CASE WHEN k_type IS NOT NULL AND (typ IS NULL OR typ NOT IN ('TRANSFER', 'PAYMENT', 'WITHDRAWAL', 'DEPOSIT', 'LOAN_DISBURSEMENT'))
       THEN concat('Invalid transaction_type: ', coalesce(typ, 'None')) END
  ], lambda x: x IS NOT NULL) END AS errors FROM k)
"""


def messages(spark, root):
    raw = F.expr(RAW_MESSAGE.replace("VARCHAR(20)", "STRING").replace("VARCHAR(30)", "STRING"))
    return roles.orders(spark, root).select("o_orderkey", raw.cast("binary").alias("raw"))


@register("P1 P2 P3 P4 S1 K2 F18", sql=MESSAGES_SQL + "SELECT o_orderkey, raw, errors FROM e")
def message_errors(spark, root):
    return validate.validated_messages(messages(spark, root)).select("o_orderkey", "raw", "errors")


@register("P5", sql=MESSAGES_SQL + f"SELECT raw AS record, errors, '{roles.EVENT_NOW}' AS timestamp FROM e WHERE len(errors) > 0")
def message_dead_letters(spark, root):
    return validate.dead_letters(validate.validated_messages(messages(spark, root)), roles.EVENT_NOW)


@register("P5 P6 P7 P8", sql=MESSAGES_SQL + f"""
SELECT o_orderkey, json_extract_string(j, '$.transaction_id') AS transaction_id, json_extract_string(j, '$.account_id') AS account_id,
  json_extract_string(j, '$.customer_id') AS customer_id, typ AS transaction_type, json_extract_string(j, '$.channel') AS channel,
  json_extract_string(j, '$.status') AS status, json_extract_string(j, '$.created_timestamp') AS created_timestamp,
  CAST(amt AS DOUBLE) AS amount, 0 AS extras, '{roles.EVENT_NOW}' AS _ingestion_ts, 'pubsub_streaming' AS _source,
  coalesce(substring(json_extract_string(j, '$.created_timestamp'), 1, 10), '{roles.EVENT_DAY}') AS created_date,
  CAST(amt AS DOUBLE) > 1000000 AS high_value_flag
FROM e WHERE len(errors) = 0""")
def enriched_messages(spark, root):
    valid = validate.valid_rows(validate.validated_messages(messages(spark, root)))
    loaded = validate.enrich(validate.message_columns(valid), roles.EVENT_NOW, "pubsub_streaming")
    return loaded.withColumn("extras", F.size("extra")).drop("extra")


@register("P5 X1", sql="""SELECT concat('T', o_orderkey) AS transaction_id, o_totalprice * 1.001::DOUBLE AS amount, concat('"', o_orderpriority, '"') AS priority,
concat('{"late":', CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END, ',"lines":[', o_custkey, ',7]}') AS detail FROM orders""")
def whole_records(spark, root):
    """Undeclared fields and amounts with more than two decimals survive the intake."""
    orders = roles.orders(spark, root)
    record = F.to_json(F.struct(
        F.concat(F.lit("T"), "o_orderkey").alias("transaction_id"), F.lit("A").alias("account_id"), F.lit("C").alias("customer_id"), F.lit("PAYMENT").alias("transaction_type"),
        (F.col("o_totalprice") * F.lit(1.001)).alias("amount"), F.col("o_orderpriority").alias("priority"),
        F.struct((F.col("o_orderstatus") == "F").alias("late"), F.array("o_custkey", F.lit(7)).alias("lines")).alias("detail"),
    ))
    valid = validate.valid_rows(validate.validated_messages(orders.select(record.alias("raw"))))
    return validate.message_columns(valid).select("transaction_id", "amount", F.col("extra")["priority"].alias("priority"), F.col("extra")["detail"].alias("detail"))


@register("P4", sql=f"""SELECT o_orderkey, CASE WHEN channel NOT IN ('MOBILE', 'WEB', 'ATM', 'BRANCH', 'UPI') THEN ['Invalid channel: ' || channel] ELSE [] END AS errors
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'ATM' ELSE upper(substring(o_orderpriority, 3)) END AS channel FROM orders)""")
def channel_domain(spark, root):
    """The channel list is declared but not enforced by default; here it is asked for."""
    rules = validate.RowRules(required=[], domains={"channel": validate.CHANNELS})
    rows = roles.orders(spark, root).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "ATM").otherwise(F.upper(F.substring("o_orderpriority", 3, 100))).alias("channel"),
    )
    return rows.select("o_orderkey", validate.column_errors(rules, rows.columns).alias("errors"))


@register("F18 S1", sql="SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props)")
def event_properties(spark, root):
    value = jsontext.strict_variant(F.col("props"))
    return roles.events(spark, root).select("event_id", F.try_variant_get(value, "$.k", "bigint").alias("k"))


@register("S2", sql="SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' AND l_quantity > 45")
def pruned_scan(spark, root):
    late = F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz")
    return roles.lineitem(spark, root).where(late & (F.col("l_quantity") > 45)).select("l_orderkey", "l_extendedprice")


def _dated_events(spark, root):
    return roles.events(spark, root).withColumn("date", F.to_date("ts"))


@register("S3 S6", sql=f"SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = DATE '{roles.EVENT_DAY}'")
def day_of_partitioned_table(spark, root):
    path = scratch_path(spark, "events-by-day")
    sinks.write_clustered(_dated_events(spark, root), path, "date", ["user_id", "event_type"])
    return day_partition(spark, path, roles.EVENT_DAY)


@register("S5 X8", sql="SELECT event_id, event_type FROM events")
def appended_in_two_loads(spark, root):
    """A first load, then only the rows past its high-water mark."""
    path = scratch_path(spark, "incremental")
    events = roles.events(spark, root)
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    sinks.append_rows(events.where(F.col("ts") < half), path)
    mark = spark.read.parquet(path).agg(F.max("ts")).first()[0]
    sinks.append_rows(after_mark(events, "ts", mark), path)
    return spark.read.parquet(path).select("event_id", "event_type")


@register("S7", sql=MESSAGES_SQL + f"SELECT raw AS record, errors, '{roles.EVENT_NOW}' AS timestamp FROM e WHERE len(errors) > 0")
def dead_letter_files(spark, root):
    path = scratch_path(spark, "dead-letters")
    refused = validate.dead_letters(validate.validated_messages(messages(spark, root)), roles.EVENT_NOW)
    sinks.write_dead_letters(refused, path)
    return spark.read.schema("record string, errors array<string>, timestamp string").json(path)


@register("A16 X9", sql="SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def refreshed_partitions(spark, root):
    """A summary table whose touched days are rewritten while the others stay."""
    path = scratch_path(spark, "summary")
    events = roles.events(spark, root).withColumn("day", F.to_date("ts"))
    recent = F.col("day") >= F.lit("2024-01-20").cast("date")

    def summary(rows):
        return rows.groupBy("day", "event_type").agg(F.count("*").alias("n")).repartition("day")

    sinks.replace_partitions(summary(events.where(~recent | (F.col("event_type") != "error"))), path, "day")
    sinks.replace_partitions(summary(events.where(recent)), path, "day")
    return spark.read.parquet(path).select("day", "event_type", "n")


@register("C1", sql="""SELECT column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'string' END AS type, 'YES' = is_nullable AS nullable, n.rows FROM (DESCRIBE lineitem)
  AS d(column_name, data_type, is_nullable, a, b, c), (SELECT count(*) AS rows FROM lineitem) n""")
def table_schema(spark, root):
    """Columns of a table next to its row count."""
    lines = roles.lineitem(spark, root)
    return catalog.schema_rows(lines).withColumn("rows", lines.agg(F.count("*")).scalar())


@register("C2 S4", sql="SELECT event_id, event_type FROM events")
def appended_to_existing_table(spark, root):
    """Appends land in a table that exists and never create one."""
    name = "appended_events_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    events = roles.events(spark, root).select("event_id", "event_type")
    try:
        sinks.append_to_table(events, name)
        raise AssertionError("an append created its table")
    except sinks.MissingTable:
        pass
    events.limit(0).write.option("path", scratch_path(spark, name)).saveAsTable(name)
    sinks.append_to_table(events, name)
    assert catalog.table_exists(spark, name)
    return spark.table(name)


@register("Q9", sql="SELECT 'events' AS part, CASE WHEN count(*) = 0 THEN 'skip_no_data' ELSE 'proceed' END AS action FROM events UNION ALL SELECT 'none', 'skip_no_data'")
def partition_size_gate(spark, root):
    """What the size of the files behind a scan decides, for a stored table and for a part without files."""
    events = table(spark, root, "events")
    none = scratch_path(spark, "no-files")
    events.limit(0).write.partitionBy("event_type").parquet(none)
    missing = spark.read.schema(events.schema).parquet(none)
    return catalog.size_gate(events).select(F.lit("events").alias("part"), "action").unionByName(catalog.size_gate(missing).select(F.lit("none").alias("part"), "action"))


# --- till events ---------------------------------------------------------------------------

TILL_RAW = """
SELECT CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE concat(CASE l_suppkey % 7 WHEN 0 THEN 'LON' WHEN 1 THEN 'SE' WHEN 2 THEN 'MID'
         WHEN 3 THEN 'NTH' WHEN 4 THEN 'SCO' WHEN 5 THEN 'WAL' ELSE 'X' END, l_suppkey) END AS store_id,
       CASE WHEN l_linenumber = 1 THEN concat('2', lpad(CAST(l_partkey % 1000000 AS VARCHAR(9)), 6, '0'), lpad(CAST(CAST(l_quantity AS INTEGER) * 100 AS VARCHAR(9)), 5, '0'), '7')
            WHEN l_linenumber = 2 THEN concat('2', l_partkey, 'x') ELSE concat('50', l_partkey, '00') END AS barcode,
       l_quantity AS quantity,
       CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_extendedprice * 100 AS BIGINT) % 10000 END AS sale_price_pence,
       l_orderkey AS till_id, strftime(l_shipdate, '%Y-%m-%dT10:00:00') AS timestamp,
       CASE WHEN l_returnflag = 'N' THEN concat('P', l_partkey % 9) WHEN l_returnflag = 'A' THEN '' END AS promotion_id,
       CASE WHEN l_linestatus = 'O' THEN 'MULTIBUY' END AS promotion_type, l_linenumber
FROM lineitem"""

TILL_SQL = f"""
WITH t AS ({TILL_RAW}),
e AS (SELECT *, list_filter([CASE WHEN store_id IS NULL THEN 'store_id' END, CASE WHEN sale_price_pence IS NULL THEN 'sale_price_pence' END],
      lambda x: x IS NOT NULL) AS missing FROM t)
"""


def till_events(spark, root, lines=None):
    """One till event per order line; ``lines`` may be a stream of them."""
    c = F.col
    letters = F.element_at(F.array(*[F.lit(p) for p in ("LON", "SE", "MID", "NTH", "SCO", "WAL", "X")]), (c("l_suppkey") % 7 + 1).cast("int"))
    grams = F.lpad((c("l_quantity").cast("int") * 100).cast("string"), 5, "0")
    weighed = F.concat(F.lit("2"), F.lpad((c("l_partkey") % 1000000).cast("string"), 6, "0"), grams, F.lit("7"))
    return (roles.lineitem(spark, root) if lines is None else lines).select(
        F.when(c("l_orderkey") % 17 != 0, F.concat(letters, c("l_suppkey"))).alias("store_id"),
        F.when(c("l_linenumber") == 1, weighed)
        .when(c("l_linenumber") == 2, F.concat(F.lit("2"), c("l_partkey"), F.lit("x")))
        .otherwise(F.concat(F.lit("50"), c("l_partkey"), F.lit("00"))).alias("barcode"),
        c("l_quantity").alias("quantity"),
        F.when(c("l_orderkey") % 19 != 0, F.round(c("l_extendedprice") * 100).cast("bigint") % 10000).alias("sale_price_pence"),
        c("l_orderkey").alias("till_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'10:00:00").alias("timestamp"),
        F.when(c("l_returnflag") == "N", F.concat(F.lit("P"), c("l_partkey") % 9)).when(c("l_returnflag") == "A", "").alias("promotion_id"),
        F.when(c("l_linestatus") == "O", "MULTIBUY").alias("promotion_type"),
        "l_linenumber",
    )


@register("R1 P9 P10 P11 P12 P13 F10", sql=TILL_SQL + """
SELECT store_id, barcode, quantity, sale_price_pence, till_id, timestamp, promotion_id, l_linenumber,
  CASE WHEN starts_with(barcode, '2') THEN 'WEIGHED' ELSE 'EAN13' END AS barcode_type,
  CASE WHEN starts_with(barcode, '2') THEN substring(barcode, 2, 6) END AS product_code,
  CASE WHEN starts_with(barcode, '2') THEN TRY_CAST(substring(barcode, 8, 5) AS INTEGER) END AS weight_grams,
  coalesce(promotion_id, '') <> '' AS is_promoted,
  CASE WHEN coalesce(promotion_id, '') <> '' THEN coalesce(promotion_type, 'UNKNOWN') ELSE promotion_type END AS promotion_type,
  sale_price_pence / 100.0 AS sale_price_gbp, substring(timestamp, 1, 10) AS sale_date,
  CASE substring(store_id, 1, 3) WHEN 'LON' THEN 'london' WHEN 'MID' THEN 'midlands' WHEN 'NTH' THEN 'north' WHEN 'SCO' THEN 'scotland'
       WHEN 'WAL' THEN 'wales' ELSE CASE substring(store_id, 1, 2) WHEN 'SE' THEN 'south_east' ELSE 'other' END END AS store_region
FROM e WHERE len(missing) = 0""")
def till_sales(spark, root):
    good, _ = retail.till_sales(till_events(spark, root), roles.EVENT_NOW)
    return good


@register("R1 P9", sql=TILL_SQL + f"""
SELECT till_id, l_linenumber, concat('missing_fields: ', list_aggregate(missing, 'string_agg', ', ')) AS reason, '{roles.EVENT_NOW}' AS timestamp
FROM e WHERE len(missing) > 0""")
def till_dead_letters(spark, root):
    _, refused = retail.till_sales(till_events(spark, root), roles.EVENT_NOW)
    return refused.select(
        F.get_json_object("record", "$.till_id").cast("bigint").alias("till_id"),
        F.get_json_object("record", "$.l_linenumber").cast("int").alias("l_linenumber"), "reason", "timestamp",
    )


# The same events as JSON messages: one in 23 is cut short, and each carries a field nobody declared.
def till_bytes(spark, root):
    events = till_events(spark, root)
    whole = F.to_json(F.struct(*[c for c in events.columns if c != "l_linenumber"], F.col("l_linenumber").alias("lane")))
    cut = F.when(F.col("till_id") % 23 == 0, F.left(whole, F.length(whole) - 1)).otherwise(whole)
    return events.select("till_id", "l_linenumber", cut.cast("binary").alias("raw")).withColumnRenamed("till_id", "sent_by")


@register("R1 X5 P9 P10 P12 S1", sql=TILL_SQL + """
SELECT till_id AS sent_by, l_linenumber, store_id, barcode, CAST(quantity AS DOUBLE) AS quantity, CAST(till_id AS VARCHAR) AS till_id, timestamp, sale_price_pence / 100.0 AS sale_price_gbp,
  coalesce(promotion_id, '') <> '' AS is_promoted, CAST(l_linenumber AS VARCHAR) AS lane FROM e WHERE len(missing) = 0 AND till_id % 23 <> 0""")
def till_sales_from_messages(spark, root):
    good, _ = retail.till_sales(retail.till_messages(till_bytes(spark, root)), roles.EVENT_NOW)
    return good.select("sent_by", "l_linenumber", "store_id", "barcode", "quantity", "till_id", "timestamp", "sale_price_gbp", "is_promoted", F.col("extra")["lane"].alias("lane"))


@register("R1 X5 P9 S7", sql=TILL_SQL + """
SELECT reason, count(*) AS messages FROM (SELECT CASE WHEN till_id % 23 = 0 THEN 'parse_error: not one JSON object' ELSE concat('missing_fields: ', list_aggregate(missing, 'string_agg', ', ')) END AS reason
FROM e WHERE len(missing) > 0 OR till_id % 23 = 0) GROUP BY 1""")
def till_messages_refused(spark, root):
    _, refused = retail.till_sales(retail.till_messages(till_bytes(spark, root)), roles.EVENT_NOW)
    return refused.groupBy("reason").agg(F.count("*").alias("messages"))
