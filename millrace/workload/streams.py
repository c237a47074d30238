"""Streaming jobs, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import money
from millrace.functions.steps import computed_once
from millrace.functions.text import question_key
from millrace.plans import health, retail
from millrace.streaming import streams
from millrace.workload import roles
from millrace.workload.health import HL7_SQL, dispense_messages
from millrace.workload.logs import REUSE_SQL, question_log
from millrace.workload.registry import register
from millrace.workload.sources import MESSAGES_SQL, TILL_SQL, messages, till_events
from millrace.workspace import scratch_path

NOW = roles.EVENT_NOW


def _stored(spark, df, name):
    """Rows written as files for a stream to pick up."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path


def _stream(spark, df, name):
    return streams.file_stream(spark, _stored(spark, df, name), df.schema)


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _events_stream(spark, root):
    """A stream straight over the events table (a glob, since the source wants no single file)."""
    return streams.file_stream(spark, f"{root}/event[s].parquet", roles.events(spark, root).schema)


def _run_ingest(spark, root):
    sent = messages(spark, root).select("raw", F.col("o_orderkey").alias("n"))
    twice = sent.unionByName(sent.where("n % 5 = 0")).withColumn("position", F.concat_ws("/", "n", F.monotonically_increasing_id()))
    stream = _stream(spark, twice.select("raw", "position", F.lit("2024-01-30 12:00:00").cast("timestamp").alias("arrived")), "messages")
    good, refused = scratch_path(spark, "ingested"), scratch_path(spark, "refused")
    _finish(streams.ingest_stream(stream, good, refused, scratch_path(spark, "ingest-state"), NOW))
    return good, refused


def _summary(spark, totals, name, keys, period):
    """A summary table partitioned by the day or month of its windows, kept by a stream and read back."""
    path, dated = scratch_path(spark, name), totals.withColumn("_period", F.to_date(F.date_trunc(period, "window_start")))
    _finish(streams.summary_stream(dated, path, scratch_path(spark, f"{name}-state"), ["_period", *keys], "_period"))
    return spark.read.schema(dated.schema).parquet(path).drop("_period")


@register("X1 X2 S1", sql=MESSAGES_SQL + f"""
SELECT json_extract_string(j, '$.transaction_id') AS transaction_id, json_extract_string(j, '$.customer_id') AS customer_id, typ AS transaction_type, CAST(amt AS DOUBLE) AS amount,
  'pubsub_streaming' AS _source, coalesce(substring(json_extract_string(j, '$.created_timestamp'), 1, 10), '{roles.EVENT_DAY}') AS created_date, CAST(amt AS DOUBLE) > 1000000 AS high_value_flag
FROM e WHERE len(errors) = 0""")
def streamed_transactions(spark, root):
    good, _ = _run_ingest(spark, root)
    return spark.read.parquet(good).select(
        "transaction_id", "customer_id", "transaction_type", "amount", "_source", F.col("created_date").cast("string").alias("created_date"), "high_value_flag"
    )


@register("X1 S7", sql=MESSAGES_SQL + f""", t AS (SELECT raw AS record, errors FROM e WHERE len(errors) > 0 UNION ALL SELECT raw, errors FROM e WHERE len(errors) > 0 AND o_orderkey % 5 = 0)
SELECT record, errors, count(*) AS copies FROM t GROUP BY ALL""")
def streamed_dead_letters(spark, root):
    _, refused = _run_ingest(spark, root)
    rows = spark.read.schema("record string, errors array<string>, timestamp string").json(refused)
    return rows.groupBy("record", "errors").agg(F.count("*").alias("copies"))


@register("X2", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def streamed_distinct_lines(spark, root):
    lines = roles.lineitem(spark, root)
    stream = streams.file_stream(spark, f"{root}/lineite[m].parquet", lines.schema).withColumn("arrived", F.lit("2024-01-01").cast("timestamp"))
    unique = streams.deduplicated(stream, ["l_orderkey", "l_linenumber"], "arrived").select("l_orderkey", "l_linenumber")
    path = scratch_path(spark, "distinct-lines")
    _finish(streams.append_batches(unique, path, scratch_path(spark, "distinct-state")))
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber")


@register("X3", sql="""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS n,
CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2, 3""")
def five_minute_windows(spark, root):
    totals = streams.windowed(
        _events_stream(spark, root), "ts", ["event_type"], {"n": F.count("*"), "total": F.sum(money("value")).cast("double")}
    )
    return _summary(spark, totals, "windows", ["window_start", "event_type"], "day")


def _late(spark, root):
    events = roles.events(spark, root)
    source = scratch_path(spark, "arrivals")
    places = [scratch_path(spark, n) for n in ("on-time", "late", "marks", "late-state")]
    for load in (events.where("event_id % 50 <> 0"), events.where("event_id % 50 = 0")):
        load.write.mode("append").parquet(source)
        _finish(streams.split_late(streams.file_stream(spark, source, events.schema), "ts", *places))
    return places


@register("X4", sql="""SELECT event_id, ts FROM events WHERE event_id % 50 = 0 AND ts < (SELECT max(ts) FROM events WHERE event_id % 50 <> 0) - INTERVAL 1 HOUR""")
def late_rows(spark, root):
    return spark.read.parquet(_late(spark, root)[1]).select("event_id", "ts")


@register("X5 X6", sql=TILL_SQL + """SELECT CASE substring(store_id, 1, 3) WHEN 'LON' THEN 'london' WHEN 'MID' THEN 'midlands' WHEN 'NTH' THEN 'north' WHEN 'SCO' THEN 'scotland'
WHEN 'WAL' THEN 'wales' ELSE CASE substring(store_id, 1, 2) WHEN 'SE' THEN 'south_east' ELSE 'other' END END AS store_region, barcode, timestamp, sale_price_pence / 100.0 AS sale_price_gbp FROM e WHERE len(missing) = 0""")
def streamed_till_sales(spark, root):
    good, refused = scratch_path(spark, "till"), scratch_path(spark, "till-refused")
    events = till_events(spark, root)
    stream = _stream(spark, events.select(F.to_json(F.struct(*events.columns)).cast("binary").alias("raw")), "till-messages")
    _finish(streams.route_batches(
        stream, lambda b: retail.till_sales(b, NOW), good, refused, scratch_path(spark, "till-state"), "store_region",
        judge=retail.judged_till_messages))
    return spark.read.parquet(good).select("store_region", "barcode", "timestamp", "sale_price_gbp")


@register("X6", sql=TILL_SQL + """SELECT store_id, product_code, window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS items, CAST(sum(quantity) AS DOUBLE) AS units FROM (
SELECT store_id, CASE WHEN starts_with(barcode, '2') THEN substring(barcode, 2, 6) ELSE barcode END AS product_code, time_bucket(INTERVAL 5 MINUTE, CAST(timestamp AS TIMESTAMP)) AS window_start, quantity FROM e WHERE len(missing) = 0) GROUP BY ALL""")
def sales_velocity(spark, root):
    """Almost every sale has a window of its own, so the running sums are the summary table, not state."""
    lines = streams.file_stream(spark, f"{root}/lineite[m].parquet", roles.lineitem(spark, root).schema)
    events = till_events(spark, root, lines)
    events = computed_once(events, {c: F.col(c) for c in ("store_id", "barcode", "sale_price_pence", "timestamp")})
    sold, _ = retail.till_sales(events, NOW)
    keyed = sold.select("store_id", F.coalesce("product_code", "barcode").alias("product_code"), F.col("timestamp").cast("timestamp").alias("sold_at"), "quantity")
    path = scratch_path(spark, "velocity")
    _finish(streams.summed_windows(
        keyed, "sold_at", ["store_id", "product_code"], {"items": F.count("*"), "units": F.sum("quantity")}, path,
        scratch_path(spark, "velocity-state"), "_period", "month"))
    return spark.read.parquet(path).drop("_period")


@register("X7", sql=HL7_SQL + "SELECT * EXCLUDE (raw) FROM hg WHERE patient_hash IS NOT NULL UNION ALL SELECT * FROM fg")
def streamed_dispenses(spark, root):
    good, refused = scratch_path(spark, "dispenses"), scratch_path(spark, "dispenses-refused")
    stream = _stream(spark, dispense_messages(spark, root), "dispense-messages")
    _finish(streams.route_batches(
        stream, health.route_dispenses, good, refused, scratch_path(spark, "dispense-state"), judge=health.judged_dispenses))
    return spark.read.parquet(good).drop("batch")


@register("X8", sql="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def resumed_stream(spark, root):
    """Two runs of one checkpointed query; the second sees only what arrived in between."""
    on_time, late, _, _ = _late(spark, root)
    both = spark.read.parquet(on_time).unionByName(spark.read.parquet(late))
    return both.groupBy("event_type").agg(F.count("*").alias("n"))


@register("X8", sql="""WITH m AS (SELECT max(ts) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-16')
SELECT event_type, CAST(CASE WHEN ts <= mark THEN 0 ELSE 1 END AS INTEGER) AS load, count(*) AS n FROM events, m GROUP BY ALL""")
def incremental_loads(spark, root):
    """Two loads above a stored mark, the second after the source has grown."""
    events, path, marks = roles.events(spark, root), scratch_path(spark, "loaded"), scratch_path(spark, "load-marks")
    for there in (events.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"), events):
        streams.load_new(there, "ts", path, marks)
    return spark.read.parquet(path).groupBy("event_type", F.col("batch").cast("int").alias("load")).agg(F.count("*").alias("n"))


@register("X9 A16", sql="SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS transactions, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM events GROUP BY 1, 2")
def refreshed_summary(spark, root):
    """Daily totals kept current by a stream that is fed in two loads."""
    events = roles.events(spark, root)
    source, path, state = (scratch_path(spark, n) for n in ("summary-source", "summary-stream", "summary-state"))
    for load in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")):
        load.write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, events.schema).withColumn("day", F.to_date("ts"))
        totals = stream.groupBy("day", "event_type").agg(
            F.count("*").alias("transactions"), F.sum(money("value")).cast("double").alias("total_revenue")
        )
        _finish(streams.summary_stream(totals, path, state, ["day", "event_type"], "day"))
    return spark.read.schema(totals.schema).parquet(path)


@register("S4", sql="SELECT event_id, event_type FROM events")
def streamed_into_existing_table(spark, root):
    events = roles.events(spark, root).select("event_id", "event_type")
    name = "streamed_events_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    events.limit(0).write.option("path", scratch_path(spark, name)).saveAsTable(name)
    stream = _events_stream(spark, root).select("event_id", "event_type")
    _finish(streams.append_stream(stream, name, scratch_path(spark, "append-state")))
    return spark.table(name)


@register("L4 X2", sql=REUSE_SQL + "SELECT event_id AS row_id, key, hit FROM h")
def streamed_reuse(spark, root):
    log = question_log(spark, root).withColumn("key", question_key(F.col("question")))
    stream = _stream(spark, log, "questions")
    path = scratch_path(spark, "reuse")
    labels = streams.reuse_stream(stream, "ts", "event_id", 7200)
    _finish(streams.write_batches(labels, scratch_path(spark, "reuse-state"), lambda b, n: b.write.mode("overwrite").parquet(streams.batch_folder(path, n))))
    return spark.read.parquet(path).select("row_id", "key", "hit")
