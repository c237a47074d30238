"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from millrace.functions.numbers import money, money_avg, money_sum, percent
from millrace.operators import joins, ordered
from millrace.operators.aggregates import key_profile, skew_ratio, summary_by_day, top_share
from millrace.plans import daily
from millrace.sources.tables import guarded_scan, look_back
from millrace.workload import roles
from millrace.workload.registry import register

TX = f"WITH tx AS ({roles.TRANSACTIONS})"
AL = f"WITH al AS ({roles.ALERTS})"
MSUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
MAVG = "(CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0}))"


def msum(c: str) -> str:
    return MSUM.format(c)


def mavg(c: str) -> str:
    return MAVG.format(c)


def score_avg(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28,10))) AS DOUBLE) / count({c})"


FEATURES = f"""
       CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id ORDER BY created_timestamp) AS DOUBLE) AS running_total,
       row_number() OVER (PARTITION BY customer_id ORDER BY created_timestamp DESC, transaction_id DESC) AS txn_rank,
       count(*) OVER (PARTITION BY customer_id, created_date) AS daily_txn_count,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id, created_date) AS DOUBLE) AS daily_total_amount"""


# --- composite jobs -----------------------------------------------------------------------


@register("B1 J3 P17", sql=f"""{TX}
SELECT tx.*, c_name AS customer_name, c_mktsegment AS customer_segment, c_nationkey AS account_id,
       n_name AS branch_code, n_regionkey AS region_id, {FEATURES}
FROM tx LEFT JOIN customer ON c_custkey = customer_id LEFT JOIN nation ON n_nationkey = c_nationkey""")
def daily_transform(spark, root):
    return daily.daily_transform(
        roles.transactions(spark, root), roles.customers(spark, root), roles.accounts(spark, root)
    )


@register("B2 U1", sql=f"""{TX}
SELECT transaction_id, customer_id, amount, transaction_type, '{roles.EVENT_NOW}' AS _ingestion_ts,
       'batch' AS _source, strftime(created_date, '%Y-%m-%d') AS created_date, amount > 450000 AS high_value_flag
FROM tx WHERE amount >= 0""")
def batch_ingest(spark, root):
    from millrace.operators.validate import RowRules, TRANSACTION_RULES

    rules = RowRules(
        required=["transaction_id", "customer_id", "amount", "transaction_type"],
        non_negative=["amount"], domains=TRANSACTION_RULES.domains,
    )
    loaded, _ = daily.batch_ingest(
        roles.transactions(spark, root), roles.EVENT_NOW, "batch", rules, high_value=450_000, key="transaction_id"
    )
    return loaded.select(
        "transaction_id", "customer_id", "amount", "transaction_type", "_ingestion_ts", "_source", "created_date",
        "high_value_flag",
    )


# --- joins --------------------------------------------------------------------------------


@register("J1", sql=f"""{TX}
SELECT tx.transaction_id, tx.customer_id, c_name AS customer_name, c_mktsegment AS customer_segment
FROM tx LEFT JOIN customer ON c_custkey = customer_id""")
def size_checked_join(spark, root):
    dims = roles.customers(spark, root).drop("account_id")
    return joins.broadcast_join(roles.transactions(spark, root).select("transaction_id", "customer_id"), dims, "customer_id")


SALTED_SQL = """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS s_suppkey, l_orderkey, l_linenumber,
       l_partkey, l_quantity, s_name, s_nationkey
FROM lineitem LEFT JOIN supplier ON s_suppkey = CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END"""


def _hot_lines(spark, root):
    """Line items with a third of the rows moved to one supplier."""
    return roles.lineitem(spark, root).select(
        F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey")).alias("s_suppkey"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
    )


@register("J2 J10 F16", sql=SALTED_SQL)
def salted_supplier_join(spark, root):
    return joins.salted_join(
        _hot_lines(spark, root), roles.supplier(spark, root).select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey"
    )


@register("J2 A20", sql=SALTED_SQL)
def hot_key_salted_join(spark, root):
    return joins.salted_join(
        _hot_lines(spark, root), roles.supplier(spark, root).select("s_suppkey", "s_name", "s_nationkey"),
        "s_suppkey", hot_share=0.05, limit=0,  # as if the suppliers were too many to send
    )


@register("J10", sql="SELECT s_suppkey, CAST(copy AS INTEGER) AS copy FROM supplier CROSS JOIN range(0, 4) AS r(copy)")
def repeated_rows(spark, root):
    return joins.repeat_rows(roles.supplier(spark, root).select("s_suppkey"), 4)


@register("J4", sql="""SELECT l_orderkey, l_linenumber, l_partkey, p_type, p_brand
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 20""")
def projected_lookup_join(spark, root):
    parts = roles.part(spark, root).where("p_size > 20").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return joins.broadcast_join(
        roles.lineitem(spark, root).select("l_orderkey", "l_linenumber", "l_partkey"), parts, "l_partkey", "inner"
    )


@register("J13", sql="""SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000)""")
def customers_without_large_failures(spark, root):
    failed = roles.orders(spark, root).where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return joins.unknown(
        roles.customer(spark, root).select("c_custkey", "c_name"), failed.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"
    )


@register("J13", sql="""SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000)""")
def customers_with_large_failures(spark, root):
    failed = roles.orders(spark, root).where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return joins.known(
        roles.customer(spark, root).select("c_custkey", "c_name"), failed.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"
    )


@register("J7 A12 A13 A14", sql=f"""
WITH spend AS (
  SELECT user_id, CAST(ts AS DATE) AS day, {msum('value')} AS spend, count(*) AS items,
         list_sort(list(DISTINCT json_extract_string(props, '$.k')[1:1])) AS categories
  FROM events WHERE event_type = 'purchase' GROUP BY ALL),
points AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
         count(DISTINCT CASE WHEN event_type <> 'view' THEN event_type END) AS kinds
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL)
SELECT * FROM spend LEFT JOIN points USING (user_id, day)""")
def preaggregated_event_join(spark, root):
    events = roles.events(spark, root).withColumn("day", F.to_date("ts"))
    category = F.substring(F.get_json_object("props", "$.k"), 1, 1)
    return joins.preaggregated_join(
        events.where("event_type = 'purchase'"), events.where("event_type <> 'purchase'"), ["user_id", "day"],
        [money_sum("value").alias("spend"), F.count("*").alias("items"),
         F.sort_array(F.collect_set(category)).alias("categories")],
        [F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("clicks"),
         F.count_distinct(F.when(F.col("event_type") != "view", F.col("event_type"))).alias("kinds")],
    )


@register("J8", sql="""
WITH claims AS (SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS returned
                FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_quantity, returned
FROM lineitem l LEFT JOIN claims c ON l.l_orderkey = c.l_orderkey AND l.l_suppkey = c.l_suppkey""")
def composite_key_join(spark, root):
    lines = roles.lineitem(spark, root)
    claims = lines.where("l_returnflag = 'R'").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("returned"))
    return lines.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity").join(claims, ["l_orderkey", "l_suppkey"], "left")


@register("J9 A19", sql=f"""{TX}, daily AS (SELECT created_date, count(*) AS cnt FROM tx GROUP BY 1)
SELECT created_date, cnt, cnt - CAST(s.total AS BIGINT) / s.days AS from_mean
FROM daily, (SELECT sum(cnt) AS total, count(*) AS days FROM daily) s""")
def days_against_overall_mean(spark, root):
    days = roles.transactions(spark, root).groupBy("created_date").agg(F.count("*").alias("cnt"))
    everything = Window.partitionBy()  # one row per calendar day
    mean = F.sum("cnt").over(everything).cast("double") / F.count("*").over(everything)
    return days.select("created_date", "cnt", (F.col("cnt") - mean).alias("from_mean"))


@register("J11", sql=f"""{AL} SELECT c_mktsegment AS customer_segment, risk_level, count(*) AS cnt,
CAST(sum(CAST(fraud_score AS DECIMAL(28,10))) AS DOUBLE) AS score FROM al JOIN customer ON customer_id = c_custkey GROUP BY ALL""")
def alerts_by_segment(spark, root):
    dims = roles.customers(spark, root).select("customer_id", "customer_segment")
    return (
        joins.broadcast_join(roles.alerts(spark, root), dims, "customer_id", "inner")
        .groupBy("customer_segment", "risk_level")
        .agg(F.count("*").alias("cnt"), F.sum(F.col("fraud_score").cast("decimal(28,10)")).cast("double").alias("score"))
    )


@register("J12 A10", sql=f"""{TX}, al AS ({roles.ALERTS})
SELECT transaction_type, channel, count(*) AS cnt, {msum('amount')} AS total_amount FROM tx
WHERE customer_id = (SELECT customer_id FROM al WHERE created_date = DATE '{roles.EVENT_DAY}'
                     GROUP BY 1 ORDER BY count(*) DESC, customer_id LIMIT 1)
  AND created_date >= DATE '{roles.DAY}' - INTERVAL 7 DAY GROUP BY ALL""")
def top_customer_profile(spark, root):
    return daily.top_customer_profile(
        roles.transactions(spark, root), roles.alerts(spark, root), roles.EVENT_DAY, roles.DAY
    )


@register("B3", sql=f"""{TX}, al AS (SELECT * FROM ({roles.ALERTS}) WHERE created_date = DATE '{roles.EVENT_DAY}'),
repeat AS (SELECT customer_id, c_mktsegment AS segment, count(*) AS n, max(fraud_score) AS m FROM al
           JOIN customer ON c_custkey = customer_id GROUP BY ALL HAVING count(*) > 1 ORDER BY m DESC, customer_id LIMIT 10)
SELECT 'alerts by level' AS section, risk_level AS item, count(*) AS cnt, {score_avg('fraud_score')} AS measure FROM al GROUP BY 2
UNION ALL SELECT 'repeat customers', concat(customer_id, ' ', segment), n, m FROM repeat
UNION ALL SELECT 'top customer activity', concat(transaction_type, ' ', channel), count(*), {msum('amount')} FROM tx
WHERE customer_id = (SELECT customer_id FROM al GROUP BY 1 ORDER BY count(*) DESC, customer_id LIMIT 1)
  AND created_date >= DATE '{roles.DAY}' - INTERVAL 7 DAY GROUP BY 2""")
def fraud_overview(spark, root):
    tx, al, dims = roles.transactions(spark, root), roles.alerts(spark, root), roles.customers(spark, root)
    levels = daily.alert_levels(al, roles.EVENT_DAY).select(
        F.lit("alerts by level").alias("section"), F.col("risk_level").alias("item"), "cnt", F.col("avg_score").alias("measure")
    )
    repeat = daily.repeat_customers(al, dims, roles.EVENT_DAY, "customer_segment").select(
        F.lit("repeat customers").alias("section"), F.concat_ws(" ", "customer_id", "customer_segment").alias("item"),
        F.col("alert_count").alias("cnt"), F.col("max_score").alias("measure"),
    )
    profile = daily.top_customer_profile(tx, al, roles.EVENT_DAY, roles.DAY).select(
        F.lit("top customer activity").alias("section"), F.concat_ws(" ", "transaction_type", "channel").alias("item"),
        "cnt", F.col("total_amount").alias("measure"),
    )
    return levels.unionByName(repeat).unionByName(profile)


# --- aggregates ---------------------------------------------------------------------------


def _on(day: str, column: str = "created_date"):
    return F.col(column) == F.lit(day).cast("date")


@register("A1 P15", sql=f"{TX} SELECT count(*) AS total_transactions, {msum('amount')} AS total_volume FROM tx WHERE created_date = DATE '{roles.DAY}'")
def day_totals(spark, root):
    tx = guarded_scan(roles.transactions(spark, root), "created_date", _on(roles.DAY))
    return tx.agg(F.count("*").alias("total_transactions"), money_sum("amount").alias("total_volume"))


@register("A2 T1 F13", sql=f"""{TX} SELECT customer_id, count(*) AS txn_count, {msum('amount')} AS total_amount FROM tx
WHERE created_date >= date_trunc('month', DATE '{roles.DAY}') AND created_date <= DATE '{roles.DAY}'
GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 5""")
def top_customers_this_month(spark, root):
    month = F.trunc(F.lit(roles.DAY).cast("date"), "month")
    return (
        roles.transactions(spark, root)
        .where((F.col("created_date") >= month) & (F.col("created_date") <= F.lit(roles.DAY).cast("date")))
        .groupBy("customer_id").agg(F.count("*").alias("txn_count"), money_sum("amount").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "customer_id").limit(5)
    )


@register("A3 F14", sql=f"""{TX} SELECT created_date, count(*) FILTER (status = 'FAILED') AS failed_count, count(*) AS total,
((count(*) FILTER (status = 'FAILED')) * 20000 + count(*)) // (2 * count(*)) / 100.0 AS failure_rate_pct FROM tx GROUP BY 1""")
def daily_failure_rate(spark, root):
    failed = F.count_if(F.col("status") == "FAILED")
    return roles.transactions(spark, root).groupBy("created_date").agg(
        failed.alias("failed_count"), F.count("*").alias("total"), percent(failed, F.count("*")).alias("failure_rate_pct")
    )


@register("A4 F12 P14", sql=f"""{TX} SELECT customer_id, {msum('amount')} AS total FROM tx
WHERE created_date BETWEEN DATE '{roles.DAY}' - INTERVAL 30 DAY AND DATE '{roles.DAY}' GROUP BY 1""")
def customer_totals_30_days(spark, root):
    tx = roles.transactions(spark, root).where(look_back("created_date", roles.DAY, 30))
    return tx.groupBy("customer_id").agg(money_sum("amount").alias("total"))


@register("A5", sql=f"""{TX} SELECT transaction_type, count(*) AS cnt, {mavg('amount')} AS avg_amt FROM tx
WHERE created_date = DATE '{roles.DAY}' GROUP BY 1""")
def day_by_type(spark, root):
    tx = roles.transactions(spark, root).where(_on(roles.DAY))
    return tx.groupBy("transaction_type").agg(F.count("*").alias("cnt"), money_avg("amount").alias("avg_amt"))


@register("A6", sql=f"{AL} SELECT risk_level, count(*) AS cnt FROM al WHERE created_date = DATE '{roles.EVENT_DAY}' GROUP BY 1")
def day_alert_counts(spark, root):
    return roles.alerts(spark, root).where(_on(roles.EVENT_DAY)).groupBy("risk_level").agg(F.count("*").alias("cnt"))


@register("A7", sql=f"""{TX} SELECT customer_id, count(*) AS cnt FROM tx
WHERE created_date >= DATE '{roles.DAY}' - INTERVAL 7 DAY AND created_date <= DATE '{roles.DAY}'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def busiest_customers_7_days(spark, root):
    tx = roles.transactions(spark, root).where(look_back("created_date", roles.DAY, 7))
    return tx.groupBy("customer_id").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "customer_id").limit(10)


@register("A8", sql=f"{AL} SELECT risk_level, count(*) AS cnt, {score_avg('fraud_score')} AS avg_score FROM al WHERE created_date = DATE '{roles.EVENT_DAY}' GROUP BY 1")
def alert_levels(spark, root):
    return daily.alert_levels(roles.alerts(spark, root), roles.EVENT_DAY).orderBy(F.desc("cnt"), "risk_level")


@register("A9", sql=f"""{AL} SELECT customer_id, c_mktsegment AS customer_segment, count(*) AS alert_count, max(fraud_score) AS max_score
FROM al JOIN customer ON customer_id = c_custkey WHERE created_date = DATE '{roles.EVENT_DAY}'
GROUP BY ALL HAVING count(*) > 1 ORDER BY max_score DESC, customer_id LIMIT 10""")
def repeat_alert_customers(spark, root):
    return daily.repeat_customers(roles.alerts(spark, root), roles.customers(spark, root), roles.EVENT_DAY, "customer_segment")


@register("A16", sql=f"""{TX} SELECT created_date, c_mktsegment AS customer_segment, count(*) AS transactions,
{msum('amount')} AS total_revenue, {mavg('amount')} AS avg_revenue FROM tx JOIN customer ON c_custkey = customer_id GROUP BY 1, 2""")
def daily_summary(spark, root):
    dims = roles.customers(spark, root).select("customer_id", "customer_segment")
    tx = roles.transactions(spark, root).join(dims, "customer_id")
    return summary_by_day(tx, "created_date", "customer_segment", "amount")


@register("A18 C3", sql=f"{TX} SELECT count(*) AS cnt FROM tx WHERE created_date = DATE '{roles.DAY}'")
def row_count_for_day(spark, root):
    return roles.transactions(spark, root).where(_on(roles.DAY)).agg(F.count("*").alias("cnt"))


@register("A18 C3", sql="SELECT count(*) AS cnt FROM lineitem")
def row_count(spark, root):
    return roles.lineitem(spark, root).agg(F.count("*").alias("cnt"))


@register("A20", sql="SELECT l_suppkey, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def key_skew_profile(spark, root):
    return key_profile(roles.lineitem(spark, root), "l_suppkey", 10)


@register("A20", sql="""WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT max(n) AS largest, CAST(quantile_disc(n, 0.5) AS BIGINT) AS median, max(n) / CAST(quantile_disc(n, 0.5) AS DOUBLE) AS ratio FROM c""")
def key_skew_ratio(spark, root):
    return skew_ratio(roles.events(spark, root), "user_id")


@register("A21", sql=f"{TX} SELECT transaction_id, customer_id, amount FROM tx")
def counted_transform(spark, root):
    counted, _ = daily.count_rows(roles.transactions(spark, root), "scanned")
    newest = ordered.latest_per_key(counted, ["transaction_id"], [F.desc("created_timestamp")])
    kept, _ = daily.count_rows(newest, "kept")
    return kept.select("transaction_id", "customer_id", "amount")


@register("A22", sql=f"""{AL}, c AS (SELECT customer_id, count(*) AS n FROM al GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, customer_id) AS place FROM c)
SELECT CAST(sum(n) FILTER (place <= 3) AS BIGINT) AS top_rows, CAST(sum(n) AS BIGINT) AS all_rows,
       CAST(sum(n) FILTER (place <= 3) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS share FROM r""")
def share_of_top_customers(spark, root):
    return top_share(roles.alerts(spark, root), "customer_id", 3)


# --- windows, top-k, set operations -------------------------------------------------------


@register("W1", sql="""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""")
def newest_line_per_key(spark, root):
    lines = roles.lineitem(spark, root)
    return ordered.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ordered.total_order(lines, F.desc("l_shipdate")))


@register("W2 W3 W4 W5", sql=f"""WITH tx AS (SELECT event_id AS transaction_id, user_id AS customer_id, value AS amount,
  ts AS created_timestamp, CAST(ts AS DATE) AS created_date FROM events) SELECT tx.*, {FEATURES} FROM tx""")
def event_history_features(spark, root):
    tx = roles.events(spark, root).select(
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("customer_id"), F.col("value").alias("amount"),
        F.col("ts").alias("created_timestamp"), F.to_date("ts").alias("created_date"),
    )
    return ordered.transaction_features(tx)


@register("W6", sql="""WITH f AS (SELECT l_partkey AS drug, CAST(l_shipdate AS DATE) AS fill_date, l_orderkey AS o, l_linenumber AS n,
  CAST(l_quantity AS INTEGER) AS days_supply FROM lineitem)
SELECT drug, fill_date, o, n, days_supply,
       lag(CAST(fill_date + days_supply AS DATE)) OVER (PARTITION BY drug ORDER BY fill_date, o, n, days_supply) AS previous_end FROM f""")
def previous_fill_end(spark, root):
    fills = roles.lineitem(spark, root).select(
        F.col("l_partkey").alias("drug"), F.to_date("l_shipdate").alias("fill_date"), F.col("l_orderkey").alias("o"),
        F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("days_supply"),
    )
    end = F.date_add("fill_date", F.col("days_supply"))
    looked = ordered.with_previous(
        fills, ["drug"], ["fill_date", "o", "n", "days_supply"], 1, end, "_ends"
    )
    return looked.withColumn("previous_end", F.try_element_at("_ends", F.lit(1))).drop("_ends")


@register("W7", sql=f"""{TX} SELECT transaction_id, customer_id, amount,
percent_rank() OVER (PARTITION BY customer_id ORDER BY amount) AS amount_percentile FROM tx""")
def amount_percentile(spark, root):
    tx = roles.transactions(spark, root).select("transaction_id", "customer_id", "amount")
    return ordered.amount_percentile(tx, "customer_id", "amount")


@register("W14", sql="""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS cnt FROM events GROUP BY ALL),
m AS (SELECT *, sum(cnt) OVER w AS s, count(cnt) OVER w AS c FROM d
      WINDOW w AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT event_type, day, cnt, CAST(s AS DOUBLE) / nullif(c, 0) AS trailing_mean,
       (cnt - CAST(s AS DOUBLE) / nullif(c, 0)) * 100.0 / (CAST(s AS DOUBLE) / nullif(c, 0)) AS change_pct FROM m""")
def day_against_trailing_week(spark, root):
    days = roles.events(spark, root).groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("cnt"))
    return ordered.trailing_average(days, ["event_type"], "day", "cnt")


@register("T5", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def capped_result(spark, root):
    return roles.orders(spark, root).select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1000)


@register("U1", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_line_keys(spark, root):
    return daily.unique_rows(
        roles.lineitem(spark, root).select("l_orderkey", "l_linenumber", F.struct("l_orderkey", "l_linenumber").alias("k")), "k"
    ).drop("k")


@register("U1 B2", sql="""SELECT l_orderkey, l_quantity, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey DESC, l_linenumber DESC) AS place FROM lineitem) WHERE place = 1""")
def one_line_per_order(spark, root):
    return daily.unique_rows(roles.lineitem(spark, root).select("l_orderkey", "l_quantity", "l_partkey", "l_linenumber"), "l_orderkey")


@register("F15 A19", sql=f"""{TX}, s AS (SELECT customer_id, count(*) AS n, max(amount) AS largest, min(amount) AS smallest FROM tx GROUP BY 1)
SELECT customer_id, n, greatest(largest - 400000.0, 0.0) AS above, least(smallest, 1000.0) AS below, abs(n - 10) AS off,
       CASE WHEN n = 1 THEN NULL ELSE largest - smallest END AS spread FROM s""")
def customer_extremes(spark, root):
    stats = roles.transactions(spark, root).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.max("amount").alias("largest"), F.min("amount").alias("smallest")
    )
    return stats.select(
        "customer_id", "n",
        F.greatest(F.col("largest") - 400000.0, F.lit(0.0)).alias("above"),
        F.least(F.col("smallest"), F.lit(1000.0)).alias("below"),
        F.abs(F.col("n") - 10).alias("off"),
        F.when(F.col("n") == 1, None).otherwise(F.col("largest") - F.col("smallest")).alias("spread"),
    )
