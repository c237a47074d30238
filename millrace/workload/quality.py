"""Quality checks, governance and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import money_sum
from millrace.operators import governance, joins, quality
from millrace.plans import daily
from millrace.sources import sinks
from millrace.workload import roles
from millrace.workload.registry import register
from millrace.workspace import scratch_path

NOW, TODAY = roles.EVENT_NOW, roles.EVENT_DAY

# Events with a few holes and a few refunds, so the checks have something to find.
CHECKED = """SELECT event_id, ts, CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -value ELSE value END AS amount, event_type FROM events"""

SUITE_SQL = f"""WITH c AS ({CHECKED}),
d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM c WHERE CAST(ts AS DATE) >= DATE '{TODAY}' - INTERVAL 30 DAY GROUP BY 1),
s AS (SELECT avg(n) AS mu, stddev_samp(n) AS sigma FROM d WHERE day < DATE '{TODAY}'),
v AS (SELECT n AS today, mu, coalesce(abs(n - mu) / nullif(sigma, 0), 0) AS z FROM d, s WHERE day = DATE '{TODAY}'),
f AS (SELECT date_diff('second', max(ts), TIMESTAMP '{NOW}') // 3600 AS delay FROM c),
t AS (SELECT count(*) AS n, count(*) FILTER (user_id IS NULL) AS nu, count(*) FILTER (amount IS NULL) AS na,
      count(*) FILTER (amount < 0) AS neg FROM c WHERE CAST(ts AS DATE) = DATE '{TODAY}'),
p AS (SELECT CAST((nu * 20000 + n) // (2 * n) AS DOUBLE) / 100.0 AS pu, CAST((na * 20000 + n) // (2 * n) AS DOUBLE) / 100.0 AS pa, neg FROM t),
r AS (
SELECT 'schema_validation' AS check_name, true AS passed, 'critical' AS severity, 'Schema OK' AS message, CAST(0 AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold
UNION ALL SELECT 'freshness', delay <= 6, 'critical', concat('Last update ', delay, 'h ago (max: 6h)'), delay, 6 FROM f
UNION ALL SELECT 'volume_anomaly', z <= 3.0, 'warning', format('Today: {{}} rows (mean: {{:.0f}}, z: {{:.2f}})', today, mu, z), round(z, 6), 3.0 FROM v
UNION ALL SELECT 'null_rate', pu <= 0.5, 'critical', concat('user_id: ', pu, '% null (max: 0.5%)'), pu, 0.5 FROM p
UNION ALL SELECT 'null_rate', pa <= 1.0, 'critical', concat('amount: ', pa, '% null (max: 1.0%)'), pa, 1.0 FROM p
UNION ALL SELECT 'business_rule_no_negative_amounts', neg <= 0, 'critical', concat('no_negative_amounts: ', neg, ' violations (max: 0)'), neg, 0 FROM p
)
"""


def checked_events(spark, root):
    e = roles.events(spark, root)
    amount = F.when(F.col("event_id") % 113 == 0, None).when(F.col("event_id") % 101 == 0, -F.col("value")).otherwise(F.col("value"))
    return e.select(
        "event_id", "ts", F.when(F.col("event_id") % 97 != 0, F.col("user_id")).alias("user_id"), amount.alias("amount"), "event_type"
    )


def suite(spark, root):
    df = checked_events(spark, root)
    limits = quality.settings_for("default", null_limits={"user_id": 0.5, "amount": 1.0})
    rules = {"no_negative_amounts": F.col("amount") < 0}
    profile = quality.profile_by_day(df, "ts", ["user_id", "amount"], rules, NOW)
    results = quality.suite_results(profile, "events", NOW, ["user_id", "amount"], list(rules), limits)
    expected = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "amount": "double", "event_type": "string"}
    return quality.schema_result(df, "events", expected, NOW).unionByName(results)


@register("Q1 Q2 Q3 Q4 Q5 Q8 C5 U2", sql=SUITE_SQL + f"SELECT r.*, 'events' AS \"table\", '{NOW}' AS checked_at FROM r")
def quality_suite(spark, root):
    return suite(spark, root)


@register("Q6", sql=SUITE_SQL + """, k AS (SELECT count(*) AS checks, count(*) FILTER (NOT passed AND severity = 'critical') AS critical_failures,
count(*) FILTER (NOT passed AND severity = 'warning') AS warnings FROM r)
SELECT 'events' AS "table", *, CASE WHEN critical_failures > 0 THEN 'BLOCKED' WHEN warnings > 0 THEN 'WARNED' ELSE 'PASSED' END AS status FROM k""")
def quality_verdict(spark, root):
    return quality.verdicts(suite(spark, root))


@register("Q7 S8", sql=SUITE_SQL + f"SELECT check_name AS \"check\", 'events' AS \"table\", passed, severity, value, threshold, message, '{NOW}' AS ts FROM r")
def quality_audit_log(spark, root):
    path = scratch_path(spark, "quality-audit")
    sinks.append_rows(quality.audit_log(suite(spark, root)), path)
    return spark.read.parquet(path)


@register("Q5 K3", sql="""SELECT 'business_rule_priced_lines' AS check_name, 'lineitem' AS "table", n <= 100 AS passed, 'critical' AS severity,
concat('priced_lines: ', n, ' violations (max: 100)') AS message, CAST(n AS DOUBLE) AS value, CAST(100 AS DOUBLE) AS threshold, '""" + NOW + """' AS checked_at
FROM (SELECT count(*) FILTER (l_extendedprice < 1000 AND l_quantity > 1) AS n FROM lineitem)""")
def sql_business_rule(spark, root):
    roles.lineitem(spark, root).createOrReplaceTempView("rule_lineitem")
    query = "SELECT count_if(l_extendedprice < 1000 AND l_quantity > 1) AS violations FROM rule_lineitem"
    return quality.sql_rule(spark, "lineitem", "priced_lines", query, NOW, 100)


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]


@register("Q4", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (x IS NULL) AS nulls, count(*) AS rows, "
    f"CAST((count(*) FILTER (x IS NULL) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS null_pct "
    f"FROM (SELECT CASE WHEN l_linenumber = {i % 7 + 1} THEN NULL ELSE {c} END AS x FROM lineitem)" for i, c in enumerate(LINE_COLUMNS)))
def null_rates_one_pass(spark, root):
    lines = roles.lineitem(spark, root)
    holes = [F.when(F.col("l_linenumber") != i % 7 + 1, F.col(c)).alias(c) for i, c in enumerate(LINE_COLUMNS)]
    return quality.null_rates(lines.select(*holes), LINE_COLUMNS)


# Every category that occurs is a dimension; the vector of a day holds only its own.
DRIFT_SQL = """c AS (SELECT {keys} CAST(ts AS DATE) AS day, {category} AS k, count(*) AS n FROM events GROUP BY ALL),
t AS (SELECT {keys} day, CAST(sum(n) AS DOUBLE) AS n FROM c GROUP BY ALL),
e AS (SELECT {keys} CAST(ts AS DATE) AS day, sum(value) / count(value) / 100.0::DOUBLE AS mean, count(*) FILTER (value IS NULL) / CAST(count(*) AS DOUBLE) AS nulls FROM events GROUP BY ALL),
x AS (SELECT {keys} day, concat('=', k) AS k, c.n / t.n AS x FROM c JOIN t USING ({keys} day) UNION ALL SELECT {keys} day, 'mean', mean FROM e UNION ALL SELECT {keys} day, 'nulls', nulls FROM e),
z AS (SELECT {keys} day, sqrt(sum(x * x)) AS size FROM x GROUP BY ALL),
n AS (SELECT *, row_number() OVER ({part} ORDER BY day) AS i FROM z),
p AS (SELECT {a} a.day, b.day AS past, a.size * b.size AS sizes FROM n a JOIN n b ON {same} b.i BETWEEN a.i - 30 AND a.i - 1),
d AS (SELECT {p} p.day, past, sum(u.x * v.x) / min(sizes) AS cos FROM p JOIN x u ON {pu} u.day = p.day JOIN x v ON {pv} v.day = past AND v.k = u.k GROUP BY ALL),
s AS (SELECT {n} n.day, count(cos) AS c, avg(cos) AS m FROM n LEFT JOIN d ON {nd} d.day = n.day GROUP BY ALL)
SELECT {keys} day, CASE WHEN c >= 7 THEN round(m, 6) END AS similarity, CASE WHEN c < 7 THEN 'LEARNING' WHEN m < 0.75 THEN 'ANOMALY' ELSE 'NORMAL' END AS status FROM s"""
# In the last ten days one user in four sends purchases of a kind that was never seen before.
NEW_KIND = "CASE WHEN ts >= TIMESTAMP '2024-01-21' AND user_id % 4 = 0 AND event_type = 'purchase' THEN 'gift' ELSE event_type END"


@register("Q10 W9", sql="WITH " + DRIFT_SQL.format(keys="", category=NEW_KIND, part="", a="", same="", p="", pu="", pv="", n="", nd=""))
def content_drift(spark, root):
    days = roles.events(spark, root).withColumns({"day": F.to_date("ts"), "kind": F.expr(NEW_KIND.replace("TIMESTAMP", "TIMESTAMP_NTZ"))})
    return quality.drift(quality.day_vectors(days, "day", "kind", "value", 100.0))


@register("Q10 W9", sql="WITH events AS (SELECT *, concat('part', user_id % 3) AS part FROM main.events), " + DRIFT_SQL.format(
    keys="part,", category="event_type", part="PARTITION BY part", a="a.part,", same="a.part = b.part AND", p="p.part,", pu="u.part = p.part AND", pv="v.part = p.part AND", n="n.part,",
    nd="d.part = n.part AND"))
def content_drift_by_part(spark, root):
    """Each third of the users is monitored on its own."""
    days = roles.events(spark, root).withColumns({"day": F.to_date("ts"), "part": F.concat(F.lit("part"), F.col("user_id") % 3)})
    return quality.drift(quality.day_vectors(days, "day", "event_type", "value", 100.0, ["part"]), ["part"])


@register("Q10")
def strict_content_drift(spark, root):
    days = roles.events(spark, root).withColumns({"day": F.to_date("ts"), "table": F.lit("events")})
    return quality.strict_drift(quality.day_vectors(days, "day", "event_type", "value", 100.0, ["table"]), ["table"])


@register("Q11 J13", sql="SELECT l_orderkey, l_linenumber, l_partkey * 3 AS p_partkey FROM lineitem WHERE l_partkey * 3 NOT IN (SELECT p_partkey FROM part)")
def unknown_codes(spark, root):
    lines = roles.lineitem(spark, root).select("l_orderkey", "l_linenumber", (F.col("l_partkey") * 3).alias("p_partkey"))
    return joins.unknown(lines, roles.part(spark, root), "p_partkey")


DATE_TEXT = """CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN concat(strftime(l_shipdate, '%Y'), '-13-', strftime(l_shipdate, '%d')) ELSE strftime(l_shipdate, '%Y-%m-%d') END"""


@register("Q12", sql=f"""SELECT l_orderkey, l_linenumber, d AS fill_text, CASE WHEN TRY_CAST(d AS DATE) IS NULL THEN 'unparsable' ELSE 'future' END AS reason
FROM (SELECT l_orderkey, l_linenumber, {DATE_TEXT} AS d FROM lineitem) WHERE TRY_CAST(d AS DATE) IS NULL OR TRY_CAST(d AS DATE) > DATE '2001-06-30'""")
def implausible_dates(spark, root):
    broken = F.date_format("l_shipdate", "yyyy-'13'-dd")
    text = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 3), broken).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = roles.lineitem(spark, root).select("l_orderkey", "l_linenumber", text.alias("fill_text"))
    return quality.implausible_dates(rows, "fill_text", "2001-06-30")


@register("Q13", sql=f"""WITH f AS ({roles.FILLS}) SELECT patient, drug, fill_date, count(DISTINCT pharmacy) AS pharmacies, count(*) AS fills
FROM (SELECT * FROM f UNION ALL SELECT patient, molecule, drug, pharmacy + 1, fill_date, days_supply FROM f WHERE drug % 50 = 0) GROUP BY 1, 2, 3 HAVING count(DISTINCT pharmacy) > 1""")
def double_dispensing(spark, root):
    """Every fill of each fiftieth drug is handed out by the next pharmacy as well."""
    fills = roles.fills(spark, root)
    again = fills.where("drug % 50 = 0").withColumn("pharmacy", F.col("pharmacy") + 1)
    return quality.double_dispensing(fills.unionByName(again), "patient", "drug", "fill_date", "pharmacy")


@register("Q14", sql="""WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey AS drug, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem),
a AS (SELECT drug, CAST(count(*) AS DOUBLE) AS c, CAST(sum(quantity) AS DOUBLE) AS s, CAST(sum(quantity * quantity) AS DOUBLE) AS q FROM f GROUP BY 1),
b AS (SELECT drug, s / c AS m, sqrt((q * c - s * s) / (c * (c - 1))) AS sd FROM a WHERE c > 1)
SELECT f.*, (quantity - m) / sd AS z FROM f JOIN b USING (drug) WHERE sd > 0 AND abs((quantity - m) / sd) > 1.8""")
def dosage_outliers(spark, root):
    fills = roles.lineitem(spark, root).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("drug"), F.col("l_quantity").cast("int").alias("quantity")
    )
    return quality.outliers_by_group(fills, "drug", "quantity", 1.8)


@register("Q15", sql=f"""WITH f AS ({roles.FILLS}), b AS (SELECT p_type AS molecule, min(p_size) AS min_age, 40 + min(p_size) AS max_age FROM part GROUP BY 1)
SELECT patient, molecule, fill_date, patient % 90 AS age, min_age, max_age FROM f JOIN b USING (molecule) WHERE patient % 90 NOT BETWEEN min_age AND max_age""")
def age_incompatible_fills(spark, root):
    bands = roles.part(spark, root).groupBy(F.col("p_type").alias("molecule")).agg(
        F.min("p_size").alias("min_age"), (F.lit(40) + F.min("p_size")).alias("max_age")
    )
    rows = roles.fills(spark, root).select("patient", "molecule", "fill_date", (F.col("patient") % 90).alias("age"))
    return quality.outside_range(rows, bands, "molecule", "age", "min_age", "max_age")


@register("Q16", sql="""WITH c AS (SELECT l_suppkey AS prescriber, p_type AS drug, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
r AS (SELECT *, n / CAST(sum(n) OVER (PARTITION BY prescriber) AS DOUBLE) AS rate FROM c),
s AS (SELECT drug, avg(rate) AS m, stddev_samp(rate) AS sd FROM r GROUP BY 1)
SELECT prescriber, drug, n, rate, round((rate - m) / sd, 6) AS z FROM r JOIN s USING (drug)""")
def prescribing_outliers(spark, root):
    parts = roles.part(spark, root).select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("drug"))
    rows = roles.lineitem(spark, root).select(F.col("l_suppkey").alias("prescriber"), "l_partkey").join(parts, "l_partkey")
    return quality.prescribing_outliers(rows, "prescriber", "drug")


@register("Q17", sql="""WITH m AS (SELECT o_orderstatus = 'F' AS old, CASE WHEN o_orderstatus = 'F'
  THEN concat('{"id": ', o_orderkey, ', "amount": "', o_totalprice, '", "phone": "1"}')
  ELSE concat('{"id": ', o_orderkey, ', "amount": ', floor(o_totalprice) + 0.25, ', "phone_v2": "1"}') END AS raw FROM orders),
k AS (SELECT old, raw, unnest(json_keys(raw)) AS c FROM m),
t AS (SELECT old, c, string_agg(DISTINCT CASE json_type(raw, '$.' || c) WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'DECIMAL' ELSE 'BIGINT' END, '|') AS ty FROM k GROUP BY 1, 2),
j AS (SELECT coalesce(a.c, b.c) AS "column", a.ty AS old_type, b.ty AS new_type FROM (SELECT * FROM t WHERE old) a FULL JOIN (SELECT * FROM t WHERE NOT old) b ON a.c = b.c)
SELECT *, CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed' ELSE 'retyped' END AS change FROM j WHERE old_type IS DISTINCT FROM new_type""")
def schema_changes(spark, root):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    old = F.concat(F.lit('{"id": '), "o_orderkey", F.lit(', "amount": "'), price, F.lit('", "phone": "1"}'))
    new = F.concat(F.lit('{"id": '), "o_orderkey", F.lit(', "amount": '), (F.floor(price) + 0.25).cast("decimal(12,2)"), F.lit(', "phone_v2": "1"}'))
    orders = roles.orders(spark, root)
    before = orders.where("o_orderstatus = 'F'").select(old.alias("raw"))
    after = orders.where("o_orderstatus <> 'F'").select(new.alias("raw"))
    return quality.schema_changes(quality.json_fields(before, "raw"), quality.json_fields(after, "raw"))


LINEAGE_SQL = """WITH l AS (SELECT strftime(l_shipdate, '%Y-%m') AS m, count(*) AS raw, count(DISTINCT concat(l_orderkey, '/', l_linenumber)) AS kept,
count(*) FILTER (l_quantity > 20) AS loaded FROM lineitem GROUP BY 1)"""


def stage_lineage(spark, root):
    """Lineage rows of a three-stage load, per ship month, with real row counts."""
    per_month = roles.lineitem(spark, root).groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("m")).agg(
        F.count("*").alias("raw"), F.count_distinct(F.concat_ws("/", "l_orderkey", "l_linenumber")).alias("kept"),
        F.count_if(F.col("l_quantity") > 20).alias("loaded"),
    )
    steps = [("source", "raw", "raw"), ("raw", "clean", "kept"), ("clean", "mart", "loaded")]
    rows = F.array(*[
        F.struct(F.concat_ws(".", F.lit(a), "m").alias("source_table"), F.concat_ws(".", F.lit(b), "m").alias("target_table"),
                 F.lit("lines").alias("pipeline_name"), F.lit("load").alias("transformation"), F.col(c).alias("row_count"))
        for a, b, c in steps
    ])
    return per_month.select(F.inline(rows))


@register("Q18 G1", sql=LINEAGE_SQL + """, s AS (
SELECT concat('source.', m) AS from_table, concat('raw.', m) AS stage, concat('clean.', m) AS to_table, raw AS rows_in, kept AS rows_out FROM l
UNION ALL SELECT concat('raw.', m), concat('clean.', m), concat('mart.', m), kept, loaded FROM l)
SELECT *, (rows_in - rows_out) / CAST(rows_in AS DOUBLE) AS loss FROM s WHERE (rows_in - rows_out) / CAST(rows_in AS DOUBLE) > 0.2""")
def row_loss_between_stages(spark, root):
    return quality.row_loss(stage_lineage(spark, root), 0.2)


@register("Q19 W9", sql="""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
w AS (SELECT *, CAST(count(n) OVER x AS DOUBLE) AS c, CAST(sum(n) OVER x AS DOUBLE) AS s, CAST(sum(n * n) OVER x AS DOUBLE) AS q FROM d
      WINDOW x AS (ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
z AS (SELECT day, coalesce(CASE WHEN c >= 2 THEN abs(n - s / c) / nullif(sqrt((q * c - s * s) / (c * (c - 1))), 0) END, 0) AS z FROM w),
f AS (SELECT count(*) AS days, count(*) FILTER (z > 2.5) AS flagged_days FROM z)
SELECT *, CASE WHEN flagged_days = 0 THEN 'NORMAL' WHEN flagged_days = 1 THEN 'ONE_OFF' ELSE 'PATTERN' END AS verdict FROM f""")
def volume_history(spark, root):
    daily_rows = roles.orders(spark, root).groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return quality.volume_history(daily_rows, 2.5)


# --- governance ----------------------------------------------------------------------------


@register("G1 A21")
def recorded_lineage(spark, root):
    """A load that counts its rows while writing and leaves a lineage row."""
    path = scratch_path(spark, "lineage-load")
    counted, seen = daily.count_rows(roles.transactions(spark, root), "loaded")
    sinks.append_rows(counted, path)
    return governance.lineage_row(spark, "orders", "fact_transactions", "daily_load", "copy", seen.get["rows"], NOW)


ACCESS_LOG = """SELECT event_id, concat('user', user_id) AS usr, concat('How many ', event_type, ' events today, case ', props, '?') AS question,
concat('SELECT ', repeat('value + ', CAST(event_id % 40 AS INTEGER)), '1 FROM analytics.events WHERE user_id = ', user_id) AS query,
event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS logged_at FROM events"""


def access_log(spark, root):
    return roles.events(spark, root).select(
        "event_id", F.concat(F.lit("user"), "user_id").alias("usr"),
        F.concat(F.lit("How many "), "event_type", F.lit(" events today, case "), "props", F.lit("?")).alias("question"),
        F.concat(F.lit("SELECT "), F.repeat(F.lit("value + "), (F.col("event_id") % 40).cast("int")),
                 F.lit("1 FROM analytics.events WHERE user_id = "), "user_id").alias("query"),
        "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("logged_at"),
        F.array(F.lit("analytics.events"), F.concat(F.lit("analytics."), "event_type")).alias("tables"),
    )


@register("G2", sql=f"""SELECT usr AS "user", 'ai_query' AS action, concat('analytics.events, analytics.', event_type) AS resource,
concat('Question: ', question, ' | SQL: ', substring(query, 1, 200)) AS details, logged_at AS timestamp FROM ({ACCESS_LOG})""")
def generated_query_audit(spark, root):
    return governance.ai_query_audit(access_log(spark, root), "usr", "question", "query", "tables", "logged_at")


@register("G3 F8", sql=f"""SELECT usr AS "user", 'data_access' AS action, event_type AS resource, substring(query, 1, 500) AS details, logged_at AS timestamp FROM ({ACCESS_LOG})""")
def data_access_audit(spark, root):
    return governance.data_access_audit(access_log(spark, root), "usr", "event_type", "query", "logged_at")


POLICIES = {"asia-analysts": ["ASIA"], "europe-analysts": ["EUROPE"], "finance": governance.EVERYTHING}


@register("G4", sql=f"""SELECT r_name AS region, o_orderpriority, count(*) AS cnt, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL""")
def rows_visible_to_analysts(spark, root):
    places = roles.nation(spark, root).join(roles.region(spark, root), F.col("n_regionkey") == F.col("r_regionkey"))
    people = joins.broadcast_join(
        roles.customer(spark, root).withColumnRenamed("c_nationkey", "n_nationkey"), places.select("n_nationkey", F.col("r_name").alias("region")), "n_nationkey"
    )
    orders = roles.orders(spark, root).join(people, F.col("o_custkey") == F.col("c_custkey"))
    seen = governance.apply_row_policies(orders, "region", POLICIES, ["asia-analysts", "europe-analysts"])
    return seen.groupBy("region", "o_orderpriority").agg(F.count("*").alias("cnt"), money_sum("o_totalprice").alias("total"))


@register("G5 F23", sql="""SELECT c_custkey, c_mktsegment, role, CASE WHEN role = 'data_steward' THEN c_name ELSE 'MASKED' END AS c_name,
CASE WHEN role = 'data_steward' THEN postcode ELSE concat(substring(postcode, 1, 3), ' ***') END AS postcode
FROM (SELECT *, concat('PC', c_custkey * 7) AS postcode FROM customer) CROSS JOIN (VALUES ('data_steward'), ('analyst')) r(role)""")
def masked_customers(spark, root):
    """Customers as each role sees them."""
    people = roles.customer(spark, root).withColumn("postcode", F.concat(F.lit("PC"), F.col("c_custkey") * 7))
    seen = people.withColumn("role", F.explode(F.array(F.lit("data_steward"), F.lit("analyst"))))
    masks = {"c_name": governance.full_mask(), "postcode": governance.prefix_mask("postcode")}
    return governance.masked_columns(seen, masks, F.col("role") == "data_steward").select("c_custkey", "c_mktsegment", "role", "c_name", "postcode")


@register("G6 F7", sql="SELECT sha256(concat('pepper', c_custkey)) AS c_custkey, c_mktsegment FROM customer")
def pseudonymised_customers(spark, root):
    return governance.pseudonymised(roles.customer(spark, root).select("c_custkey", "c_mktsegment"), "c_custkey", "pepper")


EDGES_SQL = """e AS (SELECT concat('region:', n_regionkey) AS source, concat('nation:', n_nationkey) AS target FROM nation
UNION SELECT concat('nation:', c_nationkey), concat('customer:', c_custkey) FROM customer
UNION SELECT concat('customer:', o_custkey), concat('order:', o_orderkey) FROM orders)"""


def lineage_edges(spark, root):
    def edge(df, a, b, x, y):
        return df.select(F.concat_ws(":", F.lit(a), x).alias("source"), F.concat_ws(":", F.lit(b), y).alias("target"))

    return (
        edge(roles.nation(spark, root), "region", "nation", "n_regionkey", "n_nationkey")
        .unionByName(edge(roles.customer(spark, root), "nation", "customer", "c_nationkey", "c_custkey"))
        .unionByName(edge(roles.orders(spark, root), "customer", "order", "o_custkey", "o_orderkey"))
    )


@register("G7", sql=f"""WITH RECURSIVE {EDGES_SQL}, w AS (
SELECT source AS root, target AS node, 1 AS depth FROM e WHERE starts_with(source, 'region:')
UNION SELECT w.root, e.target, w.depth + 1 FROM w JOIN e ON e.source = w.node)
SELECT root, node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY ALL""")
def downstream_impact(spark, root):
    edges = lineage_edges(spark, root)
    roots = edges.where(F.col("source").startswith("region:")).select("source")
    return governance.lineage_reach(edges, roots)


@register("G7", sql=f"""WITH RECURSIVE {EDGES_SQL}, w AS (
SELECT target AS root, source AS node, 1 AS depth FROM e WHERE starts_with(target, 'customer:')
UNION SELECT w.root, e.source, w.depth + 1 FROM w JOIN e ON e.target = w.node)
SELECT root, node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY ALL""")
def upstream_trace(spark, root):
    edges = lineage_edges(spark, root)
    roots = edges.where(F.col("target").startswith("customer:")).select("target")
    return governance.lineage_reach(edges, roots, source="target", target="source")


# --- cost ----------------------------------------------------------------------------------

JOBS = """SELECT event_id AS job_id, concat('user', user_id) AS user_email, concat('SELECT ', event_type) AS query, ts AS creation_time,
CAST(round(value * 100) AS BIGINT) * 10000000 AS total_bytes_billed, CASE WHEN event_type = 'view' THEN 'LOAD' ELSE 'QUERY' END AS job_type,
CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'DONE' END AS state FROM events"""


def job_log(spark, root):
    return roles.events(spark, root).select(
        F.col("event_id").alias("job_id"), F.concat(F.lit("user"), "user_id").alias("user_email"),
        F.concat(F.lit("SELECT "), "event_type").alias("query"), F.col("ts").alias("creation_time"),
        (F.round(F.col("value") * 100).cast("bigint") * 10000000).alias("total_bytes_billed"),
        F.when(F.col("event_type") == "view", "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("DONE").alias("state"),
    )


@register("A17", sql=f"""WITH j AS ({JOBS}) SELECT CAST(sum(total_bytes_billed) AS DOUBLE) / pow(1024, 4) AS tb_billed,
CAST(sum(total_bytes_billed) AS DOUBLE) / pow(1024, 4) * 6.25 AS estimated_cost_usd FROM j WHERE job_type = 'QUERY' AND state = 'DONE'""")
def total_scan_cost(spark, root):
    return governance.total_scan_cost(job_log(spark, root))


@register("G8", sql=f"""WITH j AS ({JOBS}), d AS (SELECT CAST(creation_time AS DATE) AS day, CAST(sum(total_bytes_billed) AS DOUBLE) / pow(1024, 4) * 6.25 AS cost_usd
FROM j WHERE job_type = 'QUERY' AND state = 'DONE' GROUP BY 1)
SELECT *, CASE WHEN cost_usd > 50.0 THEN 'ALERT' WHEN cost_usd > 40.0 THEN 'WARNING' ELSE 'OK' END AS status FROM d""")
def daily_budget(spark, root):
    return governance.daily_budget(job_log(spark, root))


@register("G9 T1", sql=f"""WITH j AS ({JOBS}) SELECT job_id, user_email, query, CAST(total_bytes_billed AS DOUBLE) / pow(1024, 3) AS gb_billed FROM j
WHERE creation_time >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND creation_time <= TIMESTAMP '{NOW}' ORDER BY total_bytes_billed DESC, job_id LIMIT 10""")
def costliest_queries(spark, root):
    return governance.costliest_queries(job_log(spark, root), NOW)


@register("G10", sql=f"""WITH j AS ({JOBS}) SELECT user_email, CAST(creation_time AS DATE) AS day, CAST(sum(total_bytes_billed) AS BIGINT) AS bytes_billed FROM j GROUP BY 1, 2
HAVING sum(total_bytes_billed) > 200000000000""")
def users_over_quota(spark, root):
    return governance.over_quota(job_log(spark, root), 200_000_000_000)
