"""Loyalty, settlement, baskets and demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import retail
from millrace.workload import roles
from millrace.workload.registry import register


@register("R2 J7 A12 A13 A14", sql="""
WITH s AS (SELECT o_custkey AS card_id, date_trunc('month', l_shipdate)::DATE AS sale_date, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS daily_spend_gbp,
  count(*) AS items_purchased, count(DISTINCT l_suppkey) AS stores_visited, list_sort(list(DISTINCT l_returnflag)) AS categories_shopped
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
n AS (SELECT o_custkey AS card_id, date_trunc('month', o_orderdate)::DATE AS sale_date,
  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) ELSE 0 END) AS BIGINT) AS points_earned_today,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) ELSE 0 END) AS BIGINT) AS points_redeemed_today,
  count(DISTINCT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END) AS partner_brands_today, count(*) AS total_loyalty_events FROM orders GROUP BY 1, 2)
SELECT * FROM s LEFT JOIN n USING (card_id, sale_date)""")
def loyalty_spend(spark, root):
    orders = roles.orders(spark, root)
    sales = roles.lineitem(spark, root).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("card_id"), F.trunc("l_shipdate", "month").alias("sale_date"), F.col("l_extendedprice").alias("sale_price_gbp"),
        F.col("l_suppkey").alias("store_id"), F.col("l_returnflag").alias("category_code"),
    )
    loyalty = orders.select(
        F.col("o_custkey").alias("card_id"), F.trunc("o_orderdate", "month").alias("event_date"),
        F.when(F.col("o_orderstatus") == "O", "EARN").when(F.col("o_orderstatus") == "F", "REDEEM").otherwise("VIEW").alias("event_type"),
        F.floor(F.col("o_totalprice") / 1000).alias("points"), F.when(F.col("o_orderpriority") == "5-LOW", "HOME").otherwise("PARTNER").alias("source"),
        F.col("o_orderpriority").alias("partner_name"),
    )
    return retail.loyalty_spend(sales, loyalty, "HOME")


SETTLE = """
WITH po AS (SELECT l_suppkey AS supplier_id, l_orderkey AS po_number, CAST(sum(l_quantity) AS BIGINT) AS qty_ordered, min(l_partkey) % 50 AS product_code,
  min(l_linenumber) AS store_id, min(l_tax) + 2 AS unit_cost_gbp FROM lineitem GROUP BY 1, 2),
gr AS (SELECT l_suppkey AS supplier_id, l_orderkey AS po_number, CAST(sum(l_quantity - CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS BIGINT) AS qty_delivered
  FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1, 2),
pr AS (SELECT l_suppkey AS supplier_id, l_partkey % 50 AS product_code, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS promo FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
md AS (SELECT l_suppkey AS supplier_id, l_partkey % 50 AS product_code, l_linenumber AS store_id, sum(CAST(l_tax AS DECIMAL(18,2))) AS claim FROM lineitem
  WHERE l_returnflag = 'R' GROUP BY 1, 2, 3),
ln AS (SELECT po.*, s_name AS supplier_name, qty_delivered, promo, coalesce(CAST(qty_delivered AS DOUBLE) / CAST(qty_ordered AS DOUBLE), 0.0) AS rate
  FROM po JOIN supplier ON s_suppkey = supplier_id LEFT JOIN gr USING (supplier_id, po_number) LEFT JOIN pr USING (supplier_id, product_code)),
ag AS (SELECT supplier_id, supplier_name, coalesce(sum(CAST(unit_cost_gbp AS DECIMAL(18,2)) * CAST(qty_delivered AS DECIMAL(10,0))), 0) AS goods,
  coalesce(sum(CAST(promo * CAST(rate AS DECIMAL(12,8)) AS DECIMAL(24,4))), 0) AS promo_income, count(DISTINCT po_number) AS total_pos,
  count(DISTINCT CASE WHEN rate < 0.98 THEN po_number END) AS short_shipped_pos FROM ln GROUP BY 1, 2),
cl AS (SELECT supplier_id, sum(claim) AS claims FROM md WHERE EXISTS (SELECT 1 FROM po WHERE po.supplier_id = md.supplier_id AND po.product_code = md.product_code AND po.store_id = md.store_id) GROUP BY 1)
SELECT supplier_id, supplier_name, CAST(goods AS DOUBLE) AS goods_cost_gbp, CAST(promo_income AS DOUBLE) AS promo_income_gbp, CAST(coalesce(claims, 0) AS DOUBLE) AS markdown_income_gbp,
  total_pos, short_shipped_pos, CAST(CAST(goods AS DECIMAL(30,4)) - promo_income - coalesce(claims, 0) AS DOUBLE) AS net_payable_gbp
FROM ag LEFT JOIN cl USING (supplier_id)"""


@register("R3 A15 J8", sql=SETTLE)
def supplier_settlement(spark, root):
    c = F.col
    lines = roles.lineitem(spark, root).withColumnRenamed("l_suppkey", "supplier_id").withColumn("product_code", c("l_partkey") % 50)
    names = roles.supplier(spark, root).select(c("s_suppkey").alias("supplier_id"), c("s_name").alias("supplier_name"))
    purchase = lines.groupBy("supplier_id", c("l_orderkey").alias("po_number")).agg(
        F.sum("l_quantity").cast("bigint").alias("qty_ordered"), (F.min("l_partkey") % 50).alias("product_code"),
        F.min("l_linenumber").alias("store_id"), (F.min("l_tax") + 2).alias("unit_cost_gbp"),
    ).join(names, "supplier_id")
    short = F.when(c("l_discount") >= 0.08, 1).otherwise(0)
    delivered = lines.where("l_linenumber <> 7").select(
        "supplier_id", c("l_orderkey").alias("po_number"), (c("l_quantity") - short).cast("bigint").alias("qty_delivered")
    )
    promos = lines.where("l_returnflag = 'N'").select("supplier_id", "product_code", c("l_discount").alias("promo_allowance_gbp"))
    markdowns = lines.where("l_returnflag = 'R'").select(
        "supplier_id", "product_code", c("l_linenumber").alias("store_id"), c("l_tax").alias("markdown_claim_gbp")
    )
    return retail.supplier_settlement(purchase, delivered, promos, markdowns)


@register("R4", sql="""WITH h AS (SELECT DISTINCT l_orderkey AS b, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (SELECT CAST(count(DISTINCT b) AS DOUBLE) AS n FROM h), s AS (SELECT i, count(*) AS c FROM h GROUP BY 1),
p AS (SELECT x.i AS item_a, y.i AS item_b, count(*) AS baskets FROM h x JOIN h y ON x.b = y.b AND x.i < y.i GROUP BY 1, 2)
SELECT item_a, item_b, baskets, baskets / n AS support, baskets / CAST(a.c AS DOUBLE) AS confidence, CAST(baskets AS DOUBLE) * n / (CAST(a.c AS DOUBLE) * b.c) AS lift
FROM p JOIN s a ON a.i = item_a JOIN s b ON b.i = item_b, t WHERE baskets >= n * 0.02""")
def basket_pairs(spark, root):
    parts = roles.part(spark, root).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = roles.lineitem(spark, root).select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    return retail.pair_rules(lines, "l_orderkey", "p_brand", 0.02)


@register("R4", sql="""WITH h AS (SELECT DISTINCT l_orderkey AS b, p_brand AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (SELECT CAST(count(DISTINCT b) AS DOUBLE) AS n FROM h),
s AS (SELECT [i] AS items, count(*) AS c FROM h GROUP BY 1
  UNION ALL SELECT [x.i, y.i], count(*) FROM h x JOIN h y ON x.b = y.b AND x.i < y.i GROUP BY 1
  UNION ALL SELECT [x.i, y.i, z.i], count(*) FROM h x JOIN h y ON x.b = y.b AND x.i < y.i JOIN h z ON z.b = y.b AND y.i < z.i GROUP BY 1),
f AS (SELECT items, c FROM s, t WHERE c >= n * 0.001),
r AS (SELECT list_filter(items, lambda x: x <> item) AS given, item, c AS baskets FROM (SELECT items, c, unnest(items) AS item FROM f WHERE len(items) > 1))
SELECT array_to_string(given, ' + ') AS given, item, baskets, baskets / n AS support, baskets / CAST(g.c AS DOUBLE) AS confidence, CAST(baskets AS DOUBLE) * n / (CAST(g.c AS DOUBLE) * a.c) AS lift
FROM r JOIN f g ON g.items = given JOIN f a ON a.items = [item], t""")
def basket_rules(spark, root):
    """Rules from pairs and triples of brands, in every direction."""
    parts = roles.part(spark, root).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = roles.lineitem(spark, root).select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    return retail.basket_rules(lines, "l_orderkey", "p_brand", 0.001).withColumn("given", F.array_join("given", " + "))


@register("R5", sql="""WITH d AS (SELECT l_suppkey, p_type, CAST(l_shipdate AS DATE) AS day, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
SELECT *, lag(units) OVER w AS previous_units, CAST(day - lag(day) OVER w AS INTEGER) AS days_since_sale,
  CAST(sum(units) OVER (PARTITION BY l_suppkey, p_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS units_7d,
  CAST(sum(units) OVER (PARTITION BY l_suppkey, p_type ORDER BY day RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS units_28d
FROM d WINDOW w AS (PARTITION BY l_suppkey, p_type ORDER BY day)""")
def demand_features(spark, root):
    parts = roles.part(spark, root).select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sales = roles.lineitem(spark, root).join(parts, "l_partkey").select(
        "l_suppkey", "p_type", F.to_date("l_shipdate").alias("day"), F.col("l_quantity").cast("bigint").alias("q")
    )
    return retail.demand_features(sales, "l_suppkey", "p_type", "day", "q")
