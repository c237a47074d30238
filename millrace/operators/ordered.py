"""Order-dependent features that survive a key holding a large share of all rows.

A plain window puts every row of a key into one task. Here rows are range-partitioned by key and
order, so a slot follows the rows: it holds about as many of them as any other slot, however they
are spread over keys or over the calendar. Windows run inside a slot. Only the first and the last
key of a slot can reach into another one, so what goes over the borders is one small row per key
and slot (at most two keys per slot), summed up in order and sent back to the rows. Every key takes
the same way, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.numbers import money
from millrace.workspace import cut_lineage

BEFORE = (Window.unboundedPreceding, -1)
AFTER = (1, Window.unboundedFollowing)
SENT_ROWS = 100_000  # rows of a table that is sent to every task without a bound of its own


def slotted(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with the number of its slot in ``_slot``: slots ascend with the keys and the order.

    Rows are written out once, since slots must not change between the passes over them. Rows that
    tie in keys and order are dealt by their content and by the task that read them, which a retried
    task finds again, so not even copies all share a slot.
    """
    plain = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    salt = F.xxhash64(*plain) + F.spark_partition_id()
    placed = df.withColumn("_salt", salt).repartitionByRange(*keys, *order, "_salt").drop("_salt")
    return cut_lineage(placed.withColumn("_slot", F.spark_partition_id()))


def across_slots(per_slot: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of keys that reach over a border, of a table with one row per key and slot.

    At most two keys of a slot do, its first and its last, so two rows per slot remain.
    """
    return per_slot.withColumn("_slots", F.count("*").over(Window.partitionBy(*keys))).where("_slots > 1").drop("_slots")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Left join in which nulls equal nulls; the right side's names are dropped."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    met = F.lit(True)
    for n in names:
        met = met & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return left.join(renamed, met, "left").drop(*[f"_r_{n}" for n in names])


def sent(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """A small table written out, marked to be sent to every task if it has at most ``rows`` rows."""
    kept = cut_lineage(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def _plus(*parts: Column) -> Column:
    """Sum of what is there; null when nothing is."""
    total = F.coalesce(*parts)
    some = F.lit(0)
    for p in parts:
        some = some + F.coalesce(p, F.lit(0))
    return F.when(total.isNotNull(), some)


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The row-number filter lets Spark keep one row per key and task before the shuffle.
    """
    return first_per_key(df, keys, newest_first, 1, "_place").drop("_place")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, place: str) -> DataFrame:
    """The first ``n`` rows per key with their place; at most ``n`` per key and task are shuffled."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(place, F.row_number().over(window)).where(F.col(place) <= n)


def total_order(df: DataFrame, *first: Column) -> list[Column]:
    """The given order, then every remaining column, so equal rows only tie with copies."""
    return [*first, *[F.col(c).desc() for c in df.columns]]


def transaction_features(
    tx: DataFrame, customer: str = "customer_id", ts: str = "created_timestamp", day: str = "created_date",
    amount: str = "amount", tie: str = "transaction_id",
) -> DataFrame:
    """Running total, recency rank, daily count and daily amount per customer.

    ``running_total`` gives equal timestamps one shared value (RANGE frame); rows without a time
    come first. Days are those of ``day``, whatever ``ts`` says. Rows without a customer have no
    history: they get nulls.
    """
    rows = slotted(tx, [customer], [ts, tie])
    known = rows.where(F.col(customer).isNotNull())
    offsets = _slot_offsets(known, customer, ts, amount)
    days = _days_across_slots(known, customer, day, amount)

    inside = Window.partitionBy("_slot", customer)
    in_day = Window.partitionBy("_slot", customer, day)
    upto_now = inside.orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    features = {
        "_run": F.sum(money(amount)).over(upto_now), "_place": F.row_number().over(inside.orderBy(ts, tie)), "_size": F.count("*").over(inside),
        "_dn": F.count("*").over(in_day), "_ds": F.sum(money(amount)).over(in_day),
    }
    met = same(same(rows.withColumns(features), F.broadcast(offsets), [customer, "_slot"]), days, [customer, day])
    more = F.when(F.col(ts).eqNullSafe(F.col("_last.t")), F.col("_more"))
    values = {
        "running_total": _plus(F.col("_before"), F.col("_run"), more).cast("double"),
        "txn_rank": (F.coalesce("_newer", F.lit(0)) + F.col("_size") - F.col("_place") + 1).cast("long"),
        "daily_txn_count": F.coalesce("_day_n", "_dn"),
        "daily_total_amount": F.when(F.col("_day_n").isNotNull(), F.col("_day_s")).otherwise(F.col("_ds")).cast("double"),
    }
    values = {name: F.when(F.col(customer).isNotNull(), value) for name, value in values.items()}
    return met.withColumns(values).select(*tx.columns, *values)


def _slot_offsets(rows: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    """Per customer and slot: amount before it, rows after it, amount of later slots at its last time."""
    time = F.struct(F.col(ts).isNotNull().alias("there"), F.col(ts).alias("t"))
    instants = rows.groupBy("_slot", customer, ts).agg(F.sum(money(amount)).alias("_s"), F.count("*").alias("_n")).withColumn("_t", time)
    per_slot = instants.groupBy("_slot", customer).agg(
        F.sum("_s").alias("_s"), F.sum("_n").alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.min_by("_s", "_t").alias("_at_first"))
    border = cut_lineage(across_slots(per_slot, [customer]))
    by_slot = Window.partitionBy(customer).orderBy("_slot")
    totals = border.select(
        customer, "_slot", "_last", F.sum("_s").over(by_slot.rowsBetween(*BEFORE)).alias("_before"), F.sum("_n").over(by_slot.rowsBetween(*AFTER)).alias("_newer"))
    # A time at which one slot ends and later ones begin: what begins there belongs to the rows that end there.
    begin = border.select(customer, "_slot", F.col("_first").alias("_t"), F.col("_at_first").alias("_a"), F.lit(False).alias("_end"))
    end = border.select(customer, "_slot", F.col("_last").alias("_t"), F.lit(None).cast("decimal(38,2)").alias("_a"), F.lit(True).alias("_end"))
    later = Window.partitionBy(customer, "_t").orderBy(F.desc("_slot")).rangeBetween(Window.unboundedPreceding, -1)
    more = begin.unionByName(end).withColumn("_more", F.sum("_a").over(later)).where("_end").select(customer, "_slot", "_more")
    return totals.join(more, [customer, "_slot"])


def _days_across_slots(rows: DataFrame, customer: str, day: str, amount: str) -> DataFrame:
    """Totals of the customer days whose rows lie in several slots."""
    parts = rows.groupBy("_slot", customer, day).agg(F.sum(money(amount)).alias("_s"), F.count("*").alias("_n"))
    totals = parts.groupBy(customer, day).agg(F.sum("_s").alias("_day_s"), F.sum("_n").alias("_day_n"), F.count("*").alias("_slots"))
    return sent(totals.where("_slots > 1").drop("_slots"))


def with_previous(df: DataFrame, keys: list[str], order: list[str], n: int, payload: Column, out: str) -> DataFrame:
    """Payloads of the ``n`` rows before each row of its key, oldest first, as an array.

    Rows look back inside their slot; the last ``n`` rows of earlier slots are carried over the
    border. Rows with a null key are one key.
    """
    rows = slotted(df.withColumn("_item", F.struct(*order, payload.alias("_payload"))), keys, order)
    counts = rows.groupBy("_slot", *keys).agg(F.count("*").alias("_n"))
    border = F.broadcast(cut_lineage(across_slots(counts, keys)))
    near = same(rows.select("_slot", *keys, "_item"), border, ["_slot", *keys]).where("_n is not null").drop("_n")
    tails = (
        first_per_key(near, ["_slot", *keys], [F.desc("_item")], n, "_place")  # n rows per key, slot and task
        .groupBy("_slot", *keys)
        .agg(F.sort_array(F.collect_list("_item")).alias("_tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(-n, -1)  # every slot has a row at least
    carried = tails.select(*keys, "_slot", F.flatten(F.collect_list("_tail").over(earlier)).alias("_carried"))
    inside = Window.partitionBy("_slot", *keys).orderBy("_item").rowsBetween(-n, -1)
    looked = same(rows.withColumn("_near", F.collect_list("_item").over(inside)), F.broadcast(carried), ["_slot", *keys])
    both = F.concat(F.coalesce(F.col("_carried"), F.array()), F.col("_near"))
    last = F.when(F.size(both) <= n, both).otherwise(F.slice(both, -n, n))
    return looked.withColumn(out, F.transform(last, lambda item: item["_payload"])).select(*df.columns, out)


def amount_percentile(df: DataFrame, key: str, amount: str, out: str = "amount_percentile") -> DataFrame:
    """Share of a key's other rows with a smaller amount (``percent_rank``; a null amount is the smallest).

    Rows are counted per key and amount, the counts summed up in order and joined back, so a key
    costs as many rows as it has different amounts and these may fill several slots.
    """
    counts = slotted(df.groupBy(key, amount).agg(F.count("*").alias("_n")), [key], [amount])
    per_slot = counts.groupBy("_slot", key).agg(F.sum("_n").alias("_in_slot"))
    by_slot = Window.partitionBy(key).orderBy("_slot")
    border = across_slots(per_slot, [key]).select(
        key, "_slot", F.sum("_in_slot").over(by_slot.rowsBetween(*BEFORE)).alias("_below"), F.sum("_in_slot").over(Window.partitionBy(key)).alias("_every"))
    inside = Window.partitionBy("_slot", key)
    placed = counts.withColumns({"_less": F.sum("_n").over(inside.orderBy(amount).rowsBetween(*BEFORE)), "_here": F.sum("_n").over(inside)})
    met = same(placed, F.broadcast(border), [key, "_slot"])
    smaller = F.coalesce("_below", F.lit(0)) + F.coalesce("_less", F.lit(0))
    others = F.coalesce("_every", "_here") - 1
    ranks = met.select(key, amount, F.when(others == 0, F.lit(0.0)).otherwise(smaller / others).alias(out))
    return same(df, ranks, [key, amount]).select(*df.columns, out)


def trailing_average(daily: DataFrame, keys: list[str], day: str, value: str, days: int = 7) -> DataFrame:
    """Each day against the mean of the ``days`` days before it, with the change in percent.

    Expects one row per key and day.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(-days, -1)
    mean = F.try_divide(F.sum(value).over(window).cast("double"), F.count(value).over(window).cast("double"))
    return daily.withColumn("trailing_mean", mean).withColumn(
        "change_pct", F.try_divide((F.col(value) - F.col("trailing_mean")) * 100.0, F.col("trailing_mean"))
    )
