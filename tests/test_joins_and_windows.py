import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from millrace.operators import joins, ordered
from millrace.operators.reuse import reuse_labels
from millrace.sources.tables import UnfilteredScan, guarded_scan


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many of them exact copies; one key has no partner."""
    rnd = random.Random(1)
    rows = [(1, 7)] * 300 + [(1, i) for i in range(100)] + [(rnd.randrange(2, 60), i) for i in range(800)] + [(None, 1)]
    return spark.createDataFrame(rows, "k int, v int").repartition(6)


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame([(i, f"name{i}") for i in range(50)], "k int, name string")


@pytest.mark.parametrize("hot_share", [None, 0.1])
def test_salted_join_equals_plain_join(skewed, dims, hot_share):
    salted = joins.salted_join(skewed, dims, "k", 5, hot_share, limit=0)
    assert salted.columns == ["k", "v", "name"]
    assert _rows(salted) == _rows(skewed.join(dims, "k", "left"))


def test_a_small_side_is_sent_instead_of_salted(spark, skewed):
    known = spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    plan = joins.salted_join(skewed, known, "k", 5, 0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "_salt" not in plan


def test_salting_spreads_exact_copies(skewed):
    salts = skewed.where("k = 1 AND v = 7").select(joins.row_salt(["k", "v"], 5).alias("s")).distinct().count()
    assert salts > 1


def test_hot_keys_are_few(skewed):
    assert [r.k for r in joins.hot_keys(skewed, "k", 0.2).collect()] == [1]


def test_broadcast_only_within_the_limit(spark, skewed, dims):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    known = spark.range(50).withColumnRenamed("id", "k")
    assert "strategy=broadcast" in plan(joins.broadcast_join(skewed, known, "k"))
    assert "strategy=broadcast" not in plan(joins.broadcast_join(skewed, known, "k", limit=10))
    assert "strategy=broadcast" not in plan(joins.broadcast_join(skewed, dims, "k"))  # size unknown


def test_reference_pairs_keep_every_severity(spark):
    rows = spark.createDataFrame([("p", "A"), ("p", "B")], "p string, code string")
    pairs = spark.createDataFrame([("A", "B", "MINOR"), ("B", "A", "MAJOR")], "a string, b string, severity string")
    assert sorted(r["severity"] for r in joins.reference_pairs(rows, pairs, "p", "code", "a", "b").collect()) == ["MAJOR", "MINOR"]


def test_reference_pairs_ignore_stored_order(spark):
    rows = spark.createDataFrame([("p", "B"), ("p", "A"), ("p", "A"), ("q", "A")], "p string, code string")
    pairs = spark.createDataFrame([("B", "A"), ("A", "B"), ("A", "C")], "a string, b string")
    assert _rows(joins.reference_pairs(rows, pairs, "p", "code", "a", "b").select("p", "a", "b")) == [("p", "A", "B")]


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c"), (1, 9, "a")], "k int, t int, v string")
    newest = ordered.latest_per_key(df, ["k"], ordered.total_order(df, F.desc("t")))
    assert _rows(newest) == [(1, 9, "b"), (2, 1, "c")]
    plan = newest._jdf.queryExecution().sparkPlan().toString()
    assert "row_number(), 1, Partial" in plan


def _transactions(spark, n=600, seed=4):
    """Two fifths of the rows are one customer's, a tenth nobody's; times tie, days differ from times, amounts miss."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        customer = rnd.choice([1, 1, 1, 1, None, *[rnd.randrange(2, 20)] * 5])
        at = None if rnd.random() < 0.05 else base + dt.timedelta(minutes=rnd.choice([0, 15, 30]) + 60 * rnd.randrange(60))
        amount = rnd.choice([None, *[float(rnd.randrange(1, 10000)) / 100] * 9])
        rows.append((i, customer, amount, at, base.date() + dt.timedelta(days=rnd.randrange(4))))
    return spark.createDataFrame(
        rows, "transaction_id int, customer_id int, amount double, created_timestamp timestamp_ntz, created_date date"
    ).repartition(5)


@pytest.fixture(params=[1, 3, 40])
def slots(spark, request):
    """Few or many slots: with 40 the large customer fills about sixteen of them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def _plain_features(tx):
    w = Window.partitionBy("customer_id")
    amount, known = F.col("amount").cast("decimal(18,2)"), F.col("customer_id").isNotNull()
    day = Window.partitionBy("customer_id", "created_date")
    return tx.select("transaction_id", *[F.when(known, c).alias(n) for n, c in {
        "running_total": F.sum(amount).over(w.orderBy("created_timestamp")).cast("double"),
        "txn_rank": F.row_number().over(w.orderBy(F.desc("created_timestamp"), F.desc("transaction_id"))).cast("long"),
        "daily_txn_count": F.count("*").over(day), "daily_total_amount": F.sum(amount).over(day).cast("double")}.items()])


def test_features_equal_plain_windows(spark, slots):
    tx = _transactions(spark)
    plain = _plain_features(tx)
    assert _rows(ordered.transaction_features(tx).select(plain.columns)) == _rows(plain)


def test_features_of_one_instant(spark, slots):
    """A third of all rows are one customer's at one time, so the time itself reaches over slots."""
    at = dt.datetime(2024, 1, 1, 5)
    rows = [(i, 1, float(i), at, at.date()) for i in range(100)] + [(i, i, 1.0, at, at.date()) for i in range(100, 250)] + [
        (i, 1, 2.0, at + dt.timedelta(hours=i), at.date()) for i in range(250, 300)]
    tx = spark.createDataFrame(rows, "transaction_id int, customer_id int, amount double, created_timestamp timestamp_ntz, created_date date").repartition(4)
    plain = _plain_features(tx)
    assert _rows(ordered.transaction_features(tx).select(plain.columns)) == _rows(plain)


def test_slots_follow_the_rows(spark, slots):
    at = dt.datetime(2024, 1, 1)
    one_key = spark.range(9000).select(F.lit(1).alias("k"), F.lit(at).alias("t"), F.col("id"))
    rest = spark.range(9000, 18000).select(F.col("id").cast("int").alias("k"), F.lit(at).alias("t"), "id")
    sizes = [r["count"] for r in ordered.slotted(one_key.unionByName(rest).repartition(6), ["k"], ["t", "id"]).groupBy("_slot").count().collect()]
    assert sum(sizes) == 18000 and max(sizes) <= 2 * 18000 / slots + 100


@pytest.mark.parametrize("n", [1, 3, 6])
def test_previous_rows_equal_a_plain_frame(spark, n, slots):
    tx = _transactions(spark)
    order = ["created_timestamp", "transaction_id"]
    frame = Window.partitionBy("customer_id").orderBy(*order).rowsBetween(-n, -1)
    line = F.coalesce(F.col("amount"), F.lit(-1.0))
    plain = tx.select("transaction_id", F.collect_list(line).over(frame).alias("before"))
    looked = ordered.with_previous(tx, ["customer_id"], order, n, line, "before")
    assert looked.columns == [*tx.columns, "before"]
    assert _rows(looked.select("transaction_id", "before")) == _rows(plain)


def test_percentile_equals_percent_rank(spark, slots):
    tx = _transactions(spark).withColumn("amount", F.when(F.col("transaction_id") % 40 == 0, float("nan")).otherwise(F.round("amount", 0)))
    plain = tx.select("transaction_id", F.percent_rank().over(Window.partitionBy("customer_id").orderBy("amount")).alias("p"))
    assert _rows(ordered.amount_percentile(tx, "customer_id", "amount", "p").select("transaction_id", "p")) == _rows(plain)


def test_rows_without_customer_or_time(spark):
    at = dt.datetime(2024, 1, 1, 5)
    rows = [(1, None, 1.0, at, at.date()), (2, 5, 2.0, None, None), (3, 5, 3.0, at, at.date()), (4, 5, 4.0, at, at.date())]
    tx = spark.createDataFrame(
        rows, "transaction_id int, customer_id int, amount double, created_timestamp timestamp_ntz, created_date date"
    )
    found = {
        r.transaction_id: (r.running_total, r.txn_rank, r.daily_txn_count, r.daily_total_amount)
        for r in ordered.transaction_features(tx).collect()
    }
    assert found == {1: (None,) * 4, 2: (2.0, 3, 1, 2.0), 3: (9.0, 2, 2, 7.0), 4: (9.0, 1, 2, 7.0)}


def _walk(rows, ttl):
    """The rule itself: one question after the other."""
    stored, hits = {}, {}
    for i, question, at in sorted(rows, key=lambda r: (r[2], r[0])):
        key = question.lower().strip()
        hits[i] = key in stored and (at - stored[key]).total_seconds() < ttl
        if not hits[i]:
            stored[key] = at
    return hits


@pytest.mark.parametrize("ttl,fan,short", [(300, 256, 4096), (300, 256, 0), (60, 4, 0), (60, 4, 100), (7, 3, 0), (0, 4, 0), (1000, 2, 0)])
def test_reuse_labels_equal_the_walk(spark, slots, ttl, fan, short):
    rnd = random.Random(ttl)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for text, count, span in [("hot ", 900, 20000), ("Mid", 100, 20000), ("rare", 10, 300000), ("dense", 400, 900)]:
        for _ in range(count):
            at = base + dt.timedelta(seconds=rnd.choice([rnd.randrange(span), rnd.random() * span]))
            rows.append((len(rows), text if rnd.random() < 0.5 else text.upper(), at))
    df = spark.createDataFrame(rows, "id bigint, q string, ts timestamp_ntz")
    labelled = reuse_labels(df, "q", "ts", "id", ttl, fan, short)
    assert {r.id: r.hit for r in labelled.collect()} == _walk(rows, ttl)


@pytest.mark.parametrize("gap,ttl,hit", [(59, 60, True), (60, 60, False), (299, 300, True), (1, 0, False)])
def test_time_to_live_is_strict(spark, gap, ttl, hit):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "How many?", base), (2, " how MANY? ", base + dt.timedelta(seconds=gap))]
    df = spark.createDataFrame(rows, "id bigint, q string, ts timestamp_ntz")
    assert {r.id: r.hit for r in reuse_labels(df, "q", "ts", "id", ttl).collect()} == {1: False, 2: hit}


BOUNDED = ["d = '2024-01-01'", "'2024-01-01' <= d", "d between '2024-01-01' and '2024-01-02'", "d in ('2024-01-01', '2024-01-02')", "v > 1 and d >= date_sub(date'2024-01-03', 2)",
           "d = '2024-01-01' or d > '2024-02-01'", "cast(d as date) = date'2024-01-01'", "D = '2024-01-01'", "not (d < '2024-01-01') and d < '2024-03-01'"]
UNBOUNDED = ["v > 0", "d is not null", "d = d", "d = d or true", "v = 1 or d = '2024-01-01'", "'d' = 'd'", "concat('d', cast(v as string)) = 'd1'", "length(d) > 3", "other_d = '2024-01-01'", "d = other_d", "true"]


@pytest.mark.parametrize("condition,fine", [(c, True) for c in BOUNDED] + [(c, False) for c in UNBOUNDED])
def test_guarded_scan_reads_the_predicate(spark, condition, fine):
    df = spark.createDataFrame([(1, "2024-01-01", "x")], "v int, d string, other_d string")
    if fine:
        assert guarded_scan(df, "d", F.expr(condition)).columns == df.columns
    else:
        with pytest.raises(UnfilteredScan):
            guarded_scan(df, "d", F.expr(condition))


def test_guarded_scan_needs_a_condition(spark):
    df = spark.createDataFrame([(1, "2024-01-01")], "v int, day string")
    with pytest.raises(UnfilteredScan):
        guarded_scan(df, "day", None)
    assert guarded_scan(df, "day", F.col("day") == "2024-01-01").count() == 1
