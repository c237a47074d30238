"""Plan shapes the jobs rely on at scale."""

from pyspark.sql import functions as F

from millrace.functions.steps import computed_once, spread_out
from millrace.operators import ordered
from millrace.workload import load, roles


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(load()["pruned_scan"].run(spark, sf_dir))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_quantity,45.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_quality_suite_scans_once(spark, sf_dir):
    assert _plan(load()["quality_suite"].run(spark, sf_dir)).count("FileScan parquet") == 1


def test_many_null_rates_are_one_aggregate(spark, sf_dir):
    assert _plan(load()["null_rates_one_pass"].run(spark, sf_dir)).count("FileScan parquet") == 1


def test_features_read_their_input_only_to_place_it(spark, sf_dir):
    tx = roles.transactions(spark, sf_dir)
    plan = _plan(ordered.transaction_features(tx))
    assert plan.count("FileScan parquet") == 0  # the rows were written with their slots
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(_slot" in line and "customer_id" in line]
    assert wide and "hashpartitioning(customer_id" not in plan.split("BroadcastExchange")[0]


def test_derived_columns_are_not_computed_again_by_filters(spark):
    df = computed_once(spark.range(10), {"h": F.sha2(F.col("id").cast("string"), 256)}).where("h > '5'")
    assert _plan(df).count("sha2(") == 1


def test_few_input_tasks_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread_out(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores * 2)
    assert spread_out(many) is many
    shuffled = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    assert spread_out(shuffled) is shuffled
