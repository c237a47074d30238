import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import governance, quality

NOW = "2024-02-01 12:00:00"


def _results(spark, *rows):
    full = [(n, "t", ok, severity, f"{n} message", 0.0, 0.0, NOW) for n, ok, severity in rows]
    return spark.createDataFrame(full, quality.RESULT_SCHEMA)


def test_gate_passes_warns_and_blocks(spark):
    assert quality.enforce(_results(spark, ("a", True, "critical"), ("b", True, "warning"))) == 0
    assert quality.enforce(_results(spark, ("a", True, "critical"), ("b", False, "warning"), ("c", False, "info"))) == 1
    with pytest.raises(quality.QualityBlocked, match="DATA QUALITY BLOCKED: 1 critical failures:\n  - a: a message"):
        quality.enforce(_results(spark, ("a", False, "critical"), ("b", False, "warning")))


def _suite(spark, rows, **settings):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, amount double")
    profile = quality.profile_by_day(df, "ts", ["amount"], {"positive": F.col("amount") < 0})
    out = quality.suite_results(profile, "t", NOW, ["amount"], ["positive"], quality.settings_for("default", **settings))
    return {r.check_name: r for r in out.collect()}


def test_fresh_data_of_this_hour_passes(spark):
    found = _suite(spark, [(dt.datetime(2024, 2, 1, 11, 30), 1.0)])
    assert found["freshness"].passed and found["freshness"].value == 0
    assert found["volume_anomaly"].passed and found["volume_anomaly"].value == 0


def test_stale_missing_and_empty_inputs(spark):
    stale = _suite(spark, [(dt.datetime(2024, 1, 31, 12), 1.0)])
    assert (stale["freshness"].passed, stale["freshness"].value) == (False, 24)
    assert not stale["volume_anomaly"].passed  # no rows today
    empty = _suite(spark, [])
    assert (empty["freshness"].value, empty["null_rate"].value) == (999, 0)


def test_volume_nulls_and_rules(spark):
    rows = [(dt.datetime(2024, 1, d, h), 1.0) for d in range(2, 32) for h in range(4 + d % 2)]
    rows += [(dt.datetime(2024, 2, 1, 1), None if i == 0 else -1.0) for i in range(40)]
    found = _suite(spark, rows)
    assert not found["volume_anomaly"].passed and found["volume_anomaly"].value > 3
    assert (found["null_rate"].value, found["null_rate"].passed) == (2.5, False)
    assert (found["business_rule_positive"].value, found["business_rule_positive"].passed) == (39, False)


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "a")], "x int, extra string")
    assert quality.schema_result(df, "t", {"x": "int"}, NOW).first().passed
    assert not quality.schema_result(df, "t", {"x": "bigint"}, NOW).first().passed
    assert not quality.schema_result(df, "t", {"y": "int"}, NOW).first().passed


def test_production_limits_are_stricter():
    assert quality.settings_for("production") == quality.SuiteSettings(4, 2.5, 0.5)
    assert quality.settings_for("dev").max_hours == 6


def test_strict_drift_keeps_anomalies_out_of_the_history(spark):
    good, odd = {"=a": 1.0, "~mean": 0.1}, {"=b": 1.0, "~mean": 0.1}
    days = [(dt.date(2024, 1, 1) + dt.timedelta(d), odd if d in (8, 9) else good) for d in range(14)]
    vectors = spark.createDataFrame([("t", d, v) for d, v in days], "table string, day date, vector map<string,double>")
    strict = {r.day.day - 1: r for r in quality.strict_drift(vectors, ["table"]).collect()}
    loose = {r.day.day - 1: r for r in quality.drift(vectors.drop("table")).collect()}
    assert [strict[d].status for d in (0, 6, 7, 8, 9, 10)] == ["LEARNING", "LEARNING", "NORMAL", "ANOMALY", "ANOMALY", "NORMAL"]
    assert strict[12].similarity == 1.0 and loose[12].similarity < 1.0


def test_row_policies(spark):
    df = spark.createDataFrame([("south", 1), ("north", 2)], "region string, v int")
    policies = {"south-team": ["south"], "finance": governance.EVERYTHING}
    seen = lambda *groups: sorted(r.v for r in governance.apply_row_policies(df, "region", policies, groups).collect())
    assert (seen("south-team"), seen("finance"), seen("other"), seen()) == ([1], [1, 2], [], [])


def test_masking(spark):
    df = spark.createDataFrame([("Ann", "AB12 3CD")], "name string, postcode string")
    masks = {"name": governance.full_mask(), "postcode": governance.prefix_mask("postcode")}
    hidden = governance.masked_columns(df, masks, governance.member(["boss"], F.lit("clerk"))).first()
    shown = governance.masked_columns(df, masks, governance.member(["boss"], F.lit("boss"))).first()
    assert tuple(hidden) == ("MASKED", "AB1 ***") and tuple(shown) == ("Ann", "AB12 3CD")


def test_lineage_survives_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "source string, target string")
    roots = spark.createDataFrame([("a",), ("z",)], "root string")
    reach = governance.lineage_reach(edges, roots)
    assert sorted(map(tuple, reach.collect())) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 3)]
    assert governance.lineage_reach(edges, spark.createDataFrame([("z",)], "root string")).count() == 0


def test_generated_query_audit_cuts_the_statement(spark):
    df = spark.createDataFrame([("u", "q?", "S" * 300, ["a.b", "c.d"], "t")], "u string, q string, s string, tabs array<string>, t string")
    row = governance.ai_query_audit(df, "u", "q", "s", "tabs", "t").first()
    assert row.resource == "a.b, c.d" and row.details == "Question: q? | SQL: " + "S" * 200


def test_lineage_reaches_beyond_ten_levels(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(15)], "source string, target string")
    reach = governance.lineage_reach(edges, spark.createDataFrame([("n0",)], "root string"))
    assert {(r["node"], r["depth"]) for r in reach.collect()} == {(f"n{i}", i) for i in range(1, 16)}


def test_a_new_category_lowers_the_similarity_of_its_day(spark):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(d), "a" if i % 2 else None, 1.0) for d in range(12) for i in range(10)]
    rows += [(start + dt.timedelta(10), "never seen", 1.0)] * 40
    vectors = quality.day_vectors(spark.createDataFrame(rows, "d date, kind string, v double"), "d", "kind", "v", 100.0)
    assert vectors.where("day = '2024-01-11'").first()["vector"]["=never seen"] == 0.8
    found = {r.day.day - 1: r for r in quality.drift(vectors).collect()}
    assert found[9].similarity == 1.0 and found[10].status == "ANOMALY" and found[10].similarity < 0.3 and found[11].similarity > 0.85


def test_drift_and_volume_of_tables_side_by_side(spark):
    start = dt.date(2024, 1, 1)
    rows = [(t, start + dt.timedelta(d), "a" if t == "x" or d < 9 else "b", 1.0) for t in "xy" for d in range(10) for _ in range(5)]
    df = spark.createDataFrame(rows, "t string, d date, kind string, v double")
    found = {(r.t, r.day.day - 1): r.status for r in quality.drift(quality.day_vectors(df, "d", "kind", "v", 100.0, ["t"]), ["t"]).collect()}
    assert found[("x", 9)] == "NORMAL" and found[("y", 9)] == "ANOMALY" and found[("y", 3)] == "LEARNING"
    daily = spark.createDataFrame([(t, start + dt.timedelta(d), (d % 2) + (50 if t == "y" and d == 9 else 1)) for t in "xy" for d in range(10)], "t string, day date, n long")
    z = {(r.t, r.day.day - 1): r.z for r in quality.trailing_z(daily, keys=["t"]).collect()}
    assert z[("x", 9)] < 2 < z[("y", 9)]


def test_long_chains_take_few_rounds(spark, monkeypatch):
    rounds = []
    kept = governance.cut_lineage
    monkeypatch.setattr(governance, "cut_lineage", lambda df: (rounds.append(1), kept(df))[1])
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(1000)] + [("n1000", "n500"), ("n3", "n3"), ("n0", None), ("n2", "side"), ("n0", "n2")], "source string, target string")
    found = {r.node: r.depth for r in governance.lineage_reach(edges, spark.createDataFrame([("n0",), ("n0",), (None,)], "r string")).collect()}
    assert len(rounds) <= 2 * 12 and len(found) == 1001
    assert found["n1"] == 1 and found["n2"] == 1 and found["side"] == 2 and found["n1000"] == 999


def test_cycles_end(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "source string, target string")
    roots = spark.createDataFrame([("a",), ("d",), ("nowhere",)], "r string")
    assert sorted(map(tuple, governance.lineage_reach(edges, roots).collect())) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 3)]


def test_profile_reads_the_days_it_needs(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d), float(d)) for d in range(100)]
    spark.createDataFrame(rows, "ts timestamp_ntz, amount double").withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    profile = quality.profile_by_day(df, "ts", ["amount"], {}, "2024-04-01 06:00:00", "day")
    assert profile.count() == 39 and profile.agg(F.min("day")).first()[0] == dt.date(2024, 3, 2)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(ts" in plan
