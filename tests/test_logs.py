import pytest
from pyspark.sql import functions as F

from millrace.operators import logs

ALLOWED = ["analytics.fact_transactions"]

STATEMENTS = [
    ("SELECT * FROM analytics.fact_transactions", ""),
    ("WITH t AS (SELECT 1) SELECT * FROM t", ""),
    ("SELECT update_date, delete_flag FROM analytics.fact_transactions", ""),
    ("select 1;", ""),
    ("DROP TABLE x", "Only SELECT queries allowed. Got: DROP TABLE X..."),
    ("DELETE FROM x WHERE id = 1 AND more", "Only SELECT queries allowed. Got: DELETE FROM X WHERE ..."),
    ("SELECT 1; UPDATE x SET a = 1", "Blocked keyword detected: UPDATE"),
    ("WITH t AS (SELECT 1) INSERT INTO x SELECT * FROM t", "Blocked keyword detected: INSERT"),
    ("SELECT 1 UNION ALTER TABLE x", "Blocked keyword detected: ALTER"),
    ("SELECT 1; GRANT ALL ON x TO y", "Blocked keyword detected: GRANT"),
    ("SELECT 1; SELECT 2", "Multiple SQL statements not allowed"),
    ("SELECT 'DROP' AS word", "Blocked keyword detected: DROP"),
    ("```sql\nSELECT 1;\n```", ""),
]


def test_statement_safety(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(STATEMENTS)], "i int, sql string")
    rows = {r.i: (r.error, r.is_valid) for r in logs.audited_statements(df, "sql", ALLOWED).collect()}
    assert [rows[i] for i in range(len(STATEMENTS))] == [(e, e == "") for _, e in STATEMENTS]


def test_unknown_tables_are_reported_not_blocked(spark):
    df = spark.createDataFrame([("SELECT * FROM `p.analytics.fact_transactions` join other.t ON 1=1",)], "sql string")
    row = logs.audited_statements(df, "sql", ALLOWED).first()
    assert row.is_valid and row.tables == ["analytics.fact_transactions", "other.t"] and row.unknown_tables == ["other.t"]


@pytest.mark.parametrize("raw,tool,parsed", [
    ('{"tool": "run_sql", "params": {"query": "q"}}', "run_sql", True),
    ('```json\n{"tool": "alert"}\n```', "alert", True),
    ('I think {"tool": "get_schema"} is best', "get_schema", True),
    ("{}", "DONE", True),
    ("no json at all", "DONE", False),
    ("[1, 2]", "DONE", False),
    ('{"tool": "x"} and {broken', "x", True),
    ('{"tool": "x"} and {"tool": "y"}', "DONE", False),
    ("", "DONE", False),
])
def test_replies(spark, raw, tool, parsed):
    row = logs.parsed_actions(spark.createDataFrame([(raw,)], "raw string"), "raw").first()
    assert (row.tool, row.parsed) == (tool, parsed)
    if not parsed:
        assert row.root_cause == "LLM parsing failure" and row.params == "{}"


def test_third_occurrence_in_six_is_a_loop(spark):
    keys = ["a", "b", "a", "a", "c", "d", "e", "f", "a", "a"]
    rows = [(1, i, k, {"x": "1", "y": "2"}) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "s int, n int, tool string, params map<string,string>")
    flagged = logs.loop_flags(df, "s", ["n"], "tool", "params")
    expected, recent = [], []
    for k in keys:
        expected.append(recent.count(k) >= 2)
        recent = (recent + [k])[-6:]
    assert [r.is_loop for r in flagged.orderBy("n").collect()] == expected


def test_session_cost(spark):
    rows = [("a", "run_sql", "ok"), ("a", "DONE", ""), ("b", "run_sql", "ok"), ("b", "run_sql", "LOOP_DETECTED: x")]
    df = spark.createDataFrame(rows, "s string, tool string, result string").withColumn("ms", F.lit(10))
    got = {r.s: (r.steps, r.queries, r.completed, round(r.cost_usd, 2)) for r in logs.session_rollup(df, "s", "tool", "result", "ms").collect()}
    assert got == {"a": (1, 1, True, 0.1), "b": (2, 1, False, 0.5)}


def test_long_sessions_continue_on_further_pages(spark):
    rows = [("s", n, "run_sql", "3 rows", 10) for n in range(1, 26)] + [("t", 1, "run_sql", "LOOP_DETECTED: x", 5), ("t", 2, "get_schema", "ok", 5), ("t", 3, "DONE", "all clear", 5), ("u", 1, "DONE", "nothing", 1)]
    df = spark.createDataFrame(rows, "s string, n int, tool string, result string, ms int")
    found = logs.audit_trail(df, "s", "n", "tool", "result", "ms", {"tool": F.col("tool")}, F.concat(F.lit("why "), "s"), {"summary": F.col("result")}).collect()
    pages = {(p.s, p.page): p for p in found}
    assert sorted(pages) == [("s", 0), ("s", 1), ("s", 2), ("t", 0), ("u", 0)]
    assert {(p.total_steps, p.total_queries, p.duration_ms, p.completed, p.tool_usage, p.summary) for p in found if p.s == "s"} == {(25, 25, 250, False, '{"run_sql":25}', None)}
    assert [pages["s", i].steps.count("step") for i in range(3)] == [10, 10, 5]
    t = pages["t", 0]
    assert (t.total_steps, t.total_queries, t.completed, t.tool_usage, t.summary, t.objective) == (2, 0, True, '{"get_schema":1}', "all clear", "why t")
    assert (pages["u", 0].total_steps, pages["u", 0].steps, pages["u", 0].tool_usage) == (0, "[]", "{}")


def test_a_broken_loop_is_no_success(spark):
    df = spark.createDataFrame([("LOOP_DETECTED: x",), ("ERROR: x",), ("BigQuery error: x",), ("3 rows",)], "result string")
    assert [r.success for r in logs.step_outcomes(df, "result").collect()] == [False, False, True, True]
    assert [r.success for r in logs.step_outcomes(df, "result", strict=True).collect()] == [False, False, False, True]
