"""Query-log, conversation and step-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import logs, reuse
from millrace.workload import roles
from millrace.workload.registry import register

# A logged statement per event, in SQL text that both engines can build.
STATEMENT = """CASE event_id % 14
 WHEN 0 THEN concat('SELECT * FROM `analytics.fact_transactions` WHERE customer_id = ', user_id)
 WHEN 1 THEN concat('```sql\nSELECT count(*) FROM proj.analytics.events WHERE user_id = ', user_id, ';\n```')
 WHEN 2 THEN concat('WITH t AS (SELECT 1) SELECT * FROM t JOIN analytics.dim_customer ON id = ', user_id)
 WHEN 3 THEN concat('DROP TABLE users_', user_id)
 WHEN 4 THEN concat('SELECT 1; DELETE FROM analytics.events WHERE id = ', event_id)
 WHEN 5 THEN concat('  select update_date, delete_flag from analytics.events where k = ', event_id, '  ')
 WHEN 6 THEN concat('SELECT a FROM x.y; SELECT b FROM z', user_id)
 WHEN 7 THEN concat('```\nSELECT REPLACE(name, ''a'', ''b'') FROM analytics.dim_account -- ', event_type, '\n```')
 WHEN 8 THEN concat('EXPLAIN SELECT ', event_id)
 WHEN 9 THEN concat('SELECT a FROM one JOIN two.three JOIN four.five.six JOIN one WHERE x = ', user_id, ';;')
 WHEN 10 THEN concat('GRANT SELECT ON t TO user', user_id)
 WHEN 11 THEN ''
 WHEN 12 THEN concat('SELECT ', chr(39), 'DROP', chr(39), ' AS word, ', event_id, ' FROM analytics.events')
 ELSE concat('SELECT user_id FROM analytics.events WHERE event_type = ', chr(39), event_type, chr(39), ' AND value > ', value) END"""

ALLOWED = ["analytics.events", "analytics.fact_transactions", "analytics.dim_customer"]
WORDS = ["ALTER", "CALL", "CREATE", "DELETE", "DROP", "GRANT", "INSERT", "MERGE", "REPLACE", "REVOKE", "TRUNCATE", "UPDATE"]

AUDIT_SQL = f"""WITH l AS (SELECT event_id, {STATEMENT} AS sql FROM events),
s AS (SELECT *, regexp_replace(sql, '^\\s+|\\s+$', '', 'g') AS a FROM l),
o AS (SELECT *, CASE WHEN starts_with(a, '```sql') OR starts_with(a, '```SQL') THEN substring(a, 7) WHEN starts_with(a, '```') THEN substring(a, 4) ELSE a END AS b FROM s),
k AS (SELECT event_id, sql, rtrim(regexp_replace(CASE WHEN ends_with(b, '```') THEN left(b, length(b) - 3) ELSE b END, '^\\s+|\\s+$', '', 'g'), ';') AS cleaned FROM o),
v AS (SELECT *, upper(trim(cleaned)) AS u, list_sort(list_distinct(list_transform(regexp_extract_all(cleaned, '(?i)(?:FROM|JOIN)\\s+`?([a-zA-Z0-9_.-]+)`?', 1),
  lambda n: CASE WHEN len(string_split(n, '.')) >= 3 THEN concat(string_split(n, '.')[-2], '.', string_split(n, '.')[-1]) ELSE n END))) AS tables FROM k),
e AS (SELECT event_id, cleaned, tables, CASE WHEN NOT (starts_with(u, 'SELECT') OR starts_with(u, 'WITH')) THEN concat('Only SELECT queries allowed. Got: ', substring(u, 1, 20), '...')
  {' '.join(f"WHEN regexp_matches(u, '\\b{w}\\b') THEN 'Blocked keyword detected: {w}'" for w in WORDS)}
  WHEN len(list_filter(string_split(cleaned, ';'), lambda p: trim(p) <> '')) > 1 THEN 'Multiple SQL statements not allowed' ELSE '' END AS error FROM v)
SELECT event_id, cleaned, error, error = '' AS is_valid, tables, list_filter(tables, lambda t: t NOT IN ({', '.join(repr(t) for t in ALLOWED)})) AS unknown_tables FROM e"""


@register("L1 L2 L3 F1 F2 F3 F4 F5 F6", sql=AUDIT_SQL)
def audited_statements(spark, root):
    log = roles.events(spark, root).select("event_id", F.expr(STATEMENT).alias("sql"))
    return logs.audited_statements(log, "sql", ALLOWED).drop("sql")


QUESTIONS = """SELECT event_id, ts, CASE event_id % 3 WHEN 0 THEN concat(' ', upper(event_type), ' of group ', user_id % 5) WHEN 1 THEN concat(event_type, ' of group ', user_id % 5, chr(10))
ELSE concat(event_type, ' of GROUP ', user_id % 5) END AS question FROM events"""

REUSE_SQL = f"""WITH RECURSIVE q AS ({QUESTIONS}), k AS (SELECT event_id, ts, left(sha256(regexp_replace(lower(question), '^\\s+|\\s+$', '', 'g')), 16) AS key FROM q),
w AS (SELECT key, min(ts) AS put FROM k GROUP BY 1
      UNION ALL SELECT w.key, min(k.ts) FROM w JOIN k ON k.key = w.key AND k.ts >= w.put + INTERVAL 7200 SECOND GROUP BY w.key, w.put),
m AS (SELECT k.key, min(event_id) AS event_id FROM k JOIN w ON w.key = k.key AND w.put = k.ts GROUP BY k.key, k.ts),
h AS (SELECT event_id, key, event_id NOT IN (SELECT event_id FROM m) AS hit FROM k)
"""


def question_log(spark, root):
    group = F.col("user_id") % 5
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), F.upper("event_type"), F.lit(" of group "), group))
        .when(kind == 1, F.concat("event_type", F.lit(" of group "), group, F.lit("\n")))
        .otherwise(F.concat("event_type", F.lit(" of GROUP "), group))
    )
    return roles.events(spark, root).select("event_id", "ts", text.alias("question"))


@register("L4", sql=REUSE_SQL + "SELECT * FROM h")
def reused_answers(spark, root):
    return reuse.reuse_labels(question_log(spark, root), "question", "ts", "event_id", 7200).select("event_id", "key", "hit")


@register("L5", sql=REUSE_SQL + "SELECT count(*) AS questions, count(*) FILTER (hit) AS hits, count(*) FILTER (hit) / CAST(count(*) AS DOUBLE) AS hit_rate FROM h")
def answer_hit_rate(spark, root):
    return reuse.hit_rate(reuse.reuse_labels(question_log(spark, root), "question", "ts", "event_id", 7200))


@register("L6 W10", sql="SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 5")
def retained_turns(spark, root):
    return logs.retained_turns(roles.conversations(spark, root).select("conv_id", "turn", "role"), "conv_id", "turn")


@register("L6 W11 F8 F21", sql="""SELECT conv_id, turn, coalesce(array_to_string(list(concat('Q: ', role, chr(10), 'SQL: ', substring(text, 1, 200))) OVER
(PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), chr(10)), '') AS context FROM conversations""")
def turn_context(spark, root):
    return logs.turn_context(roles.conversations(spark, root), "conv_id", "turn", "role", "text").select("conv_id", "turn", "context")


@register("L8 W12 F7 F19", sql="""WITH s AS (SELECT event_id, user_id, ts, concat(event_type, '/', CAST(json_extract_string(props, '$.k') AS INTEGER) % 2) AS k FROM events),
p AS (SELECT *, list(k) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS prev FROM s)
SELECT event_id, user_id, coalesce(len(list_filter(prev, lambda x: x = k)), 0) >= 2 AS is_loop FROM p""")
def repeated_actions(spark, root):
    steps = roles.events(spark, root).select(
        "event_id", "user_id", "ts", "event_type",
        F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("k"), (F.get_json_object("props", "$.k").cast("int") % 2).cast("string")).alias("params"),
    )
    flagged = logs.loop_flags(steps, "user_id", ["ts", "event_id"], "event_type", "params")
    return flagged.select("event_id", "user_id", "is_loop")


# A raw reply per conversation turn: bare JSON, fenced JSON, JSON inside the turn's text, or text alone.
REPLY = """CASE turn % 5
 WHEN 0 THEN concat('{"thought": "t', conv_id, '", "tool": "run_sql", "params": {"query": "SELECT ', turn, '"}, "reasoning": "because"}')
 WHEN 1 THEN concat('```json', chr(10), '{"tool": "alert", "params": {"severity": "high"}}', chr(10), '```')
 WHEN 2 THEN concat(text, ' {"thought": null, "tool": "get_schema"} ', text)
 WHEN 3 THEN concat('{"thought": "a"} and {', text)
 ELSE text END"""

REPLIES_SQL = f"""WITH r AS (SELECT conv_id, turn, {REPLY} AS raw FROM conversations),
f AS (SELECT *, regexp_replace(CASE WHEN starts_with(raw, '```json') THEN left(substring(raw, 8), length(raw) - 10) ELSE raw END, '^\\s+|\\s+$', '', 'g') AS t FROM r),
w AS (SELECT *, CASE WHEN json_valid(t) THEN t END AS whole, regexp_extract(t, '(?s)\\{{.*\\}}') AS inside FROM f),
a AS (SELECT conv_id, turn, CASE WHEN json_type(whole) = 'OBJECT' THEN whole WHEN json_valid(inside) THEN inside END AS j FROM w)
"""


@register("L7 F6 F17", sql=REPLIES_SQL + """SELECT conv_id, turn, j IS NOT NULL AS parsed,
CASE WHEN j IS NULL THEN 'Failed to parse LLM response' WHEN json_type(j, '$.thought') IS NULL THEN '' ELSE json_extract_string(j, '$.thought') END AS thought,
CASE WHEN j IS NULL OR json_type(j, '$.tool') IS NULL THEN 'DONE' ELSE json_extract_string(j, '$.tool') END AS tool,
CASE WHEN j IS NULL OR json_type(j, '$.params') IS NULL THEN '{}' ELSE CAST(json_extract(j, '$.params') AS VARCHAR) END AS params,
CASE WHEN j IS NULL THEN NULL WHEN json_type(j, '$.reasoning') IS NULL THEN '' ELSE json_extract_string(j, '$.reasoning') END AS reasoning,
CASE WHEN j IS NULL THEN 'LLM parsing failure' END AS root_cause FROM a""")
def parsed_actions(spark, root):
    replies = roles.conversations(spark, root).select("conv_id", "turn", F.expr(REPLY).alias("raw"))
    return logs.parsed_actions(replies, "raw").select("conv_id", "turn", "parsed", "thought", "tool", "params", "reasoning", "root_cause")


STEPS = """SELECT conv_id, turn + 1 AS step_number, CASE WHEN turn >= 5 THEN 'DONE' WHEN turn % 3 = 0 THEN 'run_sql' WHEN turn % 3 = 1 THEN 'get_schema' ELSE 'alert' END AS tool,
CASE conv_id % 4 WHEN 0 THEN concat('ERROR: ', text) WHEN 1 THEN concat('BigQuery error: ', text) WHEN 2 THEN CASE WHEN turn = 3 THEN 'LOOP_DETECTED: Breaking to prevent infinite repetition' ELSE text END ELSE text END AS result,
length(text) AS duration_ms FROM conversations"""


def step_log(spark, root):
    c = F.col
    tool = F.when(c("turn") >= 5, "DONE").when(c("turn") % 3 == 0, "run_sql").when(c("turn") % 3 == 1, "get_schema").otherwise("alert")
    kind = c("conv_id") % 4
    result = (
        F.when(kind == 0, F.concat(F.lit("ERROR: "), "text")).when(kind == 1, F.concat(F.lit("BigQuery error: "), "text"))
        .when((kind == 2) & (c("turn") == 3), "LOOP_DETECTED: Breaking to prevent infinite repetition").otherwise(c("text"))
    )
    return roles.conversations(spark, root).select(
        "conv_id", (c("turn") + 1).alias("step_number"), tool.alias("tool"), result.alias("result"), F.length("text").cast("bigint").alias("duration_ms")
    )


@register("L9 F8", sql=f"""WITH s AS ({STEPS}) SELECT conv_id, step_number, NOT starts_with(result, 'ERROR') AND NOT starts_with(result, 'LOOP_DETECTED') AS success,
CASE WHEN length(result) > 400 THEN concat(substring(result, 1, 400), '...') ELSE result END AS result_preview FROM s""")
def step_outcomes(spark, root):
    return logs.step_outcomes(step_log(spark, root), "result").select("conv_id", "step_number", "success", "result_preview")


@register("L9", sql=f"""WITH s AS ({STEPS}) SELECT conv_id, count(*) FILTER (NOT (starts_with(result, 'ERROR') OR starts_with(result, 'BigQuery error:') OR starts_with(result, 'LOOP_DETECTED'))) AS good,
count(*) AS steps FROM s GROUP BY 1""")
def strict_step_outcomes(spark, root):
    outcomes = logs.step_outcomes(step_log(spark, root), "result", strict=True)
    return outcomes.groupBy("conv_id").agg(F.count_if("success").alias("good"), F.count("*").alias("steps"))


@register("L10", sql=f"""WITH s AS ({STEPS}), g AS (SELECT conv_id, count(*) FILTER (tool <> 'DONE') AS steps, count(*) FILTER (tool = 'run_sql' AND NOT starts_with(result, 'LOOP_DETECTED')) AS queries,
CAST(sum(duration_ms) AS BIGINT) AS duration_ms, bool_or(tool = 'DONE') AS completed FROM s GROUP BY 1)
SELECT *, CASE WHEN completed THEN (steps + 1) * 0.05::DOUBLE ELSE 0.5::DOUBLE END AS cost_usd FROM g""")
def session_rollup(spark, root):
    return logs.session_rollup(step_log(spark, root), "conv_id", "tool", "result", "duration_ms")


@register("L11", sql=f"""WITH a AS ({STEPS}), s AS (SELECT * FROM a WHERE tool <> 'DONE'), c AS (SELECT conv_id, tool, count(*) AS n FROM s WHERE NOT starts_with(result, 'LOOP_DETECTED') GROUP BY 1, 2),
u AS (SELECT conv_id, concat('{{', string_agg(concat('"', tool, '":', n), ',' ORDER BY tool), '}}') AS tool_usage FROM c GROUP BY 1),
g AS (SELECT conv_id, count(*) FILTER (tool <> 'DONE') AS total_steps, count(*) FILTER (tool = 'run_sql' AND NOT starts_with(result, 'LOOP_DETECTED')) AS total_queries,
  CAST(sum(duration_ms) AS BIGINT) AS duration_ms, bool_or(tool = 'DONE') AS completed, max(CASE WHEN tool = 'DONE' THEN left(result, 40) END) AS summary FROM a GROUP BY 1),
l AS (SELECT conv_id, CAST((step_number - 1) // 3 AS INTEGER) AS page,
  concat('[', string_agg(concat('{{"step":', step_number, ',"tool":"', tool, '","result_length":', length(result), ',"duration_ms":', duration_ms, ',"success":', CASE WHEN starts_with(result, 'ERROR') OR starts_with(result, 'LOOP_DETECTED') THEN 'false' ELSE 'true' END, '}}'), ',' ORDER BY step_number), ']') AS steps
  FROM s GROUP BY 1, 2)
SELECT l.*, total_steps, total_queries, duration_ms, completed, CASE WHEN completed THEN (total_steps + 1) * 0.05::DOUBLE ELSE 0.5::DOUBLE END AS cost_usd, summary,
  concat('conversation ', conv_id) AS objective, coalesce(tool_usage, '{{}}') AS tool_usage FROM l JOIN g USING (conv_id) LEFT JOIN u USING (conv_id)""")
def audit_trail(spark, root):
    """Three steps to a page, so sessions run over several."""
    steps = logs.step_outcomes(step_log(spark, root), "result")
    fields = {"tool": F.col("tool"), "result_length": F.length("result"), "duration_ms": F.col("duration_ms"), "success": F.col("success")}
    return logs.audit_trail(
        steps, "conv_id", "step_number", "tool", "result", "duration_ms", fields, F.concat(F.lit("conversation "), "conv_id"), {"summary": F.left("result", F.lit(40))}, 3)


@register("L12", sql="SELECT event_id, CASE WHEN s IN ('info', 'warning', 'critical') THEN s ELSE 'info' END AS severity FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'critical' WHEN 'view' THEN 'WARNING' WHEN 'click' THEN 'warning' ELSE event_type END AS s FROM events)")
def alert_severities(spark, root):
    given = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "view", "WARNING").when(F.col("event_type") == "click", "warning").otherwise(F.col("event_type"))
    return roles.events(spark, root).select("event_id", logs.normalised_severity(given).alias("severity"))


ATTEMPTS = "SELECT conv_id, CASE WHEN turn % 3 = 0 THEN 'validation_error' WHEN turn % 3 = 1 AND conv_id % 2 = 0 THEN 'execution_error' ELSE 'ok' END AS outcome FROM conversations WHERE role = 'assistant'"


@register("L13", sql=f"""WITH a AS ({ATTEMPTS}) SELECT conv_id, count(*) AS attempts, count(*) FILTER (outcome = 'validation_error') AS validation_failures,
count(*) FILTER (outcome = 'execution_error') AS execution_failures, count(*) - 1 AS retries, count(*) FILTER (outcome = 'ok') > 0 AS answered, count(*) > 3 AS over_limit FROM a GROUP BY 1""")
def retry_accounting(spark, root):
    turn, conv = F.col("turn"), F.col("conv_id")
    outcome = F.when(turn % 3 == 0, "validation_error").when((turn % 3 == 1) & (conv % 2 == 0), "execution_error").otherwise("ok")
    attempts = roles.conversations(spark, root).where("role = 'assistant'").select("conv_id", outcome.alias("outcome"))
    return logs.retry_accounting(attempts, "conv_id", "outcome")


@register("L14", sql="SELECT doc_id, n_chars FROM documents WHERE n_chars > 5000")
def slow_calls(spark, root):
    return logs.slow_calls(roles.documents(spark, root).select("doc_id", "n_chars"), "n_chars")


@register("L14", sql="SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS calls FROM events GROUP BY 1, 2 HAVING count(*) > 5")
def users_over_call_rate(spark, root):
    return logs.over_rate(roles.events(spark, root), "user_id", "ts", "1 day", 5)
