"""Analytics over query logs, conversations and step logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import jsontext
from millrace.functions.steps import computed_once, spread_out
from millrace.functions.text import action_key, clean_sql, preview, referenced_tables, sql_error, strip, without_fence
from millrace.operators.ordered import first_per_key, with_previous

COST_PER_STEP = 0.05
MAX_STEPS = 10
DONE = "DONE"
QUERY_TOOL = "run_sql"
LOOP_MARK = "LOOP_DETECTED"
LOOP_WINDOW, LOOP_REPEATS = 6, 2
KEPT_TURNS, CONTEXT_TURNS, CONTEXT_SQL = 5, 3, 200
SEVERITIES = ["info", "warning", "critical"]


# --- statements ---------------------------------------------------------------------------


def audited_statements(log: DataFrame, sql: str, allowed_tables: list[str]) -> DataFrame:
    """Cleaned statement, validity with the first error, referenced tables and those not allowed."""
    cleaned = computed_once(spread_out(log), {"cleaned": clean_sql(F.col(sql))})
    allowed = F.array(*[F.lit(t) for t in allowed_tables])
    checked = computed_once(
        cleaned, {"error": sql_error(F.col("cleaned")), "tables": referenced_tables(F.col("cleaned"))}
    )
    return checked.withColumns(
        {"is_valid": F.col("error") == "", "unknown_tables": F.array_except("tables", allowed)}
    )


def retry_accounting(attempts: DataFrame, question: str, outcome: str, most: int = 3) -> DataFrame:
    """Attempts per question by outcome; a question fails when none of its attempts worked."""
    failed_validation = F.count_if(F.col(outcome) == "validation_error")
    failed_execution = F.count_if(F.col(outcome) == "execution_error")
    worked = F.count_if(F.col(outcome) == "ok")
    return attempts.groupBy(question).agg(
        F.count("*").alias("attempts"), failed_validation.alias("validation_failures"),
        failed_execution.alias("execution_failures"), (F.count("*") - 1).alias("retries"),
        (worked > 0).alias("answered"), (F.count("*") > most).alias("over_limit"),
    )


def slow_calls(calls: DataFrame, latency_ms: str, limit_ms: float = 5000) -> DataFrame:
    return calls.where(F.col(latency_ms) > limit_ms)


def over_rate(calls: DataFrame, user: str, ts: str, window: str, limit: int) -> DataFrame:
    """Users with more than ``limit`` calls in a fixed window."""
    slot = F.window(F.col(ts), window)
    return calls.groupBy(user, slot.alias("_w")).agg(F.count("*").alias("calls")).where(F.col("calls") > limit).select(
        user, F.col("_w.start").alias("window_start"), "calls"
    )


# --- conversations ------------------------------------------------------------------------


def retained_turns(turns: DataFrame, conversation: str, turn: str, keep: int = KEPT_TURNS) -> DataFrame:
    """The last turns of each conversation."""
    return first_per_key(turns, [conversation], [F.desc(turn)], keep, "_place").drop("_place")


def turn_context(
    turns: DataFrame, conversation: str, turn: str, question: str, sql: str,
    count: int = CONTEXT_TURNS, cut: int = CONTEXT_SQL,
) -> DataFrame:
    """Questions and shortened statements of the turns before each turn, as one text."""
    line = F.concat(F.lit("Q: "), F.col(question), F.lit("\nSQL: "), F.left(F.col(sql), F.lit(cut)))
    looked = with_previous(turns, [conversation], [turn], count, line, "_before")
    return looked.withColumn("context", F.array_join("_before", "\n")).drop("_before")


# --- replies and steps --------------------------------------------------------------------

# What an unreadable reply is replaced with.
FALLBACK = {
    "thought": "Failed to parse LLM response", "tool": DONE, "params": "{}", "reasoning": None,
    "summary": "Investigation halted: LLM returned unparseable response.", "root_cause": "LLM parsing failure",
    "recommendation": "Retry or investigate manually",
}
DEFAULTS = {"thought": "", "tool": DONE, "params": "{}", "reasoning": ""}


def parsed_actions(replies: DataFrame, raw: str) -> DataFrame:
    """Action fields of raw replies: whole text, else first brace to last brace, else a fallback."""
    text = computed_once(spread_out(replies), {"_text": without_fence(F.col(raw), ("json", "JSON"))})
    inner = F.regexp_extract(F.col("_text"), r"(?s)\{.*\}", 0)
    tried = computed_once(text, {"_whole": _json_object(F.col("_text")), "_inner": inner})
    chosen = computed_once(tried, {"_action": F.coalesce(F.col("_whole"), _json_object(F.nullif(F.col("_inner"), F.lit(""))))})
    broken = F.col("_action").isNull()

    def field(name: str) -> Column:
        value = jsontext.text_at(F.col("_action"), f"$.{name}")
        if name in DEFAULTS:
            value = F.when(jsontext.is_present(F.col("_action"), f"$.{name}"), value).otherwise(DEFAULTS[name])
        return F.when(broken, F.lit(FALLBACK[name])).otherwise(value)

    return chosen.withColumns({name: field(name) for name in FALLBACK} | {"parsed": ~broken}).drop(
        "_text", "_whole", "_inner", "_action"
    )


def _json_object(col: Column) -> Column:
    value = jsontext.strict_variant(col)
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def loop_flags(steps: DataFrame, session: str, order: list[str], tool: str, params: str) -> DataFrame:
    """Marks an action already taken at least twice among the six before it.

    ``params`` is a map.
    """
    keyed = steps.withColumn("action_key", action_key(F.col(tool), F.col(params)))
    looked = with_previous(keyed, [session], order, LOOP_WINDOW, F.col("action_key"), "_recent")
    seen = F.size(F.filter("_recent", lambda k: k == F.col("action_key")))
    return looked.withColumn("is_loop", seen >= LOOP_REPEATS).drop("_recent")


def step_outcomes(steps: DataFrame, result: str, strict: bool = False) -> DataFrame:
    """Success and a preview of each result; errors and broken loops fail, with ``strict`` other error texts too."""
    failed = F.col(result).startswith("ERROR") | F.col(result).startswith(LOOP_MARK)
    if strict:
        failed = failed | F.col(result).rlike("^(BigQuery|Schema) error:")
    return steps.withColumns({"success": ~failed, "result_preview": preview(F.col(result))})


def session_rollup(
    steps: DataFrame, session: str, tool: str, result: str, duration_ms: str, max_steps: int = MAX_STEPS
) -> DataFrame:
    """Steps, executed queries, duration and cost per session.

    The closing DONE reply is no step but is paid for; an unfinished session costs the maximum.
    """
    done = F.col(tool) == DONE
    executed = (F.col(tool) == QUERY_TOOL) & ~F.col(result).startswith(LOOP_MARK)
    finished = F.coalesce(F.bool_or(done), F.lit(False))
    taken = F.count_if(~done)
    cost = F.when(finished, (taken + 1) * COST_PER_STEP).otherwise(F.lit(max_steps * COST_PER_STEP))
    return steps.groupBy(session).agg(
        taken.alias("steps"), F.count_if(executed).alias("queries"), F.sum(duration_ms).alias("duration_ms"),
        finished.alias("completed"), cost.alias("cost_usd"),
    )


def audit_trail(
    steps: DataFrame, session: str, number: str, tool: str, result: str, duration_ms: str, fields: dict[str, Column],
    objective: Column | None = None, closing: dict[str, Column] | None = None, page_size: int = MAX_STEPS,
) -> DataFrame:
    """Steps of each session as JSON, ``page_size`` to a row, beside what holds for the session as a whole.

    ``steps`` are all replies, the closing one included. Every page repeats the session's objective,
    whether it was completed, steps, queries, duration, cost and tool counts, and the ``closing`` texts
    of its last reply (summary, root cause, ...). A broken loop is a step, but its tool was not
    called. A session within the step limit gives one row, and one without any step a row with no
    steps; a longer one continues on further pages, so no row ever holds an unbounded list.
    """
    is_step = F.col(tool) != DONE
    page = F.when(is_step, F.floor((F.col(number) - 1) / page_size)).cast("int")
    entry = F.struct(F.col(number).alias("step"), *[value.alias(name) for name, value in fields.items()])
    paged = steps.select(session, page.alias("page"), F.when(is_step, entry).alias("_step"))
    listed = paged.groupBy(session, F.coalesce("page", F.lit(0)).alias("page")).agg(F.sort_array(F.collect_list("_step")).alias("_steps"))
    called = steps.where(is_step & ~F.col(result).startswith(LOOP_MARK)).groupBy(session, F.col(tool).alias("_tool")).agg(F.count("*").alias("_n"))
    counts = called.groupBy(session).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_tool", "_n")))).alias("_counts"))
    totals = session_rollup(steps, session, tool, result, duration_ms).withColumnsRenamed({"steps": "total_steps", "queries": "total_queries"})
    texts = {"objective": F.first(objective, ignorenulls=True)} if objective is not None else {}
    texts |= {name: F.max(F.when(~is_step, value)) for name, value in (closing or {}).items()}
    if texts:
        totals = totals.join(steps.groupBy(session).agg(*[value.alias(name) for name, value in texts.items()]), session)
    return listed.join(totals, session).join(counts, session, "left").select(
        session, "page", *totals.drop(session).columns, F.coalesce(F.to_json("_counts"), F.lit("{}")).alias("tool_usage"), F.to_json("_steps").alias("steps"),
    )


def normalised_severity(severity: Column) -> Column:
    return F.when(severity.isin(SEVERITIES), severity).otherwise("info")
