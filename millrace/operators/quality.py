"""Quality checks read from one daily profile of a table, and the gate built on them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions.numbers import percent, safe_ratio

CRITICAL, WARNING, INFO = "critical", "warning", "info"
NEVER_LOADED_HOURS = 999

RESULT_SCHEMA = (
    "check_name string, table string, passed boolean, severity string, message string, "
    "value double, threshold double, checked_at string"
)


class QualityBlocked(RuntimeError):
    """At least one critical check failed."""


@dataclass(frozen=True)
class SuiteSettings:
    """Limits of the standard suite."""

    max_hours: int = 6
    z_threshold: float = 3.0
    max_null_pct: float = 1.0
    null_limits: dict[str, float] = field(default_factory=dict)
    max_violations: int = 0


# Limits per environment; production is stricter.
ENVIRONMENTS = {
    "default": SuiteSettings(),
    "production": SuiteSettings(max_hours=4, z_threshold=2.5, max_null_pct=0.5),
}


def settings_for(environment: str, **overrides) -> SuiteSettings:
    return replace(ENVIRONMENTS.get(environment, ENVIRONMENTS["default"]), **overrides)


PROFILE_DAYS = 31  # today and the thirty days it is compared with


def profile_by_day(
    df: DataFrame, ts: str, nulls: list[str], rules: dict[str, Column], as_of: str | None = None, day: str | None = None
) -> DataFrame:
    """Everything the suite needs from the table, in one pass: one row per day.

    ``rules`` name the condition of a violation. With ``as_of`` only the days the suite looks at are
    read, by a range on ``ts`` and, if the table is partitioned by a ``day`` column, on that too; a
    table without a row in them counts as never loaded.
    """
    if as_of is not None:
        first = F.date_sub(F.lit(as_of[:10]).cast("date"), PROFILE_DAYS - 1)
        df = df.where(F.col(ts) >= first.cast(dict(df.dtypes)[ts]))
        if day is not None:
            df = df.where(F.col(day) >= first)
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"),
        F.max(ts).alias("newest"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls],
        *[F.count_if(bad).alias(f"rule_{name}") for name, bad in rules.items()],
    )


def _result(name: str, table: str, passed: Column, severity: str, message: Column, value: Column, limit, as_of: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(table).alias("table"), passed.alias("passed"),
        F.lit(severity).alias("severity"), message.alias("message"), value.cast("double").alias("value"),
        F.lit(float(limit)).alias("threshold"), F.lit(as_of).alias("checked_at"),
    )


def suite_results(
    profile: DataFrame, table: str, as_of: str, nulls: list[str], rules: list[str], settings: SuiteSettings
) -> DataFrame:
    """Freshness, volume, null-rate and rule results out of a daily profile."""
    now = F.lit(as_of).cast("timestamp_ntz")
    today = F.to_date(now)
    is_today = F.col("day") == today
    before = (F.col("day") < today) & (F.col("day") >= F.date_sub(today, 30))
    facts = profile.agg(
        F.max("newest").alias("newest"),
        F.max(F.when(is_today, F.col("n"))).alias("today"),
        F.avg(F.when(before, F.col("n"))).alias("mu"),
        F.stddev_samp(F.when(before, F.col("n"))).alias("sigma"),
        *[F.coalesce(F.sum(F.when(is_today, F.col(f"null_{c}"))), F.lit(0)).alias(f"null_{c}") for c in nulls],
        *[F.coalesce(F.sum(F.when(is_today, F.col(f"rule_{r}"))), F.lit(0)).alias(f"rule_{r}") for r in rules],
    )
    delay = F.coalesce(
        F.floor(F.timestamp_diff("SECOND", F.col("newest").cast("timestamp_ntz"), now) / 3600), F.lit(NEVER_LOADED_HOURS)
    )
    z = F.coalesce(F.try_divide(F.abs(F.col("today") - F.col("mu")), F.col("sigma")), F.lit(0.0))
    results = [
        _result(
            "freshness", table, delay <= settings.max_hours, CRITICAL,
            F.format_string(f"Last update %dh ago (max: {settings.max_hours}h)", delay), delay, settings.max_hours, as_of,
        ),
        _result(
            "volume_anomaly", table, F.col("today").isNotNull() & (z <= settings.z_threshold), WARNING,
            F.when(F.col("today").isNull(), F.lit("Today: no rows")).otherwise(
                F.format_string("Today: %d rows (mean: %.0f, z: %.2f)", F.col("today"), F.coalesce("mu", F.lit(0.0)), z)
            ),
            F.round(z, 6), settings.z_threshold, as_of,
        ),
    ]
    for column in nulls:
        limit = settings.null_limits.get(column, settings.max_null_pct)
        pct = F.coalesce(percent(F.col(f"null_{column}"), F.col("today")), F.lit(0.0))
        results.append(
            _result(
                "null_rate", table, pct <= limit, CRITICAL,
                F.concat(F.lit(f"{column}: "), pct.cast("string"), F.lit(f"% null (max: {limit}%)")), pct, limit, as_of,
            )
        )
    for rule in rules:
        bad = F.col(f"rule_{rule}")
        results.append(
            _result(
                f"business_rule_{rule}", table, bad <= settings.max_violations, CRITICAL,
                F.format_string(f"{rule}: %d violations (max: {settings.max_violations})", bad), bad,
                settings.max_violations, as_of,
            )
        )
    return facts.select(F.inline(F.array(*results)))


def schema_result(df: DataFrame, table: str, expected: dict[str, str], as_of: str) -> DataFrame:
    """Missing or retyped columns fail; additional columns do not."""
    actual = dict(df.dtypes)
    missing = sorted(set(expected) - set(actual))
    retyped = {c: (t, actual[c]) for c, t in expected.items() if c in actual and actual[c] != t}
    passed = not missing and not retyped
    message = "Schema OK" if passed else f"Missing: {missing}, Mismatches: {retyped}"
    row = ("schema_validation", table, passed, CRITICAL, message, 0.0, 0.0, as_of)
    return df.sparkSession.createDataFrame([row], RESULT_SCHEMA)


def sql_rule(spark: SparkSession, table: str, name: str, query: str, as_of: str, maximum: int = 0) -> DataFrame:
    """A rule given as SQL that returns one column ``violations``."""
    bad = F.col("violations")
    return spark.sql(query).select(
        F.inline(
            F.array(
                _result(
                    f"business_rule_{name}", table, bad <= maximum, CRITICAL,
                    F.format_string(f"{name}: %d violations (max: {maximum})", bad), bad, maximum, as_of,
                )
            )
        )
    )


def verdicts(results: DataFrame) -> DataFrame:
    """Per table: critical failures, warnings and the resulting status."""
    failed = ~F.col("passed")
    counted = results.groupBy("table").agg(
        F.count("*").alias("checks"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("critical_failures"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    )
    return counted.withColumn(
        "status",
        F.when(F.col("critical_failures") > 0, "BLOCKED").when(F.col("warnings") > 0, "WARNED").otherwise("PASSED"),
    )


def enforce(results: DataFrame) -> int:
    """Raise when a critical check failed; otherwise return the number of warnings."""
    failed = results.where(~F.col("passed")).select("check_name", "message", "severity").collect()  # one row per check
    critical = [r for r in failed if r["severity"] == CRITICAL]
    if critical:
        lines = "\n".join(f"  - {r['check_name']}: {r['message']}" for r in critical)
        raise QualityBlocked(f"DATA QUALITY BLOCKED: {len(critical)} critical failures:\n{lines}")
    return sum(r["severity"] == WARNING for r in failed)


def audit_log(results: DataFrame) -> DataFrame:
    """Results under the column names of the audit table."""
    return results.select(
        F.col("check_name").alias("check"), "table", "passed", "severity", "value", "threshold", "message",
        F.col("checked_at").alias("ts"),
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null share of many columns in one pass, one row per column."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), F.col("_n").alias("rows")) for c in columns])
    return counts.select(F.inline(entries)).withColumn(
        "null_pct", F.coalesce(percent(F.col("nulls"), F.col("rows")), F.lit(0.0))
    )


def trailing_z(daily: DataFrame, day: str = "day", n: str = "n", days: int = 30, minimum: int = 2, keys: list[str] | None = None) -> DataFrame:
    """z-score of each day against the ``days`` days before it; one row per calendar day and monitored table."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*(keys or [])).orderBy(number).rangeBetween(-days, -1)
    seen = F.count(n).over(window).cast("double")
    total = F.sum(n).over(window).cast("double")
    squares = F.sum(F.col(n) * F.col(n)).over(window).cast("double")
    parts = daily.withColumns({"_c": seen, "_s": total, "_q": squares})
    variance = (F.col("_q") * F.col("_c") - F.col("_s") * F.col("_s")) / (F.col("_c") * (F.col("_c") - 1))
    sigma = F.when(F.col("_c") >= minimum, F.sqrt(variance))
    z = F.try_divide(F.abs(F.col(n) - F.col("_s") / F.nullif(F.col("_c"), F.lit(0.0))), sigma)
    return parts.withColumn("z", F.coalesce(z, F.lit(0.0))).drop("_c", "_s", "_q")


def volume_history(daily: DataFrame, threshold: float = 3.0) -> DataFrame:
    """How many days were out of line: none, a one-off, or a pattern."""
    flagged = F.count_if(F.col("z") > threshold)
    return trailing_z(daily).agg(F.count("*").alias("days"), flagged.alias("flagged_days")).withColumn(
        "verdict", F.when(F.col("flagged_days") == 0, "NORMAL").when(F.col("flagged_days") == 1, "ONE_OFF").otherwise("PATTERN")
    )


# --- content drift ------------------------------------------------------------------------

LEARNING_DAYS, HISTORY_DAYS, MIN_SIMILARITY = 7, 30, 0.75


MEAN, NULLS = "~mean", "~nulls"


def day_vectors(df: DataFrame, day: str, category: str, measure: str, scale: float, keys: list[str] | None = None) -> DataFrame:
    """One sparse vector per day: the share of every category that occurs, mean and null share of ``measure``.

    A vector is a map from the name of a dimension to its value, so a category nobody listed has a
    dimension of its own on the day it appears. Rows without a category are a category. ``keys`` name
    the monitored table or part of it.
    """
    keys = keys or []
    name = F.coalesce(F.concat(F.lit("="), F.col(category).cast("string")), F.lit("null"))
    cells = df.groupBy(*keys, F.col(day).alias("day"), name.alias("_c")).agg(
        F.count("*").alias("_n"), F.sum(F.col(measure).cast("double")).alias("_s"), F.count(measure).alias("_m"))
    days = cells.groupBy(*keys, "day").agg(
        F.collect_list(F.struct("_c", "_n")).alias("_cells"), F.sum("_n").alias("_all"), F.sum("_s").alias("_s"), F.sum("_m").alias("_m"))
    shares = F.transform(F.array_sort("_cells"), lambda c: F.struct(c["_c"], safe_ratio(c["_n"], F.col("_all"))))
    mean = F.coalesce(F.try_divide(F.col("_s"), F.col("_m").cast("double")), F.lit(0.0)) / F.lit(scale)
    rest = F.create_map(F.lit(MEAN), mean, F.lit(NULLS), safe_ratio(F.col("_all") - F.col("_m"), F.col("_all")))
    return days.select(*keys, "day", F.map_concat(F.map_from_entries(shares), rest).alias("vector"))


def sparse_cosine(a: Column, b: Column) -> Column:
    """Cosine of two maps from dimension to value; a missing dimension is 0, a zero vector gives null."""

    def added(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)

    def size(v: Column) -> Column:
        return F.sqrt(added(F.transform(F.map_values(v), lambda x: x * x)))

    dot = added(F.transform(F.map_entries(a), lambda e: e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0))))
    return F.try_divide(dot, size(a) * size(b))


def drift(vectors: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean cosine of each day to the up to thirty days before it; anomalous days stay in the history."""
    keys = keys or []
    window = Window.partitionBy(*keys).orderBy("day").rowsBetween(-HISTORY_DAYS, -1)  # one row per calendar day of a table
    looked = vectors.withColumn("_past", F.collect_list("vector").over(window))
    scores = F.transform("_past", lambda v: F.coalesce(sparse_cosine(F.col("vector"), v), F.lit(0.0)))
    mean = F.aggregate(scores, F.lit(0.0), lambda total, x: total + x) / F.size("_past")
    learning = F.size("_past") < LEARNING_DAYS
    return looked.select(
        *keys, "day",
        F.when(~learning, F.round(mean, 6)).alias("similarity"),
        F.when(learning, "LEARNING").when(mean < MIN_SIMILARITY, "ANOMALY").otherwise("NORMAL").alias("status"),
    )


def strict_drift(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """As ``drift``, but an anomalous day does not enter the history of later days.

    This is a walk from day to day, so the day rows of one monitored table (bounded by the
    calendar) go to one grouped task; different tables run side by side.
    """
    import math

    import pandas as pd

    def cosine(a: dict, b: dict) -> float:
        size = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
        return sum(x * b.get(k, 0.0) for k, x in a.items()) / size if size else 0.0

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        history: list[dict] = []
        out = []
        for _, row in pdf.sort_values("day").iterrows():
            today = dict(row["vector"])
            similarity, status = None, "LEARNING"
            if len(history) >= LEARNING_DAYS:
                past = history[-HISTORY_DAYS:]
                similarity = sum(cosine(today, p) for p in past) / len(past)
                status = "ANOMALY" if similarity < MIN_SIMILARITY else "NORMAL"
            if status != "ANOMALY":
                history.append(today)
            out.append([*[row[k] for k in keys], row["day"], None if similarity is None else round(similarity, 6), status])
        return pd.DataFrame(out, columns=[*keys, "day", "similarity", "status"])

    types = dict(vectors.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "day date", "similarity double", "status string"])
    return vectors.groupBy(*keys).applyInPandas(walk, schema)


# --- domain checks ------------------------------------------------------------------------


def implausible_dates(df: DataFrame, text: str, as_of: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Rows whose date does not parse or lies in the future, with the reason."""
    parsed = F.try_to_date(F.col(text), fmt)
    reason = F.when(parsed.isNull(), "unparsable").when(parsed > F.lit(as_of).cast("date"), "future")
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def double_dispensing(fills: DataFrame, patient: str, drug: str, day: str, pharmacy: str) -> DataFrame:
    """Same patient, drug and day at more than one pharmacy."""
    return fills.groupBy(patient, drug, day).agg(
        F.count_distinct(pharmacy).alias("pharmacies"), F.count("*").alias("fills")
    ).where("pharmacies > 1")


def outliers_by_group(df: DataFrame, group: str, value: str, threshold: float) -> DataFrame:
    """Rows whose whole-number ``value`` lies more than ``threshold`` deviations from its group's mean."""
    stats = df.groupBy(group).agg(
        F.count(value).cast("double").alias("_c"),
        F.sum(value).cast("double").alias("_s"),
        F.sum(F.col(value).cast("bigint") * F.col(value)).cast("double").alias("_q"),
    )
    variance = (F.col("_q") * F.col("_c") - F.col("_s") * F.col("_s")) / (F.col("_c") * (F.col("_c") - 1))
    stats = stats.where("_c > 1").select(group, (F.col("_s") / F.col("_c")).alias("_mean"), F.sqrt(variance).alias("_sigma"))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_sigma"))
    return df.join(stats, group).withColumn("z", z).where(F.abs("z") > threshold).drop("_mean", "_sigma")


def outside_range(df: DataFrame, ranges: DataFrame, on: str, value: str, low: str, high: str) -> DataFrame:
    """Rows whose value is outside the range its reference row allows."""
    return df.join(ranges, on).where(~F.col(value).between(F.col(low), F.col(high)))


def prescribing_outliers(rows: DataFrame, prescriber: str, drug: str) -> DataFrame:
    """z-score, per drug, of the share each prescriber gives to it."""
    cells = rows.groupBy(prescriber, drug).agg(F.count("*").alias("n"))
    totals = cells.groupBy(prescriber).agg(F.sum("n").alias("_all"))
    rates = cells.join(totals, prescriber).withColumn("rate", safe_ratio(F.col("n"), F.col("_all"))).drop("_all")
    stats = rates.groupBy(drug).agg(F.avg("rate").alias("_mean"), F.stddev_samp("rate").alias("_sigma"))
    z = F.round(F.try_divide(F.col("rate") - F.col("_mean"), F.col("_sigma")), 6)
    return rates.join(stats, drug).withColumn("z", z).drop("_mean", "_sigma")


# --- change between runs ------------------------------------------------------------------


def json_fields(df: DataFrame, raw: str) -> DataFrame:
    """Field names and kinds that occur in a JSON column."""
    from millrace.functions.jsontext import strict_variant

    fields = F.explode(F.try_variant_get(strict_variant(F.col(raw)), "$", "map<string,variant>"))
    return df.select(fields.alias("column", "value")).select(
        "column", F.regexp_replace(F.schema_of_variant("value"), r"\(.*\)", "").alias("type")
    ).distinct()


def schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added, removed and retyped columns between two ``(column, type)`` tables."""
    old = before.groupBy("column").agg(F.array_join(F.sort_array(F.collect_set("type")), "|").alias("old_type"))
    new = after.groupBy("column").agg(F.array_join(F.sort_array(F.collect_set("type")), "|").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped").otherwise("same")
    )
    return old.join(new, "column", "full_outer").withColumn("change", change).where("change <> 'same'")


def row_loss(lineage: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Consecutive stages of a lineage table where the later one wrote fewer rows."""
    first = lineage.select(
        F.col("target_table").alias("stage"), F.col("source_table").alias("from_table"), F.col("row_count").alias("rows_in")
    )
    second = lineage.select(
        F.col("source_table").alias("stage"), F.col("target_table").alias("to_table"), F.col("row_count").alias("rows_out")
    )
    loss = safe_ratio(F.col("rows_in") - F.col("rows_out"), F.col("rows_in"))
    return first.join(second, "stage").withColumn("loss", loss).where(F.col("loss") > tolerance)
