"""Medication adherence, dispense messages, drug interactions and report deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import jsontext
from millrace.functions.steps import computed_once, spread_out
from millrace.operators.joins import reference_pairs
from millrace.sources.tables import look_back

ADHERENT, AT_RISK = 0.80, 0.60
ROLLING_DAYS, ROLLING_LIMIT = 90, 0.85


def adherence_status(pdc: Column) -> Column:
    return F.when(pdc >= ADHERENT, "ADHERENT").when(pdc >= AT_RISK, "AT_RISK").otherwise("NON_ADHERENT")


def adherence(fills: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Proportion of days covered per patient and molecule, from supplied days alone.

    Shifting a fill moves its days but keeps their number, so the covered total is the sum of the
    supplies in the look-back period and needs no ordering.
    """
    recent = fills.where(look_back("fill_date", as_of, days))
    grouped = recent.groupBy("patient", "molecule").agg(
        F.coalesce(F.sum("days_supply"), F.lit(0)).alias("total_days_covered"),
        F.count("*").alias("total_fills"),
        F.min("fill_date").alias("first_fill_date"),
        F.max("fill_date").alias("last_fill_date"),
        F.count_distinct("pharmacy").alias("pharmacies_used"),
    )
    return _with_pdc(grouped, days)


def _with_pdc(grouped: DataFrame, days: int) -> DataFrame:
    top = F.col("total_days_covered").cast("bigint") * 20000 + days
    share = F.least(F.call_function("div", top, F.lit(2 * days)) / F.lit(10000.0), F.lit(1.0))
    return grouped.withColumns({"evaluation_period_days": F.lit(days), "pdc": share}).withColumn(
        "adherence_status", adherence_status(F.col("pdc"))
    )


def fill_days(fills: DataFrame) -> DataFrame:
    """One row per patient, molecule and day: fills of one day follow each other as one supply."""
    return fills.groupBy("patient", "molecule", "fill_date").agg(
        F.coalesce(F.sum("days_supply"), F.lit(0)).alias("days_supply")
    )


def covered_intervals(daily: DataFrame) -> DataFrame:
    """Days each fill really covers: ``[start, end)`` after earlier supply is used up.

    With ``S`` the running supply, a fill ends at ``S + max(fill - S before it)`` over the fills so
    far, which shifts a whole chain of early fills without walking it. The frame holds at most one
    row per calendar day.
    """
    so_far = Window.partitionBy("patient", "molecule").orderBy("fill_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    number = F.datediff("fill_date", F.lit("1970-01-01").cast("date"))
    summed = daily.withColumn("_s", F.sum("days_supply").over(so_far))
    end = F.col("_s") + F.max(number - (F.col("_s") - F.col("days_supply"))).over(so_far)
    return summed.withColumn("_end", end).select(
        "patient", "molecule", "fill_date", "days_supply",
        (F.col("_end") - F.col("days_supply")).cast("int").alias("start_day"), F.col("_end").cast("int").alias("end_day"),
    )


def adherence_timeline(fills: DataFrame, as_of: str, days: int = 90, history_days: int | None = None) -> DataFrame:
    """Proportion of days covered from a shifted timeline, clipped to the period.

    Fills before the period count with what is left of them. ``history_days`` bounds how far back
    they are read; by default all earlier fills are.
    """
    end = F.lit(as_of).cast("date")
    known = fills.where(F.col("fill_date") <= end)
    if history_days is not None:
        known = known.where(F.col("fill_date") >= F.date_sub(end, days + history_days))
    last = F.datediff(end, F.lit("1970-01-01").cast("date")) + 1
    first = last - days
    covered = F.greatest(F.least("end_day", last) - F.greatest("start_day", first), F.lit(0))
    grouped = (
        covered_intervals(fill_days(known))
        .groupBy("patient", "molecule")
        .agg(F.sum(covered).alias("total_days_covered"))
        .where("total_days_covered > 0")
    )
    return _with_pdc(grouped, days)


def adherence_segments(fills: DataFrame, last: str, days: int = ROLLING_DAYS, first: str | None = None) -> DataFrame:
    """Stretches of days in which the covered days of the trailing ``days`` days change evenly.

    Covered days up to a day are a sum over interval ends, +1 where supply begins and -1 where it
    ends, each times the days since. The same sum ``days`` later is taken off by mirrored ends, so
    one running sum per patient and molecule over at most four ends per fill day gives, from
    ``low`` up to ``high``, ``covered = slope * day + base``. The last stretch ends on ``last``.

    With ``first`` the stretches begin there, or at the first covered day if that is later. An
    interval whose four ends have all passed by then adds nothing to any later day, so its ends are
    not formed: what is sorted grows with the days asked for, not with the history.
    """
    zero = F.lit("1970-01-01").cast("date")
    until = F.lit(last).cast("date")
    fill_order = Window.partitionBy("patient", "molecule").orderBy("fill_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    supplied = F.col("start_day") < F.col("end_day")
    intervals = (
        covered_intervals(fill_days(fills.where(F.col("fill_date") <= until)))
        .withColumn("_own", F.min(F.when(supplied, F.col("start_day"))).over(fill_order))
        .where(supplied)
    )

    def turn(at: Column, sign: int) -> Column:
        return F.struct(at.cast("long").alias("at"), F.lit(sign).cast("long").alias("sign"))

    # A day counts as covered at its end: the sum at day d holds the ends up to d + 1.
    ends = F.array(*[
        turn(F.col(name) + shift, sign)
        for name, shift, sign in (("start_day", -1, 1), ("end_day", -1, -1), ("start_day", days - 1, -1), ("end_day", days - 1, 1))
    ])
    begins = None
    if first is not None:
        start = F.datediff(F.lit(first).cast("date"), zero)
        begins = F.greatest(F.col("_own"), start)
        # The first interval also marks where the stretches begin.
        mark = F.when(F.col("start_day") == F.col("_own"), F.array(turn(begins, 0))).otherwise(F.array())
        ends = F.concat(F.when(F.col("end_day") + (days - 1) > start, ends).otherwise(F.array()), mark)
    turns = intervals.select("patient", "molecule", F.inline(ends), *([] if begins is None else [begins.cast("long").alias("_begins")]))
    # Of ends on one day only the last row, which has them all in its sums, leads to a later day.
    so_far = Window.partitionBy("patient", "molecule").orderBy("at")
    upto = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = F.col("at") if begins is None else F.greatest("at", "_begins")
    return turns.select(
        "patient", "molecule", low.alias("low"),
        F.least(F.lead("at").over(so_far) - 1, F.datediff(until, zero).cast("long")).alias("high"),
        F.sum("sign").over(upto).alias("slope"), (-F.sum(F.col("sign") * F.col("at")).over(upto)).alias("base"),
    ).where("low <= high")


def rolling_adherence(fills: DataFrame, first: str, last: str, days: int = ROLLING_DAYS) -> DataFrame:
    """Covered share of the trailing ``days`` days, for every day between two dates.

    A patient and molecule have a row per day from the first covered day on, so a patient whose
    supply has run out is flagged on each day without cover too.
    """
    zero = F.lit("1970-01-01").cast("date")
    stretches = adherence_segments(fills, last, days, first)
    daily = stretches.withColumn("_day", F.explode(F.sequence("low", "high")))
    covered = F.col("slope") * F.col("_day") + F.col("base")
    return daily.select(
        "patient", "molecule", F.date_add(zero, F.col("_day").cast("int")).alias("day"), (covered / F.lit(float(days))).alias("rolling_pdc"),
    ).withColumn("at_risk", F.col("rolling_pdc") < ROLLING_LIMIT)


# --- dispense messages --------------------------------------------------------------------

# Field positions of a dispense message, by segment.
HL7_FIELDS = {
    "source_system": ("MSH", 2), "pharmacy_id": ("MSH", 3), "patient_hash": ("PID", 3), "drug": ("RXD", 2),
    "fill_date": ("RXD", 3), "days_supply": ("RXD", 4), "dosage_form": ("RXD", 6),
}
DISPENSE_COLUMNS = [
    "patient_hash", "ndc_code", "drug_name", "fill_date", "days_supply", "pharmacy_id", "source_system",
    "dosage_form", "message_format",
]


def message_format(raw: Column) -> Column:
    return F.when(raw.startswith("MSH|"), "HL7V2").when(F.ltrim(raw).startswith("{"), "FHIR_R4").otherwise("UNKNOWN")


def _empty_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def _hl7_row(positions: dict[str, tuple[str, int]]) -> Column:
    """One dispense from the split segments ``_MSH``, ``_PID``, ... of a message."""

    def field(name: str) -> Column:
        kind, place = positions[name]
        return F.try_element_at(F.col(f"_{kind}"), F.lit(place + 1))

    parts = F.split(field("drug"), r"\^")
    supply = field("days_supply")
    unknown = F.lit("UNKNOWN")
    return _dispense({
        "patient_hash": _empty_to_null(field("patient_hash")),
        "ndc_code": _empty_to_null(F.try_element_at(parts, F.lit(1))),
        "drug_name": F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")),
        "fill_date": F.try_to_date(_empty_to_null(field("fill_date")), "yyyyMMdd"),
        "days_supply": F.when(supply.rlike("^[0-9]+$"), F.coalesce(supply.try_cast("int"), F.lit(0))).otherwise(0),
        "pharmacy_id": F.coalesce(field("pharmacy_id"), unknown),
        "source_system": F.coalesce(field("source_system"), unknown),
        "dosage_form": F.coalesce(field("dosage_form"), F.lit("")),
        "message_format": F.lit("HL7V2"),
    })


# What is read of a dispense resource; a value of another kind is null in its own place only.
FHIR_FIELDS = (
    "struct<subject struct<reference string>, medicationCodeableConcept struct<coding array<struct<code string, display string>>>, "
    "daysSupply struct<value double>, whenHandedOver string, performer array<struct<actor struct<reference string>>>>"
)


def _fhir_row(resource: Column) -> Column:
    """One dispense from a dispense resource read as ``FHIR_FIELDS``."""

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    def last_part(value: Column) -> Column:
        return F.element_at(F.split(text(value), "/"), -1)

    coding = F.get(resource["medicationCodeableConcept"]["coding"], F.lit(0))
    return _dispense({
        "patient_hash": last_part(resource["subject"]["reference"]),
        "ndc_code": text(coding["code"]),
        "drug_name": text(coding["display"]),
        "fill_date": F.try_to_date(_empty_to_null(F.left(resource["whenHandedOver"], F.lit(10))), "yyyy-MM-dd"),
        "days_supply": F.coalesce(resource["daysSupply"]["value"].try_cast("int"), F.lit(0)),
        "pharmacy_id": last_part(F.get(resource["performer"], F.lit(0))["actor"]["reference"]),
        "source_system": F.lit(None), "dosage_form": F.lit(None),
        "message_format": F.lit("FHIR_R4"),
    })


def _dispense(fields: dict[str, Column]) -> Column:
    kinds = {"fill_date": "date", "days_supply": "int"}
    return F.struct(*[fields[c].cast(kinds.get(c, "string")).alias(c) for c in DISPENSE_COLUMNS])


def dispense_outcomes(messages: DataFrame, raw: str = "raw", positions: dict[str, tuple[str, int]] = HL7_FIELDS) -> DataFrame:
    """Every message with its ``dispenses`` (an array of one schema for both formats) or its ``reason``.

    Each message is split or parsed once, whatever its format, and good and refused messages come out
    of the same pass. A pipe-delimited message is one dispense, its last segment of a kind counting;
    without patient or drug code it is refused. A JSON message is a resource or a bundle of them;
    resources of another type are skipped. It is refused as a whole when it is not one JSON value, or
    when a bundle entry is null or a dispense has an empty list where its first coding or performer
    is looked up.
    """
    is_hl7 = F.col("_format") == "HL7V2"
    labelled = computed_once(spread_out(messages), {"_format": message_format(F.col(raw))})
    line_feeds = F.replace(F.replace(F.col(raw), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    split = computed_once(labelled, {
        "_lines": F.when(is_hl7, F.split(line_feeds, "\n")),
        "_value": F.when(F.col("_format") == "FHIR_R4", jsontext.strict_variant(F.col(raw))),
    })

    def last_of(kind: str) -> Column:
        own = F.filter("_lines", lambda s: (s == kind) | s.startswith(f"{kind}|"))
        return F.split(F.try_element_at(own, F.lit(-1)), r"\|")

    segments = sorted({kind for kind, _ in positions.values()})
    listed = computed_once(split, {"_entries": F.try_variant_get("_value", "$.entry", "array<variant>")})
    entries = F.col("_entries")
    members = F.transform(entries, lambda e: F.coalesce(F.variant_get(e, "$.resource", "variant"), e))
    single = F.array(F.coalesce(F.variant_get("_value", "$.resource", "variant"), F.col("_value")))
    nothing = F.coalesce(F.exists(entries, lambda e: e.isNull() | F.is_variant_null(e)), F.lit(False))
    dispensed = F.filter(F.coalesce(members, single), lambda r: F.try_variant_get(r, "$.resourceType", "string") == "MedicationDispense")
    cut = computed_once(listed, {
        **{f"_{k}": last_of(k) for k in segments},
        "_resources": F.transform(dispensed, lambda r: F.try_variant_get(r, "$", FHIR_FIELDS)),
        "_nothing": nothing,
    })

    def is_empty(array: Column) -> Column:
        return F.coalesce(F.size(array) == 0, F.lit(False))

    empty = F.exists("_resources", lambda r: is_empty(r["medicationCodeableConcept"]["coding"]) | is_empty(r["performer"]))
    rows = F.when(is_hl7, F.array(_hl7_row(positions))).otherwise(F.transform("_resources", _fhir_row))
    parsed = computed_once(cut, {"_rows": rows, "_empty": empty})
    reason = (
        F.when(F.col("_format") == "UNKNOWN", "unknown_format")
        .when(is_hl7 & (F.get("_rows", F.lit(0))["patient_hash"].isNull() | F.get("_rows", F.lit(0))["ndc_code"].isNull()), "missing_required_hl7_fields")
        .when(~is_hl7 & F.col("_value").isNull(), "parse_error: not one JSON value")
        .when(F.col("_nothing"), "parse_error: null entry")
        .when(F.col("_empty"), "parse_error: empty list")
    )
    judged = computed_once(parsed, {"reason": F.when(F.col(raw).isNull(), "unknown_format").otherwise(reason)})
    return judged.select(*messages.columns, F.when(F.col("reason").isNull(), F.col("_rows")).alias("dispenses"), "reason")


def judged_dispenses(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """``dispense_outcomes`` with the message kept, cut at 500, of refused rows only: what a store of them has to hold."""
    return dispense_outcomes(messages, raw).withColumn(raw, F.when(F.col("reason").isNotNull(), F.left(F.col(raw), F.lit(500))))


def route_dispenses(messages: DataFrame, raw: str = "raw", as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Unified dispenses from both formats, and dead letters with a reason (text cut at 500).

    With ``as_of`` dispenses carry it as ``_ingested_at``. Both results read one ``dispense_outcomes``;
    a caller that writes both persists or writes ``judged_dispenses`` and passes that, which is only split.
    """
    judged = "dispenses" in messages.columns and "reason" in messages.columns
    outcomes = messages if judged else dispense_outcomes(messages, raw)
    kept = [c for c in outcomes.columns if c not in (raw, "dispenses", "reason")]
    good = outcomes.where("reason IS NULL").select(*kept, F.inline("dispenses"))
    if as_of is not None:
        good = good.withColumn("_ingested_at", F.lit(as_of))
    return good, outcomes.where("reason IS NOT NULL").select(*kept, F.left(F.col(raw), F.lit(500)).alias("raw"), "reason")


# --- interactions and deadlines -------------------------------------------------------------


def drug_interactions(active: DataFrame, interactions: DataFrame, as_of: str) -> DataFrame:
    """Patients on both drugs of a known interaction, one row per pair of drug and prescriber entries.

    The pair list is applied to distinct patient codes first; names and prescribers are attached
    only for the pairs that were met.
    """
    current = active.where(F.col("therapy_end_date") >= F.lit(as_of).cast("date"))
    entries = current.select("patient", "atc_code", "drug_name", "prescriber").distinct()
    met = reference_pairs(entries, interactions, "patient", "atc_code", "drug_a", "drug_b")

    def side(letter: str) -> DataFrame:
        return entries.select(
            "patient", F.col("atc_code").alias(f"drug_{letter}"), F.col("drug_name").alias(f"drug_name_{letter}"),
            F.col("prescriber").alias(f"prescriber_{letter}"),
        )

    return (
        met.join(side("a"), ["patient", "drug_a"]).join(side("b"), ["patient", "drug_b"])
        .select(
            "patient", F.col("drug_name_a").alias("drug_a"), F.col("drug_name_b").alias("drug_b"), "severity", "description",
            "prescriber_a", "prescriber_b", F.lit(as_of).alias("detection_date"),
        )
    )


REPORT_DAYS, REPORT_WINDOW = 15, 30


def report_deadlines(events: DataFrame, as_of: str) -> DataFrame:
    """Unsubmitted reports of the last thirty days by days remaining."""
    today = F.lit(as_of).cast("date")
    remaining = F.datediff(F.date_add("event_date", REPORT_DAYS), today)
    priority = F.when(F.col("days_remaining") <= 2, "RED").when(F.col("days_remaining") <= 5, "AMBER").otherwise("GREEN")
    return (
        events.where((F.col("report_status") != "SUBMITTED") & (F.col("event_date") >= F.date_sub(today, REPORT_WINDOW)))
        .withColumn("days_remaining", remaining)
        .withColumn("sla_priority", priority)
        .orderBy("days_remaining", "event_id")
    )
