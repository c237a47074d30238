"""Row validation compiled from a rule set into one column of error messages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import jsontext
from millrace.functions.steps import computed_once, spread_out

TEXT = "text"
NUMBER = "number"

# JSON kinds accepted for each declared type; DECIMAL carries its precision in the name.
KINDS = {TEXT: r"^STRING$", NUMBER: r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$"}


@dataclass(frozen=True)
class RowRules:
    """What a record must satisfy."""

    required: list[str]
    types: dict[str, str] = field(default_factory=dict)
    non_negative: list[str] = field(default_factory=list)
    domains: dict[str, list[str]] = field(default_factory=dict)


# The declared shape of a transaction message.
TRANSACTION_RULES = RowRules(
    required=["transaction_id", "account_id", "customer_id", "amount", "transaction_type"],
    types={
        "transaction_id": TEXT, "account_id": TEXT, "customer_id": TEXT, "amount": NUMBER,
        "transaction_type": TEXT, "channel": TEXT, "status": TEXT, "created_timestamp": TEXT,
    },
    non_negative=["amount"],
    domains={"transaction_type": ["TRANSFER", "PAYMENT", "WITHDRAWAL", "DEPOSIT", "LOAN_DISBURSEMENT"]},
)
CHANNELS = ["MOBILE", "WEB", "ATM", "BRANCH", "UPI"]

HIGH_VALUE = 1_000_000
PARSE_FAILED = "Unparseable message"


def parse_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Decode a message column (bytes or text) and parse it strictly, once per row.

    Adds ``record``: the VARIANT of a message that is exactly one JSON object, else null. An object
    that names a field twice has no one reading and counts as unparseable.
    """
    source = F.col(raw)
    if dict(df.dtypes)[raw] == "binary":
        source = F.decode(source, "UTF-8")
    text = spread_out(df).withColumn(raw, source)
    is_object = F.ltrim(F.col(raw), F.lit(" \t\r\n")).startswith("{")  # of a text that is one JSON value
    return computed_once(text, {"record": F.when(is_object, jsontext.strict_variant(F.col(raw)))})


def json_errors(record: DataFrame, rules: RowRules, out: str = "errors") -> DataFrame:
    """Errors of the VARIANT column ``record``, checked on the JSON kinds themselves (no coercion)."""
    names = list(dict.fromkeys([*rules.required, *rules.types, *rules.non_negative, *rules.domains]))
    shown = {n: jsontext.text_at(F.col("record"), f"$.{n}") for n in [*rules.non_negative, *rules.domains]}
    looked = computed_once(
        record,
        {
            **{f"_kind_{n}": jsontext.kind(F.col("record"), f"$.{n}") for n in names},
            **{f"_text_{n}": value for n, value in shown.items()},
        },
    )

    def kind(name: str) -> Column:
        return F.col(f"_kind_{name}")

    def text(name: str) -> Column:
        return F.col(f"_text_{name}")

    checks: list[Column] = []
    for name in rules.required:
        missing = kind(name).isNull() | (kind(name) == "VOID")
        checks.append(F.when(missing, F.lit(f"Missing required field: {name}")))
    for name, declared in rules.types.items():
        wrong = (kind(name) != "VOID") & ~kind(name).rlike(KINDS[declared])
        checks.append(F.when(wrong, F.lit(f"Type mismatch: {name} expected {declared}")))
    for name in rules.non_negative:
        number = text(name).try_cast("double")
        written = F.when(kind(name) == "BIGINT", text(name)).otherwise(number.cast("string"))
        checks.append(
            F.when(
                kind(name).rlike(KINDS[NUMBER]) & (number < 0),
                F.concat(F.lit(f"Invalid {name}: "), written, F.lit(" (must be >= 0)")),
            )
        )
    for name, allowed in rules.domains.items():
        outside = kind(name).isNotNull() & (text(name).isNull() | ~text(name).isin(allowed))
        checks.append(F.when(outside, F.concat(F.lit(f"Invalid {name}: "), F.coalesce(text(name), F.lit("None")))))
    found = F.when(F.col("record").isNull(), F.array(F.lit(PARSE_FAILED))).otherwise(_compact(checks))
    helpers = [f"_kind_{n}" for n in names] + [f"_text_{n}" for n in shown]
    return computed_once(looked, {out: found}).drop(*helpers)


def column_errors(rules: RowRules, columns: list[str]) -> Column:
    """The same rules on typed columns, where the schema already settles the types.

    A declared column that the table lacks counts as missing on every row.
    """
    checks: list[Column] = []
    for name in rules.required:
        message = F.lit(f"Missing required field: {name}")
        checks.append(F.when(F.col(name).isNull(), message) if name in columns else message)
    for name in rules.non_negative:
        if name in columns:
            shown = F.col(name).cast("string")
            checks.append(
                F.when(F.col(name) < 0, F.concat(F.lit(f"Invalid {name}: "), shown, F.lit(" (must be >= 0)")))
            )
    for name, allowed in rules.domains.items():
        if name in columns:
            outside = F.col(name).isNull() | ~F.col(name).isin(allowed)
            shown = F.coalesce(F.col(name).cast("string"), F.lit("None"))
            checks.append(F.when(outside, F.concat(F.lit(f"Invalid {name}: "), shown)))
    return _compact(checks)


def _compact(checks: list[Column]) -> Column:
    return F.filter(F.array(*checks), lambda message: message.isNotNull())


def validated_messages(df: DataFrame, rules: RowRules = TRANSACTION_RULES, raw: str = "raw") -> DataFrame:
    """Parsed messages with an ``errors`` array; a message that does not parse has one error."""
    return json_errors(parse_messages(df, raw), rules)


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0)


def dead_letters(checked: DataFrame, as_of: str, record: str = "raw") -> DataFrame:
    """Refused rows with every reason and the time of the check."""
    return checked.where(F.size("errors") > 0).select(
        F.col(record).alias("record"), "errors", F.lit(as_of).alias("timestamp")
    )


MESSAGE_TEXTS = ["transaction_id", "account_id", "customer_id", "transaction_type", "channel", "status", "created_timestamp"]


def message_columns(valid: DataFrame, texts: list[str] = MESSAGE_TEXTS, numbers: tuple[str, ...] = ("amount",)) -> DataFrame:
    """Typed columns out of validated VARIANT records; nothing of a record is lost.

    Declared texts and numbers (double) become columns, every other field goes into ``extra``, a map
    from its name to its JSON text.
    """
    record = F.col("record")
    picked = {name: jsontext.text_at(record, f"$.{name}") for name in texts}
    picked |= {name: F.try_variant_get(record, f"$.{name}", "double") for name in numbers}
    picked["extra"] = jsontext.other_fields(record, [*texts, *numbers])
    keep = [c for c in valid.columns if c not in ("record", "errors", "raw")]
    return valid.select(*keep, *[c.alias(n) for n, c in picked.items()])


def enrich(
    df: DataFrame, as_of: str, source: str, ts: str = "created_timestamp", amount: str = "amount",
    high_value: float = HIGH_VALUE,
) -> DataFrame:
    """Stamp ingestion metadata, the date key and the high-value flag (strictly above the limit)."""
    day = F.substring(F.col(ts).cast("string"), 1, 10)
    return df.withColumns(
        {
            "_ingestion_ts": F.lit(as_of),
            "_source": F.lit(source),
            "created_date": F.coalesce(day, F.lit(as_of[:10])),
            "high_value_flag": F.coalesce(F.col(amount), F.lit(0)) > high_value,
        }
    )
