import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.jsontext import MARK, strict_variant
from millrace.operators import validate as v
from millrace.plans.daily import batch_ingest, unique_rows

GOOD = {"transaction_id": "T1", "account_id": "A1", "customer_id": "C1", "amount": 10.5, "transaction_type": "PAYMENT"}

CASES = [
    (json.dumps(GOOD), []),
    (json.dumps({**GOOD, "amount": 0}), []),
    (json.dumps({k: x for k, x in GOOD.items() if k != "account_id"}), ["Missing required field: account_id"]),
    (json.dumps({**GOOD, "customer_id": None}), ["Missing required field: customer_id"]),
    (json.dumps({**GOOD, "amount": "10"}), ["Type mismatch: amount expected number"]),
    (json.dumps({**GOOD, "amount": True}), ["Type mismatch: amount expected number"]),
    (json.dumps({**GOOD, "amount": -5}), ["Invalid amount: -5 (must be >= 0)"]),
    (json.dumps({**GOOD, "amount": -5.0}), ["Invalid amount: -5.0 (must be >= 0)"]),
    (json.dumps({**GOOD, "transaction_type": "REFUND"}), ["Invalid transaction_type: REFUND"]),
    (
        json.dumps({**GOOD, "transaction_type": None}),
        ["Missing required field: transaction_type", "Invalid transaction_type: None"],
    ),
    (json.dumps({**GOOD, "channel": 7}), ["Type mismatch: channel expected text"]),
    ("{not json", ["Unparseable message"]),
    (json.dumps(GOOD) + " x", ["Unparseable message"]),
    ("[1]", ["Unparseable message"]),
    ("", ["Unparseable message"]),
]


def test_error_lists(spark):
    rows = [(i, raw.encode()) for i, (raw, _) in enumerate(CASES)]
    checked = v.validated_messages(spark.createDataFrame(rows, "i int, raw binary"))
    found = {r.i: r.errors for r in checked.select("i", "errors").collect()}
    assert [found[i] for i in range(len(CASES))] == [expected for _, expected in CASES]


@pytest.mark.parametrize("batch", [[], ["{}"]])
def test_empty_and_blank_inputs(spark, batch):
    df = spark.createDataFrame([(x.encode(),) for x in batch], "raw binary")
    checked = v.validated_messages(df)
    assert v.valid_rows(checked).count() == 0
    assert v.dead_letters(checked, "2024-01-01").count() == len(batch)


STRICT = ['{"a":1}', "[1,2]", "3", '"x"', "null", " {} ", '{"a":1} x', '{"a":1}}', '{"a":1}]', '{"a":1}{"b":2}', '{"a":1,}', "", "{", "1, 2",
          '1}, "w": {"z": 1']


def _is_json(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_strict_json_agrees_with_a_strict_parser(spark):
    df = spark.createDataFrame([(t,) for t in STRICT], "t string")
    # A JSON null parses to a VARIANT null, which is a value and not a missing one.
    got = {r.t: r.ok for r in df.select("t", strict_variant(F.col("t")).isNotNull().alias("ok")).collect()}
    assert got == {t: _is_json(t) for t in STRICT}


def test_strict_json_is_parsed_once_and_knows_its_own_mark(spark):
    texts = [MARK, f"1,{MARK}", f"1,{MARK}] x", f'{{"a": {MARK}}}', f"{MARK}]}} x", f"[{MARK}", '{"a": 1} ,[2]', " [1]\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = df.select("t", strict_variant(F.col("t")).alias("v"))
    assert {r.t: r.ok for r in parsed.select("t", F.col("v").isNotNull().alias("ok")).collect()} == {t: _is_json(t) for t in texts}
    plan = v.parse_messages(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1 and "schemaOfVariant" not in plan


def test_enrichment(spark):
    rows = [("2024-03-05T10:00:00", 1_000_000.0), ("2024-03-05T10:00:00", 1_000_000.5), (None, None)]
    df = spark.createDataFrame(rows, "created_timestamp string, amount double")
    out = v.enrich(df, "2024-04-01T00:00:00", "pubsub_streaming").collect()
    assert [(r.created_date, r.high_value_flag) for r in out] == [
        ("2024-03-05", False), ("2024-03-05", True), ("2024-04-01", False)
    ]
    assert {r._source for r in out} == {"pubsub_streaming"}


def test_batch_ingest_keeps_dead_letters(spark):
    rows = [("T1", "A", "C", 5.0, "PAYMENT"), ("T1", "A", "C", 5.0, "PAYMENT"), ("T2", "A", None, -1.0, "X")]
    df = spark.createDataFrame(rows, "transaction_id string, account_id string, customer_id string, amount double, transaction_type string")
    good, refused = batch_ingest(df.withColumn("created_timestamp", F.lit("2024-01-01")), "2024-01-02", "batch", key="transaction_id")
    assert good.count() == 1
    errors = refused.first().errors
    assert errors == ["Missing required field: customer_id", "Invalid amount: -1.0 (must be >= 0)", "Invalid transaction_type: X"]


def test_rows_without_a_key_stay_apart(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    assert unique_rows(df, "k").count() == 3
    assert unique_rows(df.repartition(3), "k").where("k = 'a'").first().v == 2


def test_whole_records_survive(spark):
    raw = json.dumps({**GOOD, "amount": 12.345, "branch": {"id": 7, "tags": ["a"]}, "score": None, "large": 1e15})
    checked = v.validated_messages(spark.createDataFrame([(1, raw.encode()), (2, json.dumps({**GOOD, "amount": 98765432109876543210.5}).encode())], "i int, raw binary"))
    rows = {r.i: r for r in v.message_columns(v.valid_rows(checked)).collect()}
    assert rows[1].amount == 12.345 and rows[2].amount == 98765432109876543210.5 and rows[2].extra == {}
    assert {k: json.loads(x) for k, x in rows[1].extra.items()} == {"branch": {"id": 7, "tags": ["a"]}, "score": None, "large": 1e15}
    twice = v.validated_messages(spark.createDataFrame([(b'{"transaction_id": "a", "transaction_id": "b"}',)], "raw binary"))
    assert twice.first().errors == [v.PARSE_FAILED]
