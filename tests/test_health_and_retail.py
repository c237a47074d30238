import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import health, retail

HL7 = "MSH|^~\\&|ROBOT7|SITE_42||WARD9|20240115||RDS^O13|A77|P|2.5\nPID|||P_88||LIND^KAJ||19810924|F\nRXD|1|D_60^IRON 20MG^LOCAL|20240115|30|CAP|"
FHIR = '{"resourceType": "MedicationDispense", "medicationCodeableConcept": {"coding": [{"code": "12345"}]}, "subject": {"reference": "Patient/P1"}, "whenHandedOver": "2024-01-15T10:00:00Z", "daysSupply": {"value": 30}}'


def test_both_formats_give_one_schema(spark):
    raws = [HL7, FHIR, "CSV,1,2", "{broken", HL7.replace("P_88", ""), '{"resourceType": "Patient"}', "  " + FHIR, HL7.replace("|30|", "|x|")]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    good, refused = health.route_dispenses(df)
    rows = {r.i: r for r in good.collect()}
    assert set(rows) == {0, 1, 6, 7}
    assert (rows[0].patient_hash, rows[0].ndc_code, rows[0].drug_name, rows[0].days_supply) == ("P_88", "D_60", "IRON 20MG", 30)
    assert rows[0].fill_date == rows[1].fill_date == dt.date(2024, 1, 15)
    assert (rows[1].patient_hash, rows[1].ndc_code, rows[1].days_supply, rows[1].pharmacy_id) == ("P1", "12345", 30, "")
    assert rows[7].days_supply == 0
    assert {r.i: r.reason for r in refused.collect()} == {
        2: "unknown_format", 3: "parse_error: not one JSON value", 4: "missing_required_hl7_fields"
    }


def test_field_positions_can_be_set(spark):
    positions = {**health.HL7_FIELDS, "dosage_form": ("RXD", 5)}
    row = health.dispense_outcomes(spark.createDataFrame([(HL7,)], "raw string"), positions=positions).first()
    assert row.dispenses[0].dosage_form == "CAP"


def test_outcomes_of_odd_messages(spark):
    entry = '{"entry": [%s]}'
    raws = [None, entry % "null", entry % FHIR, entry % (FHIR + ", null"), FHIR.replace('[{"code": "12345"}]', "[]"), FHIR.replace('"subject"', '"performer": [], "subject"'),
            entry % '{"resource": {"resourceType": "Patient"}}', entry % (FHIR + ", " + FHIR.replace("P1", "P2")), FHIR.replace('"subject"', '"other"'), "MSH|", "{}"]
    rows = {r.i: r for r in health.dispense_outcomes(spark.createDataFrame(list(enumerate(raws)), "i int, raw string")).collect()}
    assert {i: r.reason for i, r in rows.items() if r.reason} == {
        0: "unknown_format", 1: "parse_error: null entry", 3: "parse_error: null entry", 4: "parse_error: empty list", 5: "parse_error: empty list", 9: "missing_required_hl7_fields"}
    assert [x.patient_hash for x in rows[7].dispenses] == ["P1", "P2"] and rows[8].dispenses[0].patient_hash == ""
    assert rows[6].dispenses == [] and rows[10].dispenses == [] and len(rows[2].dispenses) == 1


def test_messages_are_scanned_and_parsed_once(spark, sf_dir):
    from millrace.workload.health import dispense_messages

    path = health.dispense_outcomes(dispense_messages(spark, sf_dir)).groupBy("reason").count()._jdf.queryExecution().executedPlan().toString()
    assert path.count("FileScan parquet") == 1


def test_lapsed_patients_are_flagged_on_every_day(spark):
    rows = [(1, "m", 1, 1, dt.date(2024, 1, 1), 30), (1, "m", 1, 1, dt.date(2024, 6, 1), 10), (2, "m", 1, 1, dt.date(2024, 7, 20), 5), (3, "m", 1, 1, dt.date(2024, 1, 5), 0)]
    fills = spark.createDataFrame(rows, "patient int, molecule string, drug int, pharmacy int, fill_date date, days_supply int")
    found = {(r.patient, r.day): r for r in health.rolling_adherence(fills, "2023-12-01", "2024-07-22").collect()}
    covered = {1: {dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(30)} | {dt.date(2024, 6, 1) + dt.timedelta(i) for i in range(10)}, 2: {dt.date(2024, 7, 20) + dt.timedelta(i) for i in range(5)}}
    want = {}
    for p, days in covered.items():
        day = min(days)
        while day <= dt.date(2024, 7, 22):
            want[(p, day)] = sum(day - dt.timedelta(i) in days for i in range(90))
            day += dt.timedelta(1)
    assert {k: round(r.rolling_pdc * 90) for k, r in found.items()} == want
    assert found[(1, dt.date(2024, 5, 15))].rolling_pdc == 0.0 and found[(1, dt.date(2024, 5, 15))].at_risk


def test_long_history_leaves_no_ends_in_a_short_period(spark):
    old = [(p, "m", 1, 1, dt.date(2010, 1, 1) + dt.timedelta(60 * i), 30) for p in (1, 2) for i in range(60)]
    new = [(1, "m", 1, 1, dt.date(2024, 5, 20), 10), (1, "m", 1, 1, dt.date(2024, 6, 10), 5)]
    fills = spark.createDataFrame(old + new, "patient int, molecule string, drug int, pharmacy int, fill_date date, days_supply int")
    stretches = health.adherence_segments(fills, "2024-06-30", first="2024-06-01").collect()
    assert len([r for r in stretches if r.patient == 2]) == 1 and len(stretches) <= 8
    assert min(r.low for r in stretches) == (dt.date(2024, 6, 1) - dt.date(1970, 1, 1)).days
    found = {(r.patient, r.day): round(r.rolling_pdc * 90) for r in health.rolling_adherence(fills, "2024-06-01", "2024-06-30").collect()}
    assert len(found) == 60 and all(found[(2, dt.date(2024, 6, d))] == 0 for d in range(1, 31))
    assert [found[(1, dt.date(2024, 6, d))] for d in (1, 9, 10, 14, 30)] == [10, 10, 11, 15, 15]


def test_till_messages(spark):
    good_one = '{"store_id": "LON1", "barcode": 50012, "quantity": 1.5, "sale_price_pence": 199, "till_id": 7, "timestamp": "2024-01-01T10:00:00", "staff": {"id": 3}, "note": null}'
    raws = [good_one, good_one[:-1], "[1]", good_one.replace("199", '"x"'), good_one.replace('"LON1"', "null"), good_one.replace('"till_id": 7, ', "")]
    events = retail.till_messages(spark.createDataFrame([(i, r.encode()) for i, r in enumerate(raws)], "n int, raw binary"))
    good, refused = retail.till_sales(events, "now")
    row = good.first()
    assert good.count() == 1 and (row.n, row.barcode, row.quantity, row.sale_price_gbp, row.till_id, row.store_region) == (0, "50012", 1.5, 1.99, "7", "london")
    assert row.extra == {"staff": '{"id":3}', "note": "null"}
    assert sorted((r.record, r.reason) for r in refused.collect()) == sorted(zip(raws[1:], [
        retail.NOT_JSON, retail.NOT_JSON, "missing_fields: sale_price_pence", "missing_fields: store_id", "missing_fields: till_id"]))


@pytest.mark.parametrize("support,size", [(0.02, 3), (0.1, 4), (0.3, 2)])
def test_basket_rules_brute_force(spark, support, size):
    import itertools

    rnd = random.Random(3)
    rows = [(b, rnd.choice("aaabbcdefg")) for b in range(90) for _ in range(rnd.randrange(1, 6))] + [(None, "a"), (5, None), (200, "z")]
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = len(baskets)
    counts = {}
    for items in baskets.values():
        for k in range(1, size + 1):
            for chosen in itertools.combinations(sorted(items), k):
                counts[chosen] = counts.get(chosen, 0) + 1
    frequent = {k: c for k, c in counts.items() if c >= support * n}
    sets, total = retail.item_sets(spark.createDataFrame(rows, "b int, i string"), "b", "i", support, size)
    assert total == n and {tuple(r["items"]): r["baskets"] for r in sets.collect()} == frequent
    want = {}
    for chosen, c in frequent.items():
        for y in chosen if len(chosen) > 1 else ():
            given = tuple(x for x in chosen if x != y)
            want[(given, y)] = (c, round(c / counts[given], 9), round(c * n / (counts[given] * counts[(y,)]), 9))
    rules = retail.basket_rules(spark.createDataFrame(rows, "b int, i string"), "b", "i", support, size).collect()
    assert {(tuple(r["given"]), r["item"]): (r["baskets"], round(r["confidence"], 9), round(r["lift"], 9)) for r in rules} == want
    with pytest.raises(ValueError):
        retail.item_sets(spark.createDataFrame(rows, "b int, i string"), "b", "i", 0.0)


@pytest.mark.parametrize("seed", range(4))
def test_timeline_equals_the_recurrence(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (p, "m", 0, 0, dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(120)), rnd.randrange(1, 40))
        for p in range(6) for _ in range(rnd.randrange(1, 12))
    ]
    fills = spark.createDataFrame(rows, "patient int, molecule string, drug int, pharmacy int, fill_date date, days_supply int")
    as_of = dt.date(2024, 4, 10)
    covered = {}
    for p in range(6):
        end = None
        days = set()
        for _, _, _, _, day, supply in sorted((r for r in rows if r[0] == p), key=lambda r: r[4]):
            if day > as_of:
                continue
            start = day if end is None or day >= end else end
            end = start + dt.timedelta(supply)
            days |= {start + dt.timedelta(i) for i in range(supply)}
        inside = [d for d in days if as_of - dt.timedelta(89) <= d <= as_of]
        if inside:
            covered[p] = len(inside)
    found = health.adherence_timeline(fills, str(as_of)).collect()
    assert {r.patient: r.total_days_covered for r in found} == covered
    rolling = health.rolling_adherence(fills, str(as_of), str(as_of)).collect()
    assert all(round(r.rolling_pdc * 90) == covered[r.patient] for r in rolling)


def test_adherence_is_capped(spark):
    rows = [(1, "m", 1, 1, dt.date(2024, 3, 1), 60), (1, "m", 1, 2, dt.date(2024, 3, 2), 60), (2, "m", 1, 1, dt.date(2024, 3, 1), 60), (3, "m", 1, 1, dt.date(2024, 3, 1), None)]
    fills = spark.createDataFrame(rows, "patient int, molecule string, drug int, pharmacy int, fill_date date, days_supply int")
    got = {r.patient: (r.pdc, r.adherence_status) for r in health.adherence(fills, "2024-03-31").collect()}
    assert got == {1: (1.0, "ADHERENT"), 2: (0.6667, "AT_RISK"), 3: (0.0, "NON_ADHERENT")}


def test_deadlines(spark):
    rows = [(i, "d", dt.date(2024, 1, d), s) for i, (d, s) in enumerate([(3, "OPEN"), (6, "OPEN"), (20, "OPEN"), (3, "SUBMITTED")])]
    board = health.report_deadlines(spark.createDataFrame(rows, "event_id int, drug_name string, event_date date, report_status string"), "2024-01-16")
    assert [(r.event_id, r.days_remaining, r.sla_priority) for r in board.collect()] == [(0, 2, "RED"), (1, 5, "AMBER"), (2, 19, "GREEN")]


def test_interactions_in_any_stored_order(spark):
    active = spark.createDataFrame(
        [("p", "B01", "Warfarin", 1, dt.date(2024, 2, 1)), ("p", "N02", "Aspirin", 2, dt.date(2024, 2, 1)), ("p", "N02", "Aspirin", 2, dt.date(2024, 2, 1)),
         ("q", "B01", "Warfarin", 1, dt.date(2024, 2, 1)), ("q", "N02", "Aspirin", 2, dt.date(2023, 2, 1))],
        "patient string, atc_code string, drug_name string, prescriber int, therapy_end_date date",
    )
    pairs = spark.createDataFrame([("N02", "B01", "CRITICAL", "bleeding"), (None, "B01", "MAJOR", "x"), ("B01", "B01", "MAJOR", "y")], "drug_a string, drug_b string, severity string, description string")
    rows = health.drug_interactions(active, pairs, "2024-01-01").collect()
    assert [(r.patient, r.drug_a, r.drug_b, r.severity) for r in rows] == [("p", "Warfarin", "Aspirin", "CRITICAL")]


def test_markdown_rows_do_not_inflate_the_goods_cost(spark):
    orders = spark.createDataFrame([(1, "S", 10, 100, 5, 7, 2.0)], "supplier_id int, supplier_name string, po_number int, qty_ordered int, product_code int, store_id int, unit_cost_gbp double")
    deliveries = spark.createDataFrame([(1, 10, 95)], "supplier_id int, po_number int, qty_delivered int")
    promos = spark.createDataFrame([(1, 5, 20.0)], "supplier_id int, product_code int, promo_allowance_gbp double")
    markdowns = spark.createDataFrame([(1, 5, 7, 1.5), (1, 5, 7, 2.5)], "supplier_id int, product_code int, store_id int, markdown_claim_gbp double")
    row = retail.supplier_settlement(orders, deliveries, promos, markdowns).first()
    assert (row.goods_cost_gbp, row.promo_income_gbp, row.markdown_income_gbp, row.net_payable_gbp) == (190.0, 19.0, 4.0, 167.0)
    assert row.short_shipped_pos == 1
    bare = retail.supplier_settlement(orders, deliveries.limit(0), promos.limit(0), markdowns.limit(0)).first()
    assert (bare.goods_cost_gbp, bare.net_payable_gbp, bare.short_shipped_pos) == (0.0, 0.0, 1)


def test_till_barcodes(spark):
    rows = [("LON1", "2123456012345", 1, 199, 1, "2024-01-01T10:00:00", "P", None), ("SE99", "5000123", 1, 5, 1, "2024-01-01T10:00:00", None, None), (None, "2", 1, 5, 1, "t", None, None)]
    df = spark.createDataFrame(rows, "store_id string, barcode string, quantity int, sale_price_pence int, till_id int, timestamp string, promotion_id string, promotion_type string")
    good, refused = retail.till_sales(df, "now")
    a, b = sorted(good.collect(), key=lambda r: r.store_id)
    assert (a.product_code, a.weight_grams, a.barcode_type, a.is_promoted, a.promotion_type, a.sale_price_gbp, a.store_region) == ("123456", 1234, "WEIGHED", True, "UNKNOWN", 1.99, "london")
    assert (b.barcode_type, b.is_promoted, b.store_region) == ("EAN13", False, "south_east")
    assert refused.first().reason == "missing_fields: store_id"


def test_basket_pairs_brute_force(spark):
    rnd = random.Random(2)
    rows = [(b, rnd.randrange(6)) for b in range(80) for _ in range(4)]
    baskets = {}
    for b, i in rows:
        baskets.setdefault(b, set()).add(i)
    expected = {}
    for items in baskets.values():
        for a in items:
            for c in items:
                if a < c:
                    expected[(a, c)] = expected.get((a, c), 0) + 1
    found = retail.pair_rules(spark.createDataFrame(rows, "b int, i int"), "b", "i", 0.1).collect()
    assert {(r.item_a, r.item_b): r.baskets for r in found} == {k: n for k, n in expected.items() if n >= 8}


def test_segments_end_with_any_line_break(spark):
    raws = [HL7, HL7.replace("\n", "\r"), HL7.replace("\n", "\r\n")]
    good, refused = health.route_dispenses(spark.createDataFrame(list(enumerate(raws)), "i int, raw string"))
    assert len({(r.patient_hash, r.drug_name, r.days_supply) for r in good.collect()}) == 1
    assert good.count() == 3 and refused.isEmpty()


def test_till_message_fields_are_read_by_one_cast(spark):
    whole = {"store_id": "LON1", "barcode": 5012, "quantity": "2.5", "sale_price_pence": 100, "till_id": {"a": 1}, "timestamp": "2024-01-30T10:00:00", "lane": [1]}
    texts = [whole, {**whole, "quantity": "many"}, {**whole, "store_id": None, "till_id": None}, {**whole, "promotion_type": 3, "sale_price_pence": [1]}]
    sent = spark.createDataFrame([(i, json.dumps(t).encode()) for i, t in enumerate(texts)] + [(9, b"[1]")], "i int, raw binary")
    good, refused = retail.till_sales(retail.till_messages(sent), "2024-01-30")
    row = good.drop("record").first()
    assert (row.i, row.barcode, row.quantity, row.till_id, row.extra) == (0, "5012", 2.5, '{"a":1}', {"lane": "[1]"}) and good.count() == 1
    reasons = [r.reason for r in refused.collect()]
    assert sorted(reasons) == ["missing_fields: quantity", "missing_fields: sale_price_pence", "missing_fields: store_id, till_id", "parse_error: not one JSON object"]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(record") == 2  # the declared fields, and the others


def test_dispense_fields_of_another_kind_are_empty_in_their_place(spark):
    kind = {"resourceType": "MedicationDispense"}
    raws = [
        {**kind, "subject": 3, "medicationCodeableConcept": {"coding": ["x", {"code": "B"}]}, "daysSupply": {"value": "7"}, "performer": {"a": 1}},
        {**kind, "subject": {"reference": "Patient/P"}, "medicationCodeableConcept": {"coding": [{"code": 12}]}, "daysSupply": {"value": "x"}, "whenHandedOver": "2024-02-30"},
        {**kind, "performer": []},
    ]
    judged = health.judged_dispenses(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(raws)], "i int, raw string"))
    good, refused = health.route_dispenses(judged)
    rows = {r.i: (r.patient_hash, r.ndc_code, r.days_supply, r.fill_date, r.pharmacy_id) for r in good.collect()}
    assert rows == {0: ("", "", 7, None, ""), 1: ("P", "12", 0, None, "")}
    assert [(r.i, r.reason, r.raw) for r in refused.collect()] == [(2, "parse_error: empty list", json.dumps(raws[2]))]
    assert judged.where("reason IS NULL AND raw IS NOT NULL").isEmpty()
