import datetime as dt
import glob
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.sources.sinks import MissingTable
from millrace.streaming import state, streams
from millrace.workspace import scratch_path


def _message(i, **extra):
    return json.dumps({"transaction_id": f"T{i}", "account_id": "A", "customer_id": "C", "amount": 1, "transaction_type": "PAYMENT", **extra}).encode()


def _load(spark, path, rows):
    df = spark.createDataFrame(rows, "raw binary, position string, arrived timestamp")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def test_ingest_resumes_and_drops_repeats_across_runs(spark):
    source, good, refused, state = (scratch_path(spark, n) for n in ("src", "good", "bad", "state"))
    noon = dt.datetime(2024, 1, 1, 12)
    schema = _load(spark, source, [(_message(1), "1", noon), (_message(1), "2", noon), (b"junk", "3", noon), (b"junk", "4", noon)])

    def run():
        streams.ingest_stream(streams.file_stream(spark, source, schema), good, refused, state, "2024-01-01 12:00:00").awaitTermination()

    run()
    _load(spark, source, [(_message(1), "5", noon + dt.timedelta(minutes=10)), (_message(2), "6", noon + dt.timedelta(minutes=10))])
    run()
    run()  # nothing new
    assert sorted(r.transaction_id for r in spark.read.parquet(good).collect()) == ["T1", "T2"]
    assert spark.read.json(refused).count() == 2


def test_replayed_batch_overwrites_itself(spark):
    path = scratch_path(spark, "replay")
    df = spark.range(5)
    for _ in range(2):
        df.write.mode("overwrite").parquet(streams.batch_folder(path, 3))
    assert spark.read.parquet(path).count() == 5


def test_append_needs_an_existing_table(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(MissingTable):
        streams.append_stream(stream, "no_such_table", scratch_path(spark, "state"))


def test_windows_equal_the_batch_result(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, path = scratch_path(spark, "events"), scratch_path(spark, "out")
    events.repartitionByRange(3, "ts").write.parquet(source)
    stream = streams.file_stream(spark, source, events.schema, files_per_trigger=1)
    totals = streams.windowed(stream, "ts", [], {"n": F.count("*")}, window="1 hour", lateness="40 days")
    totals = totals.withColumn("day", F.to_date("window_start"))
    streams.summary_stream(totals, path, scratch_path(spark, "state"), ["day", "window_start"], "day").awaitTermination()
    got = {(r.window_start, r.n) for r in spark.read.parquet(path).collect()}
    batch = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(F.count("*").alias("n"))
    assert got == {(r.h, r.n) for r in batch.collect()}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(path):
    return len(glob.glob(f"{path}*/**/*.parquet", recursive=True))


class Crash(Exception):
    pass


def test_refused_messages_take_no_room_in_the_state(spark):
    source, good, refused, check = (scratch_path(spark, n) for n in ("src", "good", "bad", "state"))
    noon = dt.datetime(2024, 1, 1, 12)
    schema = _load(spark, source, [(_message(i), str(i), noon) for i in range(5)] + [(b"junk", f"j{i}", noon) for i in range(50)])
    query = streams.ingest_stream(streams.file_stream(spark, source, schema), good, refused, check, "2024-01-01 12:00:00")
    query.awaitTermination()
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in map(json.loads, (q.json for q in query.recentProgress)) if p["stateOperators"])
    assert kept == 5 and spark.read.json(refused).count() == 50


def test_turns_survive_a_crash(spark):
    table = state.TurnTable(spark, scratch_path(spark, "turns"))
    assert table.read() is None
    for batch in range(5):
        table.write(spark.range(batch, batch + 1), batch)
        assert table.newest()[0] == batch and [r.id for r in table.read().collect()] == [batch]
        assert table.newest(before=batch) == (None if batch == 0 else (batch - 1, 1 - table.newest()[1]))
    before = table.newest()[1]
    spark.range(77).write.mode("overwrite").parquet(f"{table.path}/turn{1 - before}/rows")  # rows of a batch that never finished
    assert [r.id for r in table.read().collect()] == [4]
    table.write(spark.range(9, 10), 5)
    table.write(spark.range(8, 9), 5)  # replayed
    assert [r.id for r in table.read().collect()] == [8] and [r.id for r in table.read(before=5).collect()] == [4]


def test_sales_velocity_holds_no_state(spark, sf_dir, monkeypatch):
    from millrace.workload import streams as jobs

    states, finish = [], jobs._finish

    def watched(query):
        finish(query)
        states.extend(p["stateOperators"] for p in map(json.loads, (q.json for q in query.recentProgress)))

    monkeypatch.setattr(jobs, "_finish", watched)
    assert jobs.sales_velocity(spark, sf_dir).count() > 0
    assert states and not any(states)


AT = dt.datetime(2024, 1, 31, 23)


def _sales(spark, path, rows):
    df = spark.createDataFrame([(k, None if m is None else AT + dt.timedelta(minutes=m), q) for k, m, q in rows], "k string, ts timestamp_ntz, q double")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def _velocity(spark, source, schema, path, check):
    streams.summed_windows(
        streams.file_stream(spark, source, schema), "ts", ["k"], {"n": F.count("*"), "total": F.sum("q")}, path, check, "month", "month",
    ).awaitTermination()


VELOCITY_LOADS = [
    [("a", 0, 1.0), ("a", 4, 2.0), ("a", 5, None), (None, 3, 4.0), ("b", 59, 5.0), ("b", None, 9.0)],
    [("a", 1, 8.0), ("a", 6, 3.0), (None, 0, None), ("a", 61, 1.0), ("c", -1, 7.0), ("c", -2, 7.0)],  # both windows of c end at 0, after 59 - 60
    [("a", 0, 50.0), ("a", -4, 50.0), ("b", 58, 2.0), ("a", 64, 1.0)],  # the mark is 61 - 60: the window from -5 to 0 is over
]
VELOCITY_SUMS = {
    ("a", 0): (4, 61.0), ("a", 5): (2, 3.0), (None, 0): (2, 4.0), ("b", 55): (2, 7.0), ("a", 60): (2, 2.0), ("c", -5): (2, 14.0),
}


def _velocity_rows(spark, path):
    rows = spark.read.parquet(path).collect()
    got = {(r.k, int((r.window_start - AT).total_seconds() // 60)): (r.n, r.total) for r in rows}
    assert len(got) == len(rows) and all(r.window_end - r.window_start == dt.timedelta(minutes=5) for r in rows)
    return got


def test_summed_windows_add_up_over_batches(spark):
    source, path, check = (scratch_path(spark, n) for n in ("src", "velocity", "state"))
    for load in VELOCITY_LOADS:
        schema = _sales(spark, source, load)
        _velocity(spark, source, schema, path, check)
    assert _velocity_rows(spark, path) == VELOCITY_SUMS
    assert state.TurnTable(spark, f"{path}__marks").read().collect()[0]["first"] is False
    assert {r.month for r in spark.read.parquet(path).collect()} == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}


def test_summed_windows_count_once_after_crashes(spark, monkeypatch):
    source, path, check = (scratch_path(spark, n) for n in ("src", "velocity", "state"))
    write = state.TurnTable.write

    def crashing(real):
        def crash(*args, **kwargs):
            real(*args, **kwargs)
            raise Crash
        return crash

    for load, put in zip(VELOCITY_LOADS, ("put_partitions", "merge_partitions", "merge_partitions")):
        schema = _sales(spark, source, load)
        for step in ("__own", "__marks", put) if load is not VELOCITY_LOADS[-1] else ():
            with monkeypatch.context() as m:
                if step == put:
                    m.setattr(streams, step, crashing(getattr(streams, step)))
                else:
                    m.setattr(state.TurnTable, "write", lambda t, *a: (crashing(write) if t.path.endswith(step) else write)(t, *a))
                with pytest.raises(Exception, match="Crash"):
                    _velocity(spark, source, schema, path, check)
        _velocity(spark, source, schema, path, check)
    assert _velocity_rows(spark, path) == VELOCITY_SUMS


def test_summary_is_merged_by_partition(spark):
    path = scratch_path(spark, "summary")
    schema = "day date, k string, n long"
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    want, files = {}, []
    for batch, rows in enumerate([[(d[0], "a", 1), (d[0], None, 2), (None, "a", 5)], [(d[0], "a", 3), (d[1], "a", 1)], [(d[1], "b", 7), (None, "a", 6)], [(d[2], "c", 1)]]):
        changes = spark.createDataFrame(rows, schema)
        for _ in range(2):  # the second time is a replay
            state.merge_partitions(spark, changes, path, ["day", "k"], "day", batch)
        want |= {(x, k): n for x, k, n in rows}
        assert _rows(spark.read.schema(schema).parquet(path).select("day", "k", "n")) == sorted([(x, k, n) for (x, k), n in want.items()], key=repr)
    untouched = glob.glob(f"{path}/day=2024-01-01/*.parquet")
    for batch in range(4, 9):
        state.merge_partitions(spark, spark.createDataFrame([(d[2], "c", batch)], schema), path, ["day", "k"], "day", batch)
        files.append(_files(path))
    assert len(set(files)) == 1 and glob.glob(f"{path}/day=2024-01-01/*.parquet") == untouched


def test_summary_replay_after_a_crash_between_staging_and_table(spark, monkeypatch):
    path, schema = scratch_path(spark, "summary"), "day date, k string, n long"
    day = dt.date(2024, 1, 1)
    state.merge_partitions(spark, spark.createDataFrame([(day, "a", 1), (day, "b", 2)], schema), path, ["day", "k"], "day", 0)
    changes = spark.createDataFrame([(day, "a", 9)], schema)
    with monkeypatch.context() as m:
        def crash(self, before=None):
            raise Crash
        m.setattr(state.TurnTable, "read", crash)
        with pytest.raises(Crash):
            state.merge_partitions(spark, changes, path, ["day", "k"], "day", 1)
    for old in glob.glob(f"{path}/day=*/*.parquet"):  # the crash came while the old partition was being replaced
        open(old, "wb").close()
    state.merge_partitions(spark, changes, path, ["day", "k"], "day", 1)
    assert _rows(spark.read.schema(schema).parquet(path).select("day", "k", "n")) == [(day, "a", 9), (day, "b", 2)]


def test_loads_above_a_stored_mark(spark, monkeypatch):
    path, marks = scratch_path(spark, "loaded"), scratch_path(spark, "marks")
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at + dt.timedelta(minutes=i // 2)) for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    assert streams.load_new(df.where("id < 10"), "ts", path, marks) == 0
    with monkeypatch.context() as m:
        def crash(self, df, batch):
            raise Crash
        m.setattr(state.TurnTable, "write", crash)  # rows written, mark not
        with pytest.raises(Crash):
            streams.load_new(df.where("id < 20"), "ts", path, marks)
    assert streams.load_new(df.where("id < 30"), "ts", path, marks) == 1
    assert streams.load_new(df.where("id < 30"), "ts", path, marks) == 2  # nothing new, the mark stays
    assert streams.load_new(df, "ts", path, marks) == 3
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40))
    assert _files(marks) <= 4


def test_late_mark_is_one_row_and_replays_agree(spark):
    source, on_time, late, marks, check = (scratch_path(spark, n) for n in ("src", "ok", "late", "marks", "state"))
    at = dt.datetime(2024, 1, 1, 12)
    schema = "id int, ts timestamp_ntz"
    for load in ([(1, 0), (2, -300)], [(3, -61), (4, -59), (5, 10)], [(6, -51), (7, -49)]):
        spark.createDataFrame([(i, at + dt.timedelta(minutes=m)) for i, m in load], schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, spark.read.parquet(source).schema)
        streams.split_late(stream, "ts", on_time, late, marks, check).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(late).collect()) == [3, 6]
    assert sorted(r.id for r in spark.read.parquet(on_time).collect()) == [1, 2, 4, 5, 7]
    assert state.TurnTable(spark, marks).read().count() == 1 and _files(marks) == 4


def _brute_hits(rows, ttl):
    stored, hits = {}, {}
    for at, i, key in sorted((a, i, k) for i, k, a in rows):
        hit = key in stored and at - stored[key] < ttl
        if not hit:
            stored[key] = at
        hits[i] = hit
    return hits


@pytest.mark.parametrize("ttl", [1, 7, 100])
def test_walk_of_times(ttl):
    r = np.random.default_rng(ttl)
    times = np.sort(r.integers(0, 2000, 500))
    for stored in (None, -50, 30, 10_000):
        hits, now = streams.walk_times(times, stored, ttl)
        last, want = stored, []
        for at in times:
            want.append(last is not None and at - last < ttl)
            last = last if want[-1] else int(at)
        assert hits.tolist() == want and now == last


def _questions(spark, path, rows):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, k, base + dt.timedelta(seconds=a)) for i, k, a in rows], "id long, key string, ts timestamp")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


@pytest.mark.parametrize("held", [1_000_000, 50])
def test_reuse_stream_resumes_replays_and_expires(spark, held):
    source, out, check = (scratch_path(spark, n) for n in ("questions", "hits", "state"))
    r = random.Random(held)
    rows = sorted(((r.choice(["hot"] * 8 + ["a", "b", "once"]), r.randrange(6000)) for _ in range(900)), key=lambda x: x[1])
    rows = [(i, k, a) for i, (k, a) in enumerate(rows)]
    loads = [rows[:300], rows[300:600], rows[600:], [(900, "far", 500_000)], [(901, "far", 500_001), (902, "new", 500_002)]]
    left = []
    for load in loads:
        schema = _questions(spark, source, load)
        labels = streams.reuse_stream(streams.file_stream(spark, source, schema), "ts", "id", 300, held_rows=held)
        streams.append_batches(labels, out, check).awaitTermination()
        left.append({row["key"]["key"] for row in spark.read.format("statestore").option("stateVarName", "stored").load(check).select("key").collect()})
    got = {x.row_id: x.hit for x in spark.read.parquet(out).collect()}
    if held > 900:
        assert got == _brute_hits([x for load in loads for x in load], 300)
    assert len(got) == 903 and left[0] >= {"hot", "a", "b"} and left[-1] == {"far", "new"}


def test_a_batch_is_judged_once(spark, tmp_path):
    source, good, refused = (str(tmp_path / n) for n in ("source", "good", "refused"))
    spark.range(100).write.parquet(source)
    calls = spark.sparkContext.accumulator(0)

    def judge(batch):
        def flag(parts):
            for part in parts:
                calls.add(len(part))
                yield part.assign(odd=part["id"] % 2 == 1)
        return batch.mapInPandas(flag, "id long, odd boolean")

    query = streams.route_batches(
        streams.file_stream(spark, source, spark.read.parquet(source).schema), lambda b: (b.where("odd"), b.where("not odd")),
        good, refused, str(tmp_path / "state"), judge=judge)
    query.awaitTermination()
    assert spark.read.parquet(good).count() == spark.read.json(refused).count() == 50
    assert calls.value == 100
