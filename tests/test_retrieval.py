import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import vectors
from millrace.operators import retrieval, vectorindex


def _vectors(spark, n, seed, key):
    rnd = np.random.RandomState(seed)
    data = rnd.randn(n, 8)
    data[n // 2 :] = data[n // 2]  # half are copies: ties everywhere
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    rows = [(i, data[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, f"{key} bigint, vector array<double>").repartition(4), data


def _brute(queries, items, k, floor):
    scores = np.round(queries @ items.T, 12)
    out = []
    for q in range(len(queries)):
        order = sorted(range(len(items)), key=lambda i: (-scores[q, i], i))[:k]
        out += [(q, i, scores[q, i], r + 1) for r, i in enumerate(order) if floor is None or scores[q, i] >= floor]
    return sorted(out)


@pytest.mark.parametrize("queries,items,per_task", [(30, 90, 1000), (30, 90, 50), (30, 90, 10)])
@pytest.mark.parametrize("floor", [None, 0.3])
def test_all_three_plans_are_exact(spark, queries, items, per_task, floor):
    q, qv = _vectors(spark, queries, 1, "q")
    i, iv = _vectors(spark, items, 2, "i")
    found = retrieval.top_matches(q, i, "q", "i", k=5, min_score=floor, queries_per_task=per_task)
    assert sorted(map(tuple, found.collect())) == _brute(qv, iv, 5, floor)


def test_floor_and_empty_sides(spark):
    q, _ = _vectors(spark, 4, 1, "q")
    i, _ = _vectors(spark, 6, 2, "i")
    assert retrieval.top_matches(q, i, "q", "i", min_score=1.01).count() == 0
    for per_task in (100, 1):
        assert retrieval.top_matches(q, i.where("i < 0"), "q", "i", queries_per_task=per_task).count() == 0
        assert retrieval.top_matches(q.where("q < 0"), i, "q", "i", queries_per_task=per_task).count() == 0


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 0.0, 0.0], [1.0, 0.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    rows = df.select(vectors.dot(F.col("a"), F.col("b")).alias("d"), vectors.cosine(F.col("a"), F.col("b")).alias("c"),
                     vectors.unit(F.col("a")).alias("u"), vectors.unit(F.col("b")).alias("z")).collect()
    assert [r.d for r in rows] == [1.0, 0.0, 0.0] and [r.c for r in rows] == [1.0, 0.0, None]
    assert rows[2].u == [0.6, 0.8] and rows[2].z == [0.0, 0.0]


def test_term_vectors_repeat_and_have_unit_length():
    a, b, c, none = retrieval.term_embedder(64)(["late parcels by region", "Late parcels, by region", "other", "..."])
    assert a == b != c and len(a) == 64 and abs(np.linalg.norm(a) - 1) < 1e-9 and not any(none)


def test_only_new_texts_are_embedded_and_each_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def embed(texts):
        seen.add(len(texts))
        return [[1.0, 0.0] for _ in texts]

    empty = spark.createDataFrame([], "key string, vector array<double>")
    old = spark.createDataFrame([("cached query",)], "text string")
    stored, _ = retrieval.embed_missing(old, empty, "text", embed, 2)
    path = retrieval_path(spark)
    stored.write.parquet(path)
    before = seen.value
    asked = spark.createDataFrame([("cached query",), ("new query",), ("new query",), ("  ",), (None,)], "text string")
    complete, flagged = retrieval.embed_missing(asked, spark.read.parquet(path), "text", embed, 2)
    assert complete.count() == 2 and complete.select("vector").collect() is not None
    rows = sorted((r.text or "", r.reused, r.rejected) for r in flagged.collect())
    assert rows == [("", False, True), ("  ", False, True), ("cached query", True, False), ("new query", False, False), ("new query", False, False)]
    assert before == 1 and seen.value - before <= 1 * 2  # one text, at most once per action


def retrieval_path(spark):
    from millrace.workspace import scratch_path

    return scratch_path(spark, "vectors")


def test_wrong_dimension_is_refused(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="expected 3 numbers, got 2"):
        retrieval.embed_column(df, "text", lambda texts: [[0.0, 1.0] for _ in texts], 3).collect()


def test_a_large_side_is_counted_without_its_vectors(spark):
    texts = spark.createDataFrame([(i, f"word {i}" if i % 3 else " ") for i in range(100)], "id long, text string")
    embedded = spark.sparkContext.accumulator(0)

    def embed(batch):
        embedded.add(len(batch))
        return [[1.0, float(len(t))] for t in batch]

    items = retrieval.embed_column(texts, "text", embed, 2, batch=7)
    assert not retrieval._fits(items, 10) and embedded.value == 0
    assert retrieval._fits(items, 100)
    found = {r.id: r.vector for r in items.collect()}
    assert found == {i: [1.0, float(len(f"word {i}"))] if i % 3 else None for i in range(100)}


def test_scores_are_formed_for_few_items_at_a_time():
    import pandas as pd

    batch = pd.DataFrame({"item_id": range(1300), "vector": [None if i < 600 else [1.0] for i in range(1300)]})
    parts = list(retrieval._slices(iter([batch, batch[:0]])))
    assert [len(p) for p in parts] == [424, 276] and list(parts[0]["item_id"]) == list(range(600, 1024))


def test_metrics(spark):
    rows = [(i < 3, 5.0, False) for i in range(10)]
    got = retrieval.reuse_metrics(spark.createDataFrame(rows, "hit boolean, latency_ms double, error boolean")).first()
    assert (got.cache_hit_rate, got.avg_latency_ms, got.error_rate) == (0.3, 5.0, 0.0)
    empty = retrieval.reuse_metrics(spark.createDataFrame([], "hit boolean, latency_ms double, error boolean")).first()
    assert (empty.total_requests, empty.cache_hit_rate, empty.avg_latency_ms, empty.error_rate) == (0, 0.0, 0.0, 0.0)


def test_confidence_declines_without_a_hit(spark):
    questions = spark.createDataFrame([(1,), (2,), (3,)], "q int")
    matches = spark.createDataFrame([(1, 9, 0.5, 1), (3, 9, 0.99, 1)], "query_id int, item_id int, score double, rank int")
    rows = {r.q: (round(r.confidence, 6), r.declined) for r in retrieval.with_confidence(questions, "q", matches).collect()}
    assert rows == {1: (0.55, False), 2: (0.0, True), 3: (1.0, False)}


def test_rendered_entries(spark):
    from millrace.sources.catalog import business_tables

    c = F.col
    args = (c("table_name"), c("description"), c("columns"), c("sample_queries"))
    rows = business_tables(spark).select("table_name", retrieval.entry_text(*args).alias("t"), retrieval.entry_context(*args).alias("x")).collect()
    assert len(rows) == 4
    for r in rows:
        assert r.t.startswith(f"Table: {r.table_name}. ") and "Columns: " in r.t
        assert "Table:" in r.x and "Columns:" in r.x


@pytest.mark.parametrize("floor", [None, 0.3])
@pytest.mark.parametrize("tile_rows,probes,per_task", [(16, 1, 7), (16, 3, 1000), (1000, 2, 5)])
def test_indexed_search_is_exact(spark, floor, tile_rows, probes, per_task):
    q, qv = _vectors(spark, 40, 1, "q")
    i, iv = _vectors(spark, 120, 2, "i")  # half of the items are one vector, spread over tiles
    index = vectorindex.build_index(i, "i", tile_rows=tile_rows)
    assert index.tiles.count() >= 120 // tile_rows
    found = vectorindex.search(index, q, "q", k=5, min_score=floor, probes=probes, queries_per_task=per_task)
    assert sorted(map(tuple, found.collect())) == _brute(qv, iv, 5, floor)


def test_index_probes_few_tiles_of_clustered_vectors(spark):
    rnd = np.random.RandomState(3)
    centres = rnd.randn(40, 16)
    data = centres[rnd.randint(40, size=3000)] + 0.15 * rnd.randn(3000, 16)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "i bigint, vector array<double>")
    index = vectorindex.build_index(rows, "i", tile_rows=64)
    truth = vectorindex.search(index, rows, "i", k=5)
    near = vectorindex.search(index, rows, "i", k=5, probes=12, exact=False)
    measured = vectorindex.recall(near, truth).first()
    assert measured["neighbours"] == 15000 and measured["recall"] >= 0.95 and index.tiles.count() >= 40


def test_index_leaves_out_unusable_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0]), (5, [None, 1.0]), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "i bigint, vector array<double>")
    index = vectorindex.build_index(df, "i")
    assert sorted(map(tuple, vectorindex.search(index, df, "i", k=2).select("query_id", "item_id", "rank").collect())) == [(1, 1, 1), (1, 6, 2), (6, 1, 2), (6, 6, 1)]
    empty = vectorindex.build_index(df.where("i < 0"), "i")
    assert vectorindex.search(empty, df, "i").count() == 0


def test_neighbouring_tiles_travel_together(spark, monkeypatch):
    i, items = _vectors(spark, 600, 5, "i")
    index = vectorindex.build_index(i, "i", tile_rows=16)
    alone = vectorindex.search(index, i, "i", k=5, queries_per_task=16)
    want = _brute(items, items, 5, None)
    monkeypatch.setattr(vectorindex, "MEETINGS", 4)
    assert vectorindex._group(38, 38, 16, 8) == 19 and vectorindex._group(38, 38, 10**6, 8) == 1
    together = vectorindex.search(index, i, "i", k=5, queries_per_task=16)
    for found in (alone, together):
        assert sorted((r.query_id, r.item_id, r.rank) for r in found.collect()) == sorted((q, j, n) for q, j, _, n in want)
