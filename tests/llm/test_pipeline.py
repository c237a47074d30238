"""The pipeline on the smallest tables, stage by stage."""

import random

import corpus_pipeline
import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, rows int, extra string"


def _text(seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 7))) for _ in range(n))


def test_stages_on_odd_documents(spark, sf_dir):
    """Null ids, null and blank texts, repeated rows, ids with two texts, clashing columns; an empty table."""
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    texts = [(i, _text(i)) for i in range(60)] + [(None, _text(100)), (None, _text(101)), (None, _text(102) + " " + item), (3, None), (3, " "), (4, _text(4)), (4, _text(4)), (5, _text(105)),
             (70, _text(70) + " " + item)]
    docs = spark.createDataFrame([(i, t, "en", None if (i or 0) % 5 == 0 else f"s{(i or 0) % 3}", 9, 1, 2, "x") for i, t in texts], SCHEMA)
    kept = corpus_pipeline.known_language(spark, docs, sf_dir)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((i, t) for i, t in texts if (t or "").strip()), key=str)
    clean = corpus_pipeline.without_benchmark(spark, kept, sf_dir)
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(((i, t) for i, t in texts if (t or "").strip() and item not in t), key=str)
    once = corpus_pipeline.one_of_near_copies(spark, clean, sf_dir)
    assert once.where("doc_id is null").count() == 2 and once.where("doc_id = 4").count() == 3
    mixed = corpus_pipeline.mixed(spark, once, sf_dir)
    assert mixed.columns == corpus_pipeline.COLUMNS and mixed.where("doc_id is null").count() >= 2
    taken = corpus_pipeline.mixing.mix(once).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == taken
    assert corpus_pipeline.sharded(spark, mixed, sf_dir).count() == taken
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0).select(corpus_pipeline.COLUMNS), sf_dir).count() == 0


def test_stages_keep_their_promises(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = corpus_pipeline.known_language(spark, docs, sf_dir)
    assert first.count() == docs.where("text rlike '[a-zA-Z]'").count()
    second = corpus_pipeline.one_of_near_copies(spark, first, sf_dir)
    assert second.count() <= first.select("text").distinct().count() and second.columns == corpus_pipeline.COLUMNS
    third = corpus_pipeline.without_benchmark(spark, second, sf_dir)
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not [t for t in (r["text"] for r in third.collect()) if any(i in t for i in items)]


def test_run(spark, sf_dir):
    rows: pd.DataFrame = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert len(rows) and set(rows["shard"]) <= set(range(8))
