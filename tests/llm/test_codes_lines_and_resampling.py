"""Vector codes, line dedup and importance resampling against brute force and on edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import linededup, resampling, vectorcodes
from millrace.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, line string, n_lines long, keep string, doc long, h1 long, rank long, score long, bucket int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 3, 4, 5, 6) for i, t in texts], SCHEMA)


@pytest.fixture(params=[1, 7, 60])
def partitions(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


# --- lines --------------------------------------------------------------------------------


def line_key(line):
    return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})


def brute_lines(texts, chars=40, docs=5):
    holders = defaultdict(set)
    for i, text in texts:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= chars:
                holders[line_key(line)].add(-math.inf if i is None else i)
    out = []
    for i, text in texts:
        me, lines = -math.inf if i is None else i, (text or "").split("\n")
        keep = [x for x in lines if not (len(line_key(x)) >= chars and len(holders[line_key(x)]) >= docs and me != max(holders[line_key(x)]))]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def line_texts():
    r = random.Random(7)
    common = [f"Shared line number {n} that is long enough to be counted" for n in range(12)]
    texts = [(None, None), (0, ""), (1, "\n\n"), (2, " \n"), (None, common[0]), (None, common[0] + "\n" + common[1])]
    for i in range(3, 120):
        lines = [r.choice(common[: 1 + i % 12]) for _ in range(r.randrange(6))] + [f"own line {i} {j} " * 4 for j in range(r.randrange(3))]
        r.shuffle(lines)
        texts.append((i, "\n".join(r.choice(["{}", " {}\t", "{}\r"]).format(r.choice([x, x.upper()])) for x in lines)))
    texts += [(i, common[2] + "\n" + common[2]) for i in range(200, 204)] + [(300, "é" * 39 + "\n" + "é" * 40), *[(301 + i, "É" * 40 + "\n" + "é" * 40) for i in range(5)]]
    texts += [(50, "another text of a repeated id\n" + common[0]), (400, common[0]), (400, common[0]), (401, "x" * 200_000 + "\n" + common[3] + "\n" * 5000)]
    return texts


@pytest.mark.parametrize("held", [1, 50_000])
def test_lines_against_brute_force(spark, partitions, held):
    texts = line_texts()
    docs = frame(spark, texts).repartition(5)
    got = linededup.kept_lines(docs, linededup.keep_bitmaps(docs, held_rows=held)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_lines(texts)


def test_line_shared_by_all_documents_spreads_over_partitions(spark, partitions):
    line = "one very common line that stands in every single document"
    texts = [(i, f"{line}\nowner {i} of a line that nobody else in here has") for i in range(900)]
    docs = frame(spark, texts).repartition(6)
    lines = linededup._occurrences(docs, "doc_id", "text", 40)
    judged = linededup._judged(lines, 5, 10).where(F.col("state") != linededup.SUMMARY).groupBy("part").count().collect()
    assert sum(r["count"] for r in judged) >= 899 - 60 and max(r["count"] for r in judged) <= 4 * 1800 / partitions + 50
    got = linededup.drop_shared_lines(docs).where("n_dropped = 0").collect()
    assert [(r["doc_id"], r["kept"]) for r in got] == [texts[-1]]


def test_runs_over_batches_and_partition_ends():
    r = random.Random(1)
    for trial in range(40):
        rows = sorted(((r.randrange(5), 0, -r.randrange(30)) for _ in range(60)), key=lambda x: x)
        rows = [(a, b, -d if d else None) for a, b, d in rows]  # null last
        cuts = sorted(r.sample(range(60), 3))
        batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows[a:b]], pa.int64()) for k in range(3)], names=["h1", "h2", "doc"])
                   for a, b in zip([0, *cuts], [*cuts, 60])]
        states, totals = Counter(), {}
        for piece, state, run in linededup.stream_runs(iter(batches), "doc", 5, r.choice([1, 100])):
            for h, d in zip(piece.column(0).to_pylist(), piece.column(2).to_pylist()):
                states[(h, d, state)] += 1
            if state == linededup.SUMMARY:
                totals[piece.column(0)[0].as_py()] = (run.n_docs, piece.column(2)[0].as_py())
        for h in {x[0] for x in rows}:
            mine = [x[2] for x in rows if x[0] == h]
            docs = list(dict.fromkeys(mine))
            want = Counter(d for d in mine if len(docs) >= 5 and d != docs[0])
            got = Counter({d: n for (x, d, s), n in states.items() if x == h and s == linededup.DROP})
            if h in totals:  # open rows are settled by the totals
                assert totals[h] == (len(docs), docs[0])
                got += Counter({d: n for (x, d, s), n in states.items() if x == h and s == linededup.OPEN and len(docs) >= 5 and d != docs[0]})
            assert got == want, (trial, h)


def test_bitmaps_round_trip():
    for n, dropped in ((1, [0]), (9, [0, 8]), (64, []), (1000, list(range(0, 1000, 3)))):
        keep = linededup.unpacked(linededup.packed(np.array(dropped, np.int64), n), n)
        assert len(keep) == n and np.flatnonzero(~keep).tolist() == dropped


def test_lines_of_nothing(spark):
    empty = frame(spark, [])
    assert linededup.drop_shared_lines(empty).count() == 0
    assert [tuple(r) for r in linededup.drop_shared_lines(frame(spark, [(1, None)])).collect()] == [(1, 1, 0, "")]


# --- resampling ---------------------------------------------------------------------------

RAW = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def features(text, n_max, buckets):
    words = RAW.findall(lower(text))
    grams = [" ".join(words[i:i + n]) for n in range(1, n_max + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute_draw(texts, target, n_max, buckets, min_words, percent):
    s, t = Counter(), Counter()
    for _, x in texts:
        s.update(features(x, n_max, buckets)[1])
    for x in target:
        t.update(features(x, n_max, buckets)[1])
    big, small = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (small + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in texts:
        n, found = features(x, n_max, buckets)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def sample_texts():
    r = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "élan", "İx", "d3", "über", "x_y", "the", "of"] + [f"w{i}" for i in range(60)]
    texts = [(None, None), (1, ""), (2, " \n .. \n"), (3, "Alpha alpha ALPHA"), (4, "word\n" * 30), (5, "long " * 40_000)]
    texts += [(i, "\n".join(" ".join(r.choice(words) for _ in range(r.randrange(9))) for _ in range(r.randrange(1, 9)))) for i in range(6, 150)]
    return texts + [(7, texts[7][1]), (7, texts[7][1]), (None, texts[9][1]), *[(200 + i, texts[20][1]) for i in range(30)]]


@pytest.mark.parametrize("n_max", [1, 3])
def test_draw_against_brute_force(spark, partitions, n_max):
    texts, target = sample_texts(), ["alpha beta w1 w2 w3", None, "", "the w1\nof w2"]
    got = resampling.resample(
        frame(spark, texts).repartition(5), spark.createDataFrame([(t, 1) for t in target], "text string, rank int"), max_n=n_max, buckets=97, percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_draw(texts, target, n_max, 97, 20, 30)


def test_counts_of_lines_and_across_lines(spark):
    text = "a b\nc\n\nd e f"
    hasher = resampling.Hasher(3, 10_000)
    whole = features(text, 3, 10_000)[1]
    assert sorted([b for line in text.split("\n") for b in hasher.line(line)] + hasher.across(text.split("\n"))) == sorted(whole)
    docs = spark.createDataFrame([(text,)] * 50, "text string")
    want = np.bincount(whole, minlength=10_000) * 50
    assert (resampling.bucket_counts(docs, max_n=3) == want).all()


def test_resampling_of_nothing(spark):
    empty, some = frame(spark, []), frame(spark, [(1, "a " * 30)])
    assert resampling.resample(empty, some).count() == 0
    assert [r["rank"] for r in resampling.resample(some, empty, percent=100).collect()] == [1]


# --- vector codes -------------------------------------------------------------------------


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, np.floor(np.array(v) * scale).astype(int), label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    x = np.stack([v for _, v, _ in kept])
    w = x.shape[1] // parts
    code, error, books = [""] * len(x), np.zeros(len(x), int), []
    for p in range(parts):
        part = x[:, p * w:(p + 1) * w]
        book = part[:entries].copy()

        def assign():
            d = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            return d.argmin(axis=1), d.min(axis=1)

        for _ in range(rounds):
            near = assign()[0]
            for e in range(len(book)):
                if (near == e).any():
                    book[e] = np.floor_divide(part[near == e].sum(axis=0), (near == e).sum())
        near, far = assign()
        code = [c + f"{e:02x}" for c, e in zip(code, near)]
        error += far
        books.append(book)
    by_label = Counter()
    for (_, _, label), e in zip(kept, error):
        by_label[label] += int(e)
    digest = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()
    return sorted(((i, c, int(e), by_label[label], digest) for (i, _, label), c, e in zip(kept, code, error)), key=str)


def code_rows(n, dims, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims))
    rows = [(i, np.round(centres[i % 5] * (i % 3) + r.normal(size=dims) * 0.2, 2).tolist(), None if i % 6 == 0 else i % 4) for i in range(n)]
    same = rows[3][1]
    return rows + [(n + i, same, 2) for i in range(n // 2)] + [(3, same, 1), (None, same, None), (n * 9, None, 1), (n * 9, [None] * dims, 1), (n * 9, [math.nan] * dims, 1), (n * 9, [math.inf] * dims, 1)]


CODES = "vec_id long, embedding array<double>, label int, v string, known int, code int"


@pytest.mark.parametrize("n,dims,entries", [(500, 8, 256), (60, 16, 256), (300, 4, 8), (1, 8, 256)])
def test_codes_against_brute_force(spark, n, dims, entries):
    rows = code_rows(n, dims, n) if n > 1 else [(9, [0.5] * dims, None)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CODES).repartition(3)
    got = vectorcodes.encode(df, entries=entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, entries=entries)


def test_pivots_prune_and_keep_the_nearest():
    r = np.random.default_rng(2)
    centres = r.integers(-2000, 2000, size=(64, 16))
    points = centres[r.integers(64, size=3000)] + r.integers(-60, 60, size=(3000, 16))
    entries = np.concatenate([centres, centres[:5], points[:187]])  # five entries stand twice
    pivots = vectorcodes.choose_pivots(entries, vectorcodes.PIVOTS)
    index, best, done = vectorcodes.nearest(points, vectorcodes.to_pivots(points, pivots), entries, vectorcodes.to_pivots(entries, pivots))
    d = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert done < 0.25 * d.size


def test_codes_of_odd_vectors(spark):
    empty = spark.createDataFrame([], CODES)
    assert vectorcodes.encode(empty).count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 8, 1, "", 0, 0), (2, [1.0] * 4, 1, "", 0, 0), (3, [], 1, "", 0, 0)], CODES)
    assert [r["vec_id"] for r in vectorcodes.encode(odd).collect()] == [1]
    none = spark.createDataFrame([(1, [], 1, "", 0, 0)], CODES)
    assert [(r["code"], r["error"]) for r in vectorcodes.encode(none).collect()] == [("00000000", 0)]
    with pytest.raises(Exception, match="too large"):
        vectorcodes.encode(spark.createDataFrame([(1, [1e30] * 8, 1, "", 0, 0)], CODES)).collect()


# --- contract -----------------------------------------------------------------------------


@pytest.mark.parametrize("name,types", [
    ("op1_top_k_search", "query_id bigint, rank int, vec_id bigint, score bigint"),
    ("op8_decontamination", "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint, containment double"),
    ("op11_vector_codes", "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"),
    ("op12_line_dedup", "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string"),
    ("op13_resampling", "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint"),
])
def test_columns_of_the_queries(spark, sf_dir, duck, name, types):
    df = QUERIES[name](spark, sf_dir)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == types
    sql = SQL[name]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(duck.sql(sql).project(", ".join(df.columns)).fetchall(), key=str)
