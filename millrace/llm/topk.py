"""Exact top-k inner products by no-random-access aggregation over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

TILE_ROWS = 8192  # candidates of a tile: sorted lists of 64 dimensions take 4 MB
TILE_QUERIES = 4096
BATCH = 512  # queries that advance together
DEPTHS = (0.25, 0.5, 0.75)
FEW = 8  # stop reading lists once this many times k candidates are left
EXACT32, EXACT64 = 2**24, 2**53


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table[column].combine_chunks()
    flat = np.asarray(values.flatten(), dtype=np.float64)
    return flat.reshape(len(values), -1) if len(values) and len(flat) else np.zeros((len(values), 0))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows without rounding, whatever their size; past 64 bits they stay at the end of the range."""
    return np.array([[min(max(sum(int(x) * int(y) for x, y in zip(p, q)), -(2**63)), 2**63 - 1) for q in b] for p in a], dtype=np.int64).reshape(len(a), len(b))


def tile_top_k(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query id, row ids, scores) of each query's k best rows of the tile, ties to the smaller id.

    Every dimension is a sorted list that is read from its better end for the query's sign. Rounds
    read all lists to one depth. Values not read lie between the value at the depth and the far end of the
    list, which bounds each score from above and below. A row whose upper bound stays below the
    k-th best lower bound cannot qualify; reading stops when few rows are left, whose scores are then
    resolved.
    """
    n, d = rows.shape
    bound = d * (np.abs(queries).max(initial=0) + 1) * (np.abs(rows).max(initial=0) + 1)
    if bound >= EXACT64:
        scores = _exact(queries, rows)
        for q, s in zip(query_ids, scores):
            yield _best(q, row_ids[row_ids != q], s[row_ids != q], k)
        return
    kind = np.float32 if bound < EXACT32 else np.float64
    rows = rows.astype(kind)
    lists = np.sort(rows, axis=0)
    rounds = [int(n * f) for f in DEPTHS if 1 <= int(n * f) < n] if n > FEW * k and d else []
    bounds = []
    for depth in rounds:
        top, low = lists[n - depth], lists[depth - 1]
        bounds.append((
            np.where(rows >= top, rows, top), np.where(rows <= low, rows, low),
            np.where(rows >= top, rows, lists[0]), np.where(rows <= low, rows, lists[-1])))
    for at in range(0, len(queries), BATCH):
        q = queries[at:at + BATCH].astype(kind)
        ids = query_ids[at:at + BATCH]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        own = {i: np.flatnonzero(row_ids == x) for i, x in enumerate(ids)} if np.isin(ids, row_ids).any() else {}
        left = np.arange(len(q))
        for high_up, high_down, low_up, low_down in bounds:
            if not len(left):
                break
            lower = up[left] @ low_up.T + down[left] @ low_down.T
            upper = up[left] @ high_up.T + down[left] @ high_down.T
            for i, x in enumerate(left):
                if own.get(x) is not None and len(own[x]):
                    lower[i, own[x]] = upper[i, own[x]] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
            alive = upper >= kth[:, None]
            done = alive.sum(axis=1) <= FEW * k
            for i in np.flatnonzero(done):
                c = np.flatnonzero(alive[i] & (upper[i] > -np.inf))
                yield _best(ids[left[i]], row_ids[c], rows[c] @ q[left[i]], k)
            left = left[~done]
        if len(left):  # the lists are read to the end: bounds meet in the scores
            scores = q[left] @ rows.T
            for i, x in enumerate(left):
                s, r = scores[i], row_ids
                if x in own and len(own[x]):
                    s, r = np.delete(s, own[x]), np.delete(r, own[x])
                if len(s) > k:
                    c = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                    s, r = s[c], r[c]
                yield _best(ids[x], r, s, k)


def _best(query, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple:
    scores = scores.astype(np.int64)
    order = np.lexsort((ids, ~scores))[:k]  # ~s sorts like -s and cannot overflow
    return query, ids[order], scores[order]


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: float | None = None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each query's ``k`` best other rows by inner product: (query, rank, key, score).

    With ``scale``, components are turned into floor(scale * x) first and scores are whole numbers,
    exact at any size (limited to 64 bits); without, they must be whole already. Ties go to the
    smaller key. Queries meet all rows in tiles of bounded size, one task each; every tile reads its
    sorted lists only as far as needed and returns ``k`` rows per query.

    Null vectors, and vectors with a null or non-finite component, take no part. Only vectors of one
    length meet. A key on several rows counts once, with its smallest vector; null keys take no part.
    An empty table, or a query without other rows, gives no rows. Other columns do not matter.
    """
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    wide = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.transform(wide, lambda x: F.when(F.abs(x) < 2.0**52, F.floor(F.lit(float(scale)) * x).cast("double")).otherwise(F.lit(float(scale)) * x)) if scale else wide
    rows = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull() & finite).select(
        F.col(key).alias("id"), whole.alias("vector"), is_query.alias("asks"))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks"))
    # one line per length of vector
    sizes = rows.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).select(
        "dims", F.ceil(F.col("n") / TILE_ROWS).alias("across"), F.ceil(F.col("q") / TILE_QUERIES).alias("down")).where("down > 0")
    dealt = rows.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, F.size("vector") == F.col("dims"))
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    place = F.xxhash64("id")
    right = dealt.select("dims", F.pmod(place, "across").alias("across"), F.explode(numbers(F.col("down"))).alias("down"), "id", "vector")
    left = dealt.where("asks").select(
        F.col("dims").alias("q_dims"), F.explode(numbers(F.col("across"))).alias("q_across"), F.pmod(place, "down").alias("q_down"),
        F.col("id").alias("q_id"), F.col("vector").alias("q_vector"))

    def tile(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and held.num_rows:
            out = list(tile_top_k(_matrix(asked, "q_vector"), asked["q_id"].to_numpy(), _matrix(held, "vector"), held["id"].to_numpy(), k))
        return pa.table({
            "query": pa.array(np.repeat([q for q, _, _ in out], [len(r) for _, r, _ in out]) if out else [], pa.int64()),
            "id": pa.array(np.concatenate([r for _, r, _ in out]) if out else [], pa.int64()),
            "score": pa.array(np.concatenate([s for _, _, s in out]) if out else [], pa.int64())})

    parts = left.groupBy("q_dims", "q_across", "q_down").cogroup(right.groupBy("dims", "across", "down")).applyInArrow(tile, "query long, id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", F.col("id").alias(key), "score")
