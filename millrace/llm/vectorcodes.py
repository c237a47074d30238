"""Product codes of vectors, learnt in integers, with LAESA pivots pruning the distance work.

Every vector becomes integers and is cut into equal parts with one codebook per part position. The
distances of each part to a few fixed pivots are computed once and stored beside the vector. In
every round the codebook entries are measured against the pivots too; by the triangle inequality
|d(x, p) - d(e, p)| is a lower bound of d(x, e). Entries are evaluated exactly, in integers, in the
order of their bounds, until the next bound exceeds the best distance found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.workspace import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 12
CHUNK = 2048           # vectors whose bounds a task holds at once
LARGEST = 1 << 27      # integer components beyond it would not fit the long error
STEPS = (4, 16, 64)    # entries evaluated before the open bounds are looked at again


def cuts(width: int, parts: int) -> list[int]:
    """Borders of ``parts`` consecutive parts."""
    return [i * width // parts for i in range(parts + 1)]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired integer rows."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def choose_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Points far from each other: each the farthest from those chosen before, the first from the mean."""
    if not len(points):
        return points
    far = squared(points.astype(float), points.mean(axis=0))
    chosen = [int(far.argmax())]
    near = squared(points, points[chosen[0]])
    while len(chosen) < min(n, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(points, points[chosen[-1]]))
    return points[chosen]


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """True distances to every pivot, one column each."""
    return np.sqrt(np.stack([squared(points, p) for p in pivots], axis=1).astype(float)) if len(pivots) else np.zeros((len(points), 0))


def nearest(points: np.ndarray, known: np.ndarray, entries: np.ndarray, entry_known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of every point (ties to the lower index), its squared distance, distances evaluated.

    ``known`` and ``entry_known`` are the pivot distances of points and entries.
    """
    n, m = len(points), len(entries)
    bound = np.zeros((n, m))
    for p in range(known.shape[1]):
        np.maximum(bound, np.abs(known[:, p, None] - entry_known[None, :, p]), out=bound)
    # Rounding of the roots must never raise a bound above the true distance.
    bound -= 1e-9 * (known.max(initial=0.0) + entry_known.max(initial=0.0))
    np.maximum(bound, 0.0, out=bound)
    bound *= bound
    best, index, done = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), 0

    def evaluate(rows: np.ndarray, columns: np.ndarray) -> None:
        nonlocal done
        distance = squared(points[rows[:, None]], entries[columns])
        done += distance.size
        least = distance.min(axis=1)
        first = np.where(distance == least[:, None], columns, m).min(axis=1)
        better = (least < best[rows]) | ((least == best[rows]) & (first < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], first[better]

    rows = np.arange(n)
    for step in STEPS:
        step = min(step, m)
        columns = np.argpartition(bound[rows], step - 1, axis=1)[:, :step]
        evaluate(rows, columns)
        bound[rows[:, None], columns] = np.inf
        rows = rows[bound[rows].min(axis=1) <= best[rows]]
        if not len(rows):
            return index, best, done
    pairs = np.nonzero(bound[rows] <= best[rows, None])
    for low in range(0, len(pairs[0]), 1 << 18):
        which, column = rows[pairs[0][low:low + (1 << 18)]], pairs[1][low:low + (1 << 18)]
        distance = squared(points[which], entries[column])
        done += len(distance)
        order = np.lexsort((column, distance, which))
        head = order[np.r_[True, which[order][1:] != which[order][:-1]]]
        who, least, first = which[head], distance[head], column[head]
        better = (least < best[who]) | ((least == best[who]) & (first < index[who]))
        best[who[better]], index[who[better]] = least[better], first[better]
    return index, best, done


def integer_vectors(rows: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v): components as floor(scale x); unusable vectors are left out."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), x.alias("x")).where(F.col("x").isNotNull()).where(usable)
    return kept.select("id", "label", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(matrix.ravel()))


class Codebooks:
    """Entries and pivots of every part position."""

    def __init__(self, entries: list[np.ndarray], pivots: list[np.ndarray]):
        self.entries, self.pivots = entries, pivots
        self.known = [to_pivots(e, p) for e, p in zip(entries, pivots)]
        self.borders = np.cumsum([0, *[e.shape[1] for e in entries]]).tolist()
        self.places = np.cumsum([0, *[len(p) for p in pivots]]).tolist()

    def vectors(self, column: pa.ListArray) -> np.ndarray:
        return _matrix(column, self.borders[-1])

    def distances(self, column: pa.ListArray) -> np.ndarray:
        return _matrix(column, self.places[-1])

    def measured(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of every part to its pivots, the parts side by side."""
        return np.concatenate([to_pivots(vectors[:, a:b], p) for a, b, p in zip(self.borders, self.borders[1:], self.pivots)], axis=1)

    def assigned(self, vectors: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For every part position: its number, the parts, their entries and squared distances."""
        for part, (entries, entry_known) in enumerate(zip(self.entries, self.known)):
            points = vectors[:, self.borders[part]:self.borders[part + 1]]
            index, best, _ = nearest(points, known[:, self.places[part]:self.places[part + 1]], entries, entry_known)
            yield part, points, index, best

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), CHUNK):
            yield batch.slice(low, CHUNK)


def seed_codebooks(vectors: DataFrame, parts: int, entries: int, pivots: int) -> Codebooks | None:
    """The parts of the ``entries`` smallest ids, which are all the rows that reach the driver."""
    in_order = [F.col("id").asc_nulls_last(), F.col("v"), F.col("label")]
    first = vectors.orderBy(*in_order).limit(entries).collect()
    if not first:
        return None
    width = len(first[0]["v"])
    if any(len(r["v"]) != width for r in first):
        first = vectors.where(F.size("v") == width).orderBy(*in_order).limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), width)
    borders = cuts(width, parts)
    books = [start[:, a:b] for a, b in zip(borders, borders[1:])]
    return Codebooks(books, [choose_pivots(b, pivots) for b in books])


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every task sums its parts per entry, the sums meet, entries become floor(sum / count)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        totals = [np.zeros_like(e) for e in now.entries]
        counts = [np.zeros(len(e), np.int64) for e in now.entries]
        for batch in _chunks(batches):
            for part, points, index, _ in now.assigned(now.vectors(batch.column(0)), now.distances(batch.column(1))):
                np.add.at(totals[part], index, points)
                counts[part] += np.bincount(index, minlength=len(counts[part]))
        for part, (total, count) in enumerate(zip(totals, counts)):
            used = np.flatnonzero(count)
            both = np.concatenate([total[used], count[used, None]], axis=1)  # the count is the last number
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), part, np.int32)), pa.array(used.astype(np.int32)), _lists(both)], names=["part", "entry", "sums"])

    found = rows.select("v", "known").mapInArrow(sums, "part int, entry int, sums array<long>")
    cells = found.select("part", "entry", F.posexplode("sums").alias("i", "x")).groupBy("part", "entry", "i").agg(F.sum("x").alias("x"))
    fresh = [e.copy() for e in books.entries]
    for r in cells.groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("sums")).collect():
        *total, n = [c["x"] for c in r["sums"]]
        fresh[r["part"]][r["entry"]] = [x // n for x in total]
    return Codebooks(fresh, books.pivots)


def encode(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every usable vector.

    Codebooks start as the parts of the ``entries`` smallest ids and are refined for ``rounds``
    rounds; unused entries stay. ``code`` holds two hex digits per part, ``error`` the squared
    distances summed over the parts, ``label_error`` that error summed over rows of one label.

    Vectors that are null or hold null or non-finite components take no part, nor do vectors of
    another length than that of the smallest id; with fewer vectors than ``entries`` the codebooks
    are shorter. A null id ranks last, null labels are one label, repeated rows count each. Integer
    components of 2^27 and more raise an error, since errors would leave the range of a long. An
    empty table gives an empty result. Other columns do not matter.
    """
    if entries > 256:
        raise ValueError("two hex digits name 256 entries at most")
    kinds = dict(rows.dtypes)
    vectors = integer_vectors(rows, key, vector, label, scale)
    books = seed_codebooks(vectors, parts, entries, pivots)
    spark = rows.sparkSession
    if books is None:
        return spark.createDataFrame([], f"`{key}` {kinds[key]}, code string, error long, label_error long, codebooks_sha256 string")
    start = books

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            v = start.vectors(batch.column(2))
            if v.size and max(int(v.max()), -int(v.min())) >= LARGEST:
                raise ValueError("a component of a vector is too large")
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(start.measured(v))], names=["id", "label", "v", "known"])

    same = vectors.where(F.size("v") == books.borders[-1])
    measured = cut_lineage(same.mapInArrow(measure, f"id {kinds[key]}, label {kinds[label]}, v array<long>, known array<double>"))
    for _ in range(rounds):
        books = _refined(measured, books)
    shared = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            now, index, error = shared.value, [], np.zeros(len(batch), np.int64)
            for _, _, i, best in now.assigned(now.vectors(batch.column(2)), now.distances(batch.column(3))):
                index.append(i)
                error += best
            codes = ["".join(f"{i:02x}" for i in row) for row in np.stack(index, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), pa.array(error)], names=["id", "label", "code", "error"])

    coded = cut_lineage(measured.mapInArrow(code, f"id {kinds[key]}, label {kinds[label]}, code string, error long"))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    met = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return met.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
