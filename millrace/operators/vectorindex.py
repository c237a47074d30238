"""Similarity search of a large table of vectors in another, over a stored index of hashed tiles.

Vectors are signed by random hyperplanes: close vectors agree in their first bits. Sorted by that
signature, the table is cut into tiles of equal size, so a tile is a hash cell whose depth follows
the density there, and copies of one vector spread over tiles by their ids. A tile is one row: ids,
vectors, centre c and radius r, and no item of it can score more than q.c + |q| r.

Queries are packed into blocks in the same way. A search first probes, for every query, the few tiles
most likely to hold its best items, by centre and mean distance from it, which gives the query a
floor, its k-th best score so far. Only tiles whose bound reaches the floor are visited after that,
so the result is exact; without that second round it is approximate, to be measured with ``recall``.
Blocks meet tiles, never single rows: a pair of them is one row until its best items are known.
Neighbours travel together, so a vector is sent once for a group of tiles and not once for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.ordered import first_per_key
from millrace.workspace import cut_lineage, scratch_path

TILE_ROWS = 8192
TILE_TABLE_BYTES = 64 * 1024 * 1024  # centres sent to every task; tiles grow rather than this table
QUERIES_PER_TASK = 8192
GROUP_BYTES = 32 * 1024 * 1024  # vectors of neighbouring tiles, or blocks, that travel together
MEETINGS = 64  # groups of pairs that there should be at least, to give every core some
PROBES, BITS, SEED = 2, 32, 11
DIGITS = 12  # scores that differ by rounding noise only are ties


@dataclass(frozen=True)
class VectorIndex:
    """A stored index: one row (tile, ids, vectors) per tile, and the tiles' centres, radii and mean distances."""

    rows: DataFrame
    tiles: DataFrame
    dims: int


def _matrix(column, width: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(array), width)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(matrix.ravel()))


def _usable(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """(name, vector) of rows whose vector is there, without null or non-finite numbers."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(key).alias(name), v.alias("vector")).where("vector is not null").where(fine)


def signatures(vectors: np.ndarray, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Side of every vector to ``bits`` random hyperplanes, as one number; the first plane is the highest bit."""
    planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], bits))
    sides = (vectors @ planes >= 0).astype(np.int64)
    return sides @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _packed(rows: DataFrame, dims: int, per_tile: int, bits: int = BITS) -> DataFrame:
    """(tile, ids, vectors, centre, radius, spread): the rows of ``(id, vector)`` in tiles of ``per_tile`` by signature."""
    kind = dict(rows.dtypes)["id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = signatures(_matrix(batch.column(1), dims), bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=["id", "vector", "code"])

    signed = cut_lineage(rows.mapInArrow(sign, f"id {kind}, vector array<double>, code long"))
    placed = cut_lineage(signed.repartitionByRange("code", "id").sortWithinPartitions("code", "id").drop("code"))
    # The number of a row is its place in its partition behind the partitions before: one count per partition.
    numbered = placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33).cast("int"))
    before, offsets = 0, []
    for part, n in sorted((r["_part"], r["n"]) for r in numbered.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets.append((part, before))
        before += n
    first = F.broadcast(rows.sparkSession.createDataFrame(offsets, "_part int, _before long"))
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    tiled = numbered.join(first, "_part").select(F.floor(number / per_tile).cast("int").alias("tile"), "id", "vector")

    def pack(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vector"), dims)
        centre = vectors.mean(axis=0)
        gaps = ((vectors - centre) ** 2).sum(axis=1)
        ids = table.column("id").combine_chunks()
        return pa.table({
            "tile": table.column("tile")[:1], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()), "centre": _lists(centre[None, :]),
            "radius": pa.array([float(np.sqrt(gaps.max())) * (1 + 1e-9)]), "spread": pa.array([float(np.sqrt(gaps.mean()))])})

    return tiled.groupBy("tile").applyInArrow(pack, f"tile int, ids array<{kind}>, vectors binary, centre array<double>, radius double, spread double")


def build_index(items: DataFrame, key: str, vector: str = "vector", tile_rows: int = TILE_ROWS, path: str | None = None, bits: int = BITS) -> VectorIndex:
    """Sign, sort into tiles and store the vectors of ``items``; ``path`` defaults to the scratch folder.

    Rows whose vector is null, holds null or non-finite numbers or has another length than most are
    left out. A tile holds ``tile_rows`` rows, more where the table of centres would outgrow its
    limit, and is what a task keeps in memory.
    """
    path = path or scratch_path(items.sparkSession, "vector-index")
    rows = _usable(items, key, vector, "id")
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dims, n = (int(sizes["d"]), int(sizes["n"])) if sizes else (0, 0)
    tile_rows = max(tile_rows, math.ceil(n * dims * 8 / TILE_TABLE_BYTES))
    _packed(rows.where(F.size("vector") == dims), dims, tile_rows, bits).write.parquet(path)
    return open_index(items.sparkSession, path)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """A stored index, from the folder it was written to."""
    stored = spark.read.parquet(path)
    tiles = stored.select("tile", "centre", "radius", "spread")
    first = tiles.select(F.size("centre").alias("d")).first()
    return VectorIndex(stored.select("tile", "ids", "vectors"), tiles, int(first["d"]) if first else 0)


class Router:
    """Which tiles a query has to visit."""

    def __init__(self, tiles: list, probes: int):
        self.number = np.array([t["tile"] for t in tiles], np.int32)
        self.centres = np.array([t["centre"] for t in tiles], np.float64)
        self.radii = np.array([t["radius"] for t in tiles], np.float64)
        self.spreads = np.array([t["spread"] for t in tiles], np.float64)
        self.probes = min(probes, len(tiles))

    def wanted(self, queries: np.ndarray, floors: np.ndarray | None) -> np.ndarray:
        """Tiles to visit: the most promising ones first, then all others whose bound reaches the floor."""
        middle, sizes = queries @ self.centres.T, np.sqrt((queries**2).sum(axis=1))[:, None]
        likely = middle + 0.5 * sizes * self.spreads[None, :]
        first = np.zeros(middle.shape, bool)
        np.put_along_axis(first, np.argsort(-likely, axis=1, kind="stable")[:, : self.probes], True, axis=1)
        return first if floors is None else ~first & (middle + sizes * self.radii[None, :] + 1e-9 >= floors[:, None])


def _unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, dims) if dims else np.zeros((0, 0))


def _routed(blocks: DataFrame, router, dims: int) -> DataFrame:
    """(tile, block, at) with the places of the block's queries that have to visit the tile; ``floors`` ask for the second round."""
    second = "floors" in blocks.columns

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch.column(0).to_pylist()):
                vectors = _unpacked(batch.column(1)[i].as_py(), dims)
                floors = _unpacked(batch.column(2)[i].as_py(), 1)[:, 0] if second else None
                wanted = np.concatenate([
                    router.value.wanted(vectors[a:a + 1024], None if floors is None else floors[a:a + 1024]) for a in range(0, len(vectors), 1024)])
                tiles = np.flatnonzero(wanted.any(axis=0))
                at = [np.flatnonzero(wanted[:, t]).astype(np.int32) for t in tiles]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(router.value.number[tiles]), pa.array([block] * len(tiles), pa.int32()), pa.array([a.tolist() for a in at], pa.list_(pa.int32()))],
                    names=["tile", "block", "at"])

    columns = ["block", "vectors", "floors"] if second else ["block", "vectors"]
    return blocks.select(*columns).mapInArrow(route, "tile int, block int, at array<int>")


def _group(blocks: int, tiles: int, vectors: int, dims: int) -> int:
    """Neighbouring blocks, and tiles, of at most ``vectors`` each that travel together.

    As many as fit into ``GROUP_BYTES`` and leave ``MEETINGS`` groups of pairs for the tasks.
    """
    return max(1, min(GROUP_BYTES // max(1, vectors * dims * 8), math.isqrt(blocks * tiles // MEETINGS)))


def _visited(pairs: DataFrame, blocks: DataFrame, index: VectorIndex, k: int, min_score: float | None, group: int = 1) -> DataFrame:
    """Best ``k`` items of each query within each tile it visits; scores are formed for one block and one tile at a time.

    ``group`` neighbouring blocks meet ``group`` neighbouring tiles in one task, so a block travels
    once for all of them and so does a tile; only those that take part in a pair do. Where
    ``blocks`` have floors, only items that reach their query's floor come out.
    """
    dims, second = index.dims, "floors" in blocks.columns
    kinds = [dict(t.dtypes)["ids"][6:-1] for t in (blocks, index.rows)]
    near = [F.floor(F.col(c) / group).cast("int").alias(n) for c, n in (("tile", "_shelf"), ("block", "_rack"))]
    pairs = cut_lineage(pairs.select(*near, "tile", "block", "at"))
    visits = F.collect_list(F.struct("tile", "at")).alias("visits")
    packed = blocks.select("block", F.col("ids").alias("asked"), F.col("vectors").alias("queries"), *(["floors"] if second else []))
    asked = pairs.groupBy("_shelf", "_rack", "block").agg(visits).join(packed, "block")
    offered = pairs.select(F.col("_shelf").alias("_s"), F.col("_rack").alias("_r"), F.col("tile").alias("_tile")).distinct().join(
        index.rows.withColumnRenamed("tile", "_tile"), "_tile")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        offered_ids = right.column("ids").combine_chunks()
        place = {t: i for i, t in enumerate(right.column("_tile").to_pylist())}
        tiles = {}
        who, what, score = [], [], []
        for row in range(left.num_rows):
            asked = left.column("asked")[row].values
            block = _unpacked(left.column("queries")[row].as_py(), dims)
            floors = _unpacked(left.column("floors")[row].as_py(), 1)[:, 0] if second else None
            visits = left.column("visits")[row].values
            for tile, at in zip(visits.field("tile").to_pylist(), visits.field("at")):
                if tile not in tiles:
                    ids = offered_ids[place[tile]].values
                    order = ids.to_pandas().argsort(kind="stable").to_numpy()
                    tiles[tile] = ids, order, _unpacked(right.column("vectors")[place[tile]].as_py(), dims)[order]
                items, order, matrix = tiles[tile]
                at = at.values.to_numpy(zero_copy_only=False)
                least = np.full(len(at), -np.inf if min_score is None else min_score)
                if second:
                    least = np.maximum(least, floors[at])
                for low in range(0, len(at), 512):
                    scores = np.round(block[at[low:low + 512]] @ matrix.T, DIGITS)
                    rows, columns = _best(scores, k)
                    value = scores[rows, columns]
                    keep = value >= least[low + rows]
                    who.append(asked.take(pa.array(at[low + rows[keep]])))
                    what.append(items.take(pa.array(order[columns[keep]])))
                    score.append(value[keep])
        return pa.table({
            "query_id": pa.concat_arrays(who), "item_id": pa.concat_arrays(what), "score": pa.array(np.concatenate(score))})

    out = f"query_id {kinds[0]}, item_id {kinds[1]}, score double"
    return asked.groupBy("_shelf", "_rack").cogroup(offered.groupBy("_s", "_r")).applyInArrow(meet, out)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest scores per row, ties to the lower column."""
    n, m = scores.shape
    if m > k:
        cut = np.partition(scores, m - k, axis=1)[:, m - k, None]
        above, level = scores > cut, scores == cut
        room = k - above.sum(axis=1, keepdims=True)
        return np.nonzero(above | (level & (np.cumsum(level, axis=1) <= room)))
    return np.nonzero(np.ones(scores.shape, bool))


def search(
    index: VectorIndex, queries: DataFrame, key: str, vector: str = "vector", k: int = 5, min_score: float | None = None,
    probes: int = PROBES, exact: bool = True, queries_per_task: int = QUERIES_PER_TASK,
) -> DataFrame:
    """The ``k`` items with the highest dot product per query: (query_id, item_id, score, rank).

    Ties go to the smaller item id; scores below ``min_score`` are left out. With ``exact`` every
    tile that can hold a better item is visited; without, only the ``probes`` best ones. Queries
    with an unusable vector, or of another length than the index, find nothing; of a repeated query
    id the smallest vector is searched.
    """
    spark = queries.sparkSession
    asked = _usable(queries, key, vector, "id").where(F.size("vector") == index.dims)
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector"))
    kind, item_kind = dict(asked.dtypes)["id"], dict(index.rows.dtypes)["ids"][6:-1]
    tiles = index.tiles.collect()  # at most TILE_TABLE_BYTES of centres
    if not tiles or asked.isEmpty():
        return spark.createDataFrame([], f"query_id {kind}, item_id {item_kind}, score double, rank int")
    router = spark.sparkContext.broadcast(Router(tiles, probes))
    blocks = cut_lineage(_packed(asked, index.dims, queries_per_task).select(F.col("tile").alias("block"), "ids", "vectors"))
    largest = blocks.agg(F.count("*"), F.max(F.size("ids"))).first()
    held = max(largest[1], index.rows.agg(F.max(F.size("ids"))).first()[0])
    group = _group(largest[0], len(tiles), held, index.dims)
    found = cut_lineage(_top(_visited(_routed(blocks, router, index.dims), blocks, index, k, min_score, group), k))
    if not exact or len(tiles) <= probes:
        return found
    lowest = -math.inf if min_score is None else float(min_score)
    floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    placed = blocks.select("block", F.posexplode("ids").alias("at", "id")).join(floors, "id", "left")

    def pack(table: pa.Table) -> pa.Table:
        score = np.nan_to_num(table.column("score").to_numpy(), nan=lowest, neginf=-math.inf)[np.argsort(table.column("at").to_numpy())]
        return pa.table({"block": table.column("block")[:1], "floors": pa.array([np.maximum(score, lowest).astype("<f8").tobytes()], pa.binary())})

    floors = placed.groupBy("block").applyInArrow(pack, "block int, floors binary")
    open_ = cut_lineage(blocks.join(floors, "block"))
    more = _visited(_routed(open_, router, index.dims), open_, index, k, min_score, group)
    return _top(found.drop("rank").unionByName(more), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    return first_per_key(found, ["query_id"], [F.desc("score"), F.col("item_id")], k, "rank")


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true neighbours, how many of them were found, and their share."""
    both = truth.select("query_id", "item_id").join(found.select("query_id", "item_id", F.lit(1).alias("_hit")), ["query_id", "item_id"], "left")
    share = F.try_divide(F.count("_hit").cast("double"), F.count("*").cast("double"))
    return both.agg(F.count("*").alias("neighbours"), F.count("_hit").alias("hits"), F.coalesce(share, F.lit(1.0)).alias("recall"))
