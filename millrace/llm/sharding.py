"""Sharding by a k-d tree over metadata of the texts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import cut_lineage

BINS = 1024  # values per refinement of a median
PART_ROWS = 100_000  # rows ranked together when slots are numbered


def text_dimensions(text: Column) -> dict[str, Column]:
    """Metadata of a text that equal texts share: its length and its place in hash order, each 0 to 2^40."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    long = F.least(F.lit(1 << 40), (F.log2(size + F.lit(1)) * F.lit(float(1 << 35))).cast("long"))
    return {"length": long, "order": F.shiftrightunsigned(F.xxhash64(text), 24)}


@dataclass
class Node:
    """A cell of the tree: its bounds, and once it is split the dimension, the value and the halves."""

    leaves: int
    path: list[Column] = field(default_factory=list)
    axis: str | None = None
    value: int | None = None
    low: "Node | None" = None
    high: "Node | None" = None


def _medians(points: DataFrame, weight: str, jobs: list[tuple[int, str, int, int, float]]) -> dict[int, int]:
    """The value up to which each node's weight comes closest to its share; exact, by refined histograms.

    ``jobs`` holds (node, dimension, least, most, share). Every round is one aggregate with at most
    ``BINS`` rows per node for all nodes together.
    """
    open_, found = {}, {}
    for node, axis, low, high, goal in jobs:
        open_[node] = [axis, low, high, goal]
    while open_:
        bins = None
        for node, (axis, low, high, _) in open_.items():
            step = max(1, -(-(high - low + 1) // BINS))
            part = F.when((F.col("node") == node) & F.col(axis).between(low, high), F.floor((F.col(axis) - low) / F.lit(step)).cast("long"))
            bins = part if bins is None else F.coalesce(bins, part)
        sums = points.where(F.col("node").isin(list(open_))).withColumn("bin", bins).where("bin is not null")
        table = sums.groupBy("node", "bin").agg(F.sum(weight).alias("w")).collect()
        for node in list(open_):
            axis, low, high, goal = open_[node]
            step = max(1, -(-(high - low + 1) // BINS))
            for r in sorted((r for r in table if r["node"] == node), key=lambda r: r["bin"]):
                if r["w"] >= goal:
                    break
                goal -= r["w"]
            low, high = low + r["bin"] * step, min(high, low + (r["bin"] + 1) * step - 1)
            if low == high:  # the value goes to the side that comes closer to the share
                found[node] = low if goal >= r["w"] / 2 else low - 1
                del open_[node]
            else:
                open_[node] = [axis, low, high, goal]
    return found


def kd_tree(points: DataFrame, axes: list[str], weight: str, leaves: int | None = None, target: int | None = None) -> Node:
    """Split the points at weighted medians along the widest axis until there are ``leaves`` leaves.

    With ``target`` instead, the number of leaves is the total weight over the target, rounded up. An
    odd number of leaves is split in proportion. Axes are integers; their width counts relative to
    the whole table. Points of one value stay together. A cell with one point in every axis is not
    split, its other leaves stay empty.
    """
    bounds = points.agg(F.sum(weight).alias("w"), *[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if leaves is None:
        leaves = max(1, -(-int(bounds["w"] or 0) // target))
    root = Node(leaves)
    if bounds["w"] is None:
        return root
    spread = {a: max(1, bounds[f"hi_{a}"] - bounds[f"lo_{a}"]) for a in axes}
    level = [root]
    while level := [n for n in level if n.leaves > 1]:
        number = F.lit(None).cast("int")
        for i, node in reversed(list(enumerate(level))):
            inside = F.lit(True)
            for step in node.path:
                inside = inside & step
            number = F.when(inside, i).otherwise(number)
        cells = points.withColumn("node", number).where("node is not null")
        stats = cells.groupBy("node").agg(F.sum(weight).alias("w"), *[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]).collect()
        jobs = []
        for r in stats:
            axis = max(axes, key=lambda a: (r[f"hi_{a}"] - r[f"lo_{a}"]) / spread[a])
            low, high = r[f"lo_{axis}"], r[f"hi_{axis}"]
            if low < high:
                share = r["w"] * (level[r["node"]].leaves // 2) / level[r["node"]].leaves
                jobs.append((r["node"], axis, low, high, share))
        split = _medians(cells, weight, jobs)
        following = []
        for i, axis, low, high, _ in jobs:
            node = level[i]
            node.axis, node.value = axis, max(low, min(split[i], high - 1))
            below = F.col(axis) <= F.lit(node.value)
            node.low = Node(node.leaves // 2, [*node.path, below])
            node.high = Node(node.leaves - node.leaves // 2, [*node.path, ~below])
            following += [node.low, node.high]
        level = following
    return root


def leaf_number(node: Node, first: int = 0) -> Column:
    """The leaf of a row, counted from ``first``, as an expression on its axes."""
    if node.axis is None:
        return F.lit(first)
    return F.when(F.col(node.axis) <= F.lit(node.value), leaf_number(node.low, first)).otherwise(
        leaf_number(node.high, first + node.low.leaves))


def numbered(rows: DataFrame, group: str, order: list[str], n_rows: int) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each group, ranked in hash parts of about ``PART_ROWS`` rows."""
    parts = max(1, -(-n_rows // PART_ROWS))
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    counts = dealt.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    ranked = dealt.withColumn("__place", F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)))
    return ranked.join(offsets, [group, "__part"]).withColumn("slot", (F.col("__first") + F.col("__place") - 1).cast("long")).drop("__part", "__first", "__place")


def shard(docs: DataFrame, shards: int | None = 8, target: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard of every document so that shards hold nearly equal bytes: (key, size, text_crc32, shard, slot).

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1. The tree splits on metadata that
    equal texts share, so copies land in one shard; copies are summed to one point before the tree
    is built. Shards are equal up to the weight of the texts at the cuts. Slots number the rows of a
    shard without gaps. Give ``shards`` (their number) or ``target`` (bytes per shard).

    Null texts are one group of their own (``text_crc32`` null), like empty texts. Repeated rows get
    slots of their own. An empty table gives an empty result. Other columns do not matter.
    """
    dims = text_dimensions(F.col(text))
    rows = cut_lineage(docs.select(
        F.col(key).alias("key"), (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"), *[c.alias(n) for n, c in dims.items()]))
    points = cut_lineage(rows.groupBy(*dims).agg(F.sum("size").alias("weight"), F.count("*").alias("n")))
    n_rows = points.agg(F.sum("n")).first()[0] or 0
    tree = kd_tree(points, list(dims), "weight", shards if target is None else None, target)
    placed = rows.select("key", "size", "text_crc32", leaf_number(tree).cast("int").alias("shard"))
    return numbered(placed, "shard", ["key", "size", "text_crc32"], n_rows).select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
