"""Near-duplicate classes with Order MinHash and banded alignment.

Joins in the rounds carry a merge hint: labels grow with the corpus, and dozens of small broadcasts
would fill the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.hashing import PrefixHashes, mix, word_bounds
from millrace.workspace import cut_lineage

U = np.uint64
SHINGLE = 5
SIMILAR = 0.8
PICKED = 4  # minimum k-mers of a sketch
BANDS = 24
PIVOTS = 16  # of a bucket in the first of the later rounds; each round has this many times those before
PARITIES = 16  # words of 64 bits in which the runs of a text are counted modulo 2
TASK_ROWS = 20_000  # short rows that a task of the rounds takes
GROUP_ROWS = 256  # members compared with one pivot in one group
BROADCAST_IDS = 1_000_000  # 8 bytes each; above it documents are found by a shuffle join
_SEEDS = mix(np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_STEPS = [U(pow(0xC2B2AE3D27D4EB4F, i, 2**64)) for i in range(64)]


def kmers(text: str, k: int = SHINGLE) -> np.ndarray:
    """Occurrence-labelled hashes of the runs of ``k`` lower-case words, in text order; all differ.

    A text of fewer words gives one run of all of them, a text without words none.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, U)
    w = mix(PrefixHashes(data).span(starts, ends))
    k = min(k, len(w))
    n = len(w) - k + 1
    runs = np.zeros(n, U)
    for i in range(k):
        runs += w[i:i + n] * _STEPS[i]
    order = np.argsort(runs, kind="stable")
    line = runs[order]
    first = np.concatenate([[True], line[1:] != line[:-1]])
    if first.all():
        return mix(runs)
    at = np.arange(n)
    occurrence = np.empty(n, U)
    occurrence[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(U)
    return mix(runs + occurrence * _STEPS[63])


def sketches(labelled: np.ndarray, picked: int = PICKED, bands: int = BANDS) -> np.ndarray:
    """One value per band: the ``picked`` k-mers that are smallest under the band's hash, in text order."""
    out = np.empty(bands, U)
    for b in range(bands):
        if len(labelled) > picked:
            x = labelled ^ _SEEDS[b]
            x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
            at = np.sort(np.argpartition(x, picked)[:picked])
            chosen = labelled[at]
        else:
            chosen = labelled
        value = _SEEDS[b]
        for c in chosen.tolist():
            value = ((int(value) * 0x9E3779B97F4A7C15) ^ c) & 0xFFFFFFFFFFFFFFFF
            value ^= value >> 29
        out[b] = value
    return out


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Ordered similarity of two lists of labelled k-mers: aligned / (all - aligned), 0 below ``least``.

    Labelled k-mers are unique in a text, so the best alignment is the longest increasing run of
    their common places. Texts at ``least`` differ in at most ``(n + m) * (1 - least) / (1 + least)``
    k-mers, so places further off the diagonal than that cannot help and are left out.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    line = both[order]
    at = np.flatnonzero(line[1:] == line[:-1])
    x, y = order[at], order[at + 1] - n
    band = (n + m) * (1 - least) / (1 + least)
    near = np.abs(x - y) <= band
    x, y = x[near], y[near]
    if len(x) < least * (n + m - len(x)):
        return 0.0
    y = y[np.argsort(x)]
    aligned = len(y) if (y[1:] > y[:-1]).all() else _increasing(y.tolist())
    value = aligned / (n + m - aligned)
    return value if value >= least else 0.0


def _increasing(places: list[int]) -> int:
    from bisect import bisect_left

    tails: list[int] = []
    for p in places:
        i = bisect_left(tails, p)
        tails[i:i + 1] = [p]
    return len(tails)


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, same, n, band values): ``same`` identifies the text, ``n`` counts its runs; a text without words has no bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, offsets, sizes = [], [0], []
            for value in batch.column(2):
                labelled = kmers(value.as_py())
                sizes.append(len(labelled))
                if len(labelled):
                    found.append(sketches(labelled))
                offsets.append(offsets[-1] + BANDS * bool(len(labelled)))
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), bands], ["id", "same", "n", "bands"])

    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.sha2(text, 256).alias("same"), F.col(text).alias("text"))
    return rows.mapInArrow(sketch, "id long, same string, n long, bands array<long>")


def texts_of(docs: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text) of the documents that take part in any comparison, kept for all rounds."""
    ids = cut_lineage(ids.distinct())
    bounded = F.broadcast if ids.count() <= BROADCAST_IDS else (lambda df: df)
    return cut_lineage(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null").join(bounded(ids), "id", "left_semi"))


def narrowed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` short rows in as few tasks as they need, so that a small step writes few files."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def own_runs(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, own): how many runs of each text stand in no other text of ``ids``."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                labelled = kmers(value.as_py()).view(np.int64)
                for at in range(0, len(labelled), 1 << 16):
                    part = labelled[at:at + (1 << 16)]
                    yield pa.record_batch([pa.array(part), pa.array(np.full(len(part), i, np.int64))], ["run", "id"])

    chosen = texts.join(ids.hint("merge"), "id", "left_semi").select("id", "text")
    held = chosen.mapInArrow(runs, "run long, id long").groupBy("run").agg(F.count("*").alias("texts"), F.min("id").alias("id"))
    alone = held.where("texts = 1").groupBy("id").agg(F.count("*").alias("own"))
    return ids.join(alone.hint("merge"), "id", "left").select("id", F.coalesce("own", F.lit(0)).alias("own"))


def parities(labelled: np.ndarray) -> np.ndarray:
    """Bit by bit, whether an odd number of runs falls on it."""
    bits = 64 * PARITIES
    odd = np.bincount((mix(labelled ^ _SEEDS[0]) % U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def with_parities(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, odd): the parities of each text as a struct of words."""
    names = [f"w{i}" for i in range(PARITIES)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.array([parities(kmers(value.as_py())) for value in batch.column(1)], np.int64).reshape(-1, PARITIES)
            yield pa.record_batch([batch.column(0), *(pa.array(words[:, i]) for i in range(PARITIES))], ["id", *names])

    chosen = texts.join(ids.hint("merge"), "id", "left_semi").select("id", "text")
    return chosen.mapInArrow(read, "id long, " + ", ".join(f"{w} long" for w in names)).select("id", F.struct(*names).alias("odd"))


def may_link(least: float, odd: bool = False) -> Column:
    """Whether two texts can be similar at all, by what each has for itself and, if ``odd``, by their parities.

    Runs that no other text has are never common, so at most ``m``, the smaller rest, are, and the
    similarity is at most m / (n + a_n - m). Every bit in which the parities differ stands for a run
    that only one of the two has; of such runs there are at most (n + a_n) * (1 - least) / (1 + least).
    """
    m = F.least(F.col("n") - F.col("own"), F.col("a_n") - F.col("a_own"))
    fits = m >= F.lit(least) * (F.col("n") + F.col("a_n") - m) - F.lit(1e-9)
    if not odd:
        return fits
    apart = sum((F.bit_count(F.col("odd")[f"w{i}"].bitwiseXOR(F.col("a_odd")[f"w{i}"])) for i in range(1, PARITIES)),
                F.bit_count(F.col("odd")["w0"].bitwiseXOR(F.col("a_odd")["w0"])))
    return fits & (apart <= (F.col("n") + F.col("a_n")) * F.lit((1 - least) / (1 + least)) + F.lit(1e-9))


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The (a, b) of (a, b, n) pairs whose texts align to ``least``. ``a`` stands in ``n`` pairs, dealt in groups of bounded size."""
    part = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("n") / GROUP_ROWS).cast("long"))).alias("part")
    pairs = pairs.select("a", "b", part)
    asked = pairs.select("a", F.col("b").alias("id"), "part").unionByName(pairs.select("a", F.col("a").alias("id"), "part").distinct())
    rows = asked.join(texts.hint("merge"), "id").repartition("a", "part").sortWithinPartitions("a", "part", F.col("id") != F.col("a"), "id")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, pivot = None, None
        for batch in batches:
            left, right = [], []
            for a, part, i, value in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "id")), batch.column("text")):
                if (a, part) != spot:
                    spot, pivot = (a, part), kmers(value.as_py())
                elif i != a and similarity(pivot, kmers(value.as_py()), least):
                    left.append(a)
                    right.append(i)
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return rows.select("a", "part", "id", "text").mapInArrow(align, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each connected component, by large-star and small-star steps."""
    edges = links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u != v").distinct()
    around = Window.partitionBy("u")
    while True:
        edges = cut_lineage(edges)
        rows = edges.count()
        edges = narrowed(edges, rows)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stars, once no end has a smaller and a larger neighbour or two smaller ones
        ends = both.groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("low"), F.count_if(F.col("v") > F.col("u")).alias("high"))
        if ends.where("low > 1 OR low = 1 AND high > 0").isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        large = both.withColumn("m", F.least("u", F.min("v").over(around))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = narrowed(large, 2 * rows).repartition("u").distinct().withColumn("m", F.min("v").over(around))
        small = large.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*")
        edges = narrowed(small.where("u != v"), 2 * rows).distinct()


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after more links: components of the links between present roots, then those are followed."""
    if roots is None:
        return components(links)
    ends = links
    for c in ("a", "b"):
        ends = ends.join(roots.withColumnsRenamed({"id": c, "root": f"{c}_root"}).hint("merge"), c, "left").withColumn(c, F.coalesce(f"{c}_root", c)).drop(f"{c}_root")
    more = components(ends)
    moved = roots.join(more.select(F.col("id").alias("root"), F.col("root").alias("next")).hint("merge"), "root", "left").select("id", F.coalesce("next", "root").alias("root"))
    roots = cut_lineage(moved.unionByName(more.join(roots.hint("merge"), "id", "left_anti")))
    return narrowed(roots, roots.count())


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the root of their present class, their own id if they have none."""
    return members.join(roots.hint("merge"), "id", "left").withColumn("root", F.coalesce("root", "id"))


def near_duplicates(docs: DataFrame, least: float = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Class of every document: (key, class_id, same_text_id); ``class_id`` is the smallest id of its class.

    Two texts are linked if their lists of five-word runs align to ``least`` in order; classes are the
    connected components of links and of equal texts. Equal texts are one node. Candidates share an
    Order MinHash band: the same ``PICKED`` minimum k-mers in the same order. In every bucket one
    random member is the pivot that members of other classes are aligned with: first in two bands, where most
    groups meet, then in all of them. Members that stay apart from their pivot go on with ``PIVOTS`` new
    pivots, and that many times more each round, until no bucket holds two classes. Before the
    first two of these rounds the runs that a text has for itself, among the texts still left, are counted: a
    text with too many of them is similar to none and leaves. Two texts meet only if these runs and their
    ``parities`` allow a link, which loses none: of texts that share much but stay below ``least``, hardly a pair is
    left to align. A pivot's members are dealt out in groups of bounded size. A pair at 0.8 shares no band with
    probability below 1 in 100,000.

    Null texts are alone in their class; equal texts without words share one. Repeated rows of a key
    give repeated rows. Null keys have a null class. Other columns do not matter.
    """
    rows = cut_lineage(sketched(docs, key, text))
    first = rows.groupBy("same").agg(F.min("id").alias("same_id"), F.min_by("bands", "id").alias("bands"), F.min_by("n", "id").alias("n"))
    nodes = cut_lineage(first)
    buckets = nodes.select(F.col("same_id").alias("id"), "n", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = cut_lineage(buckets.join(shared, ["band", "value"]))
    texts = texts_of(docs, buckets.select("id"), key, text)
    # runs that a text has for itself are counted once few texts are left; until then none are known
    every = buckets.select("id", F.struct("band", "value").alias("bucket"), "n", F.lit(0).cast("long").alias("own"))
    roots, done, pivots = None, None, 1
    plan = [every.where("bucket.band < 2"), every]
    while plan:
        kind = plan.pop(0)
        carried = [c for c in kind.columns if c not in ("id", "bucket")]
        members = kind.withColumn("root", F.col("id")) if roots is None else rooted(kind, roots)
        # small classes first: a bucket is done once only its largest class is left
        size = F.count("*").over(Window.partitionBy("bucket", "root"))
        turn = F.row_number().over(Window.partitionBy("bucket").orderBy("size", F.xxhash64("id", "bucket"), "id"))
        members = cut_lineage(members.repartition("bucket").withColumn("size", size).withColumn("turn", turn).drop("size"))
        members = narrowed(members, members.count())
        picked = members.where(F.col("turn") <= pivots).select(
            F.col("bucket").alias("a_bucket"), F.col("id").alias("a"), F.col("root").alias("a_root"), *[F.col(c).alias(f"a_{c}") for c in carried])
        met = members.join(picked.hint("merge"), (F.col("bucket") == F.col("a_bucket")) & (F.col("root") != F.col("a_root")) & may_link(least, "odd" in carried))
        pairs = met.select("a", F.col("id").alias("b"), F.least("a", "id").alias("u"), F.greatest("a", "id").alias("v")).groupBy("u", "v").agg(
            F.min("a").alias("a"), F.min_by("b", "a").alias("b"))
        pairs = cut_lineage(pairs if done is None else pairs.join(done.hint("merge"), ["u", "v"], "left_anti"))
        pairs = narrowed(pairs, pairs.count())
        done = pairs.select("u", "v") if done is None else done.unionByName(pairs.select("u", "v"))
        pairs = pairs.select("a", "b")
        found = cut_lineage(verified(pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")).hint("merge"), "a"), texts, least))
        links = found.count()
        if links:
            roots = merged(roots, narrowed(found, links))
        if plan:
            continue
        # pivots have met the whole bucket; all others go on, joined or not, while it holds two classes
        rest = members.where(F.col("turn") > pivots).select("bucket", "id", *carried)
        rest = rooted(rest, roots) if roots is not None else rest.withColumn("root", F.col("id"))
        mixed = rest.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("bucket")
        rest = cut_lineage(rest.join(mixed.hint("merge"), "bucket").select("bucket", "id", *carried))
        if pivots <= PIVOTS:  # counted twice; later rounds have few texts less
            own = cut_lineage(own_runs(rest.select("id").distinct(), texts))
            rest = rest.drop("own").join(own.hint("merge"), "id").where(F.col("n") - F.col("own") >= F.lit(least) * F.col("n") - F.lit(1e-9))
            if "odd" not in carried:
                rest = rest.join(with_parities(rest.select("id").distinct(), texts).hint("merge"), "id")
            rest = cut_lineage(rest)
        pivots *= PIVOTS
        left = rest.count()
        if left:
            plan.append(narrowed(rest, left))
    out = rows.select("id", "same").join(nodes.select("same", "same_id"), "same")
    if roots is not None:
        out = out.join(roots.withColumnsRenamed({"id": "same_id"}), "same_id", "left")
    else:
        out = out.withColumn("root", F.lit(None).cast("long"))
    named = out.select("id", F.coalesce("root", "same_id").alias("class_id"), "same_id")
    lone = docs.where(F.col(key).isNull() | F.col(text).isNull()).select(F.col(key).cast("long").alias("id")).select(
        "id", F.col("id").alias("class_id"), F.col("id").alias("same_id"))
    return named.unionByName(lone).withColumnsRenamed({"id": key, "same_id": "same_text_id"})
