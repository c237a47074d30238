"""Removal of repeated byte strings: anchors find where to look, a hash-compared suffix sort decides.

A string of ``LENGTH`` bytes that stands twice holds the same *anchor* at the same offset in both
places: the ``GRAM``-byte substring with the smallest hash. Windows of ``LENGTH`` bytes fall into runs
that share an anchor, so a run (at most ``LENGTH - GRAM + 1`` windows) is the unit that moves between
tasks; texts move only for runs whose anchor occurs with different surroundings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.hashing import PrefixHashes, mix
from millrace.workspace import cut_lineage

U = np.uint64
LENGTH = 100
GRAM = 24
BUCKET_RUNS = 400_000  # runs judged together: about 10 MB, plus the texts of those in doubt
PART_BYTES = 16 << 20
FLUSH_RUNS = 400_000
LOCAL_HOT = 2_000  # surroundings of one anchor in one flush that mark it as hot
HOT_RUNS = 20_000  # surroundings of one anchor above which its windows are dealt out one by one
_LAST = U(2**64 - 1)

# what is said of a run
OPEN, CUT, WINDOWS, TEXT, MARK = range(5)
RUN = "ord long, occ int, first int, n int"


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (anchor hash, hash of all the run covers, first window, windows, anchor - first).

    The anchor of a window is the leftmost of its grams with the smallest upper hash half. Equal windows
    have equal anchors at equal places. The second hash tells runs with different surroundings apart.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3))
    hashes = PrefixHashes(data)
    grams = mix(hashes.fixed(gram))
    wide = length - gram + 1
    # smallest of every window by running minima of blocks, from both sides
    blocks = -(-len(grams) // wide)
    key = np.full(blocks * wide, _LAST)
    key[:len(grams)] = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    grid = key.reshape(blocks, wide)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:n], ahead[wide - 1:wide - 1 + n]) & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    after = np.concatenate([first[1:], [n]])
    anchor = place[first]
    around = mix(hashes.span(first, after - 1 + length) ^ mix(((anchor - first) * 256 + (after - first)).astype(U)))
    return grams[anchor], around, first, after - first, anchor - first


def _spread(kind, h, c, order, occ, first, n, off, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the runs that belong there."""
    bucket = (h % U(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[by]) != 0])) if len(by) else []
    columns = [x[by] for x in (kind, h.view(np.int64), c.view(np.int64), order, occ, first, n, off)]
    offsets = pa.array(np.concatenate([cuts, [len(by)]]).astype(np.int32))
    if len(by):
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[by][cuts]), *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in columns]], names=PACKED)


PACKED = ["bucket", "kind", "h", "c", "ord", "occ", "first", "n", "off"]
PACKED_SCHEMA = ("bucket long, kind array<tinyint>, h array<long>, c array<long>, ord array<long>, occ array<int>, first array<int>, "
                 "n array<smallint>, off array<smallint>")


def _first_of_equal(h, c, order, occ, first) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places, and which of them are the earliest of their (anchor, surroundings)."""
    by = np.lexsort((first, occ, order, c, h))
    new = np.ones(len(by), bool)
    new[1:] = (h[by][1:] != h[by][:-1]) | (c[by][1:] != c[by][:-1])
    return by, new


def find_runs(rows: DataFrame, buckets: int) -> DataFrame:
    """Runs of all texts, packed by bucket of the anchor; within a task only the earliest of equal runs stays open."""

    def packed(held) -> Iterator[pa.RecordBatch]:
        h, c, order, occ, first, n, off = (np.concatenate(x) for x in zip(*held))
        by, new = _first_of_equal(h, c, order, occ, first)
        h, c, order, occ, first, n, off = (x[by] for x in (h, c, order, occ, first, n, off))
        kind = np.where(new, OPEN, CUT).astype(np.int8)
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        kinds = np.add.reduceat(new, starts, dtype=np.int64)
        hot = np.repeat(kinds > LOCAL_HOT, np.diff(np.concatenate([starts, [len(h)]])))
        marks = starts[kinds > LOCAL_HOT]
        kind[hot & new] = WINDOWS
        # runs that are settled go anywhere, by their document; a hot anchor leaves one mark where its other runs go
        to = np.where(kind == OPEN, h, mix(order.astype(U)))
        parts = [(kind, to, c, order, occ, first, n, off)]
        if len(marks):
            parts.append((np.full(len(marks), MARK, np.int8), h[marks], c[marks], order[marks], occ[marks], first[marks], n[marks], off[marks]))
        for part in parts:
            yield from _spread(*part, buckets)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for order, occ, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = np.frombuffer(value.as_buffer() or b"", np.uint8)
                h, c, first, n, off = runs(data)
                if len(h):
                    held.append((h, c, np.full(len(h), order, np.int64), np.full(len(h), occ, np.int32), first.astype(np.int32), n.astype(np.int16), off.astype(np.int16)))
                    size += len(h)
                if size >= FLUSH_RUNS:
                    yield from packed(held)
                    held, size = [], 0
        if held:
            yield from packed(held)

    return rows.select("ord", "occ", "text").mapInArrow(find, PACKED_SCHEMA)


def judge_runs(packed: DataFrame) -> DataFrame:
    """Say of each run whether it is cut, needs its text or its windows looked at; runs found unique get no row."""

    def judge(table: pa.Table) -> pa.Table:
        kind, h, c, order, occ, first, n, off = (
            np.concatenate([np.asarray(x.flatten()) for x in table[name].chunks]) for name in PACKED[1:])
        settled = np.flatnonzero((kind == CUT) | (kind == WINDOWS))
        marked = h[kind == MARK]
        some = np.flatnonzero(kind == OPEN)
        by, new = _first_of_equal(h[some], c[some], order[some], occ[some], first[some])
        by = some[by]
        said = np.where(new, OPEN, CUT).astype(np.int8)
        if len(by):
            starts = np.flatnonzero(np.concatenate([[True], h[by][1:] != h[by][:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(by)]]))
            kinds = np.repeat(np.add.reduceat(new, starts, dtype=np.int64), sizes)
            spread = (kinds > HOT_RUNS) | np.isin(h[by], marked)
            said[new & spread] = WINDOWS
            said[new & ~spread & (kinds > 1)] = TEXT
        keep = said != OPEN
        at = np.concatenate([settled, by[keep]])
        return pa.table({
            "kind": np.concatenate([kind[settled], said[keep]]), "h": h[at], "ord": order[at], "occ": occ[at], "first": first[at],
            "n": n[at].astype(np.int32), "off": off[at].astype(np.int32)})

    return packed.groupBy("bucket").applyInArrow(judge, "kind tinyint, h long, ord long, occ int, first int, n int, off int")


# --- the suffix sort -----------------------------------------------------------------------


def common_extension(hashes: PrefixHashes, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common start of the suffixes at ``x`` and ``y``, at most ``most``: binary search on equal hashes."""
    low, high = np.zeros(len(x), np.int64), most.astype(np.int64).copy()
    while (busy := np.flatnonzero(low < high)).size:
        middle = (low[busy] + high[busy] + 1) // 2
        a, b = x[busy], y[busy]
        same = hashes.span(a, a + middle) == hashes.span(b, b + middle)
        low[busy] = np.where(same, middle, low[busy])
        high[busy] = np.where(same, high[busy], middle - 1)
    return low


def suffix_order(hashes: PrefixHashes, data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sort of suffixes within groups: (order, longest common start with any other of the group).

    Each comparison takes a number of hash probes logarithmic in the suffix length. Both halves of
    a merge find their places in the other by binary search, all merges of a level at once.
    """
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    begins = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]])) if len(order) else np.zeros(0, int)
    counts = np.diff(np.concatenate([begins, [len(order)]]))
    base, number = np.repeat(begins, counts), np.repeat(counts, counts)
    place = np.arange(len(order)) - base

    def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        most = np.minimum(size[a], size[b])
        k = common_extension(hashes, start[a], start[b], most)
        ended = k == most
        last = len(data) - 1
        at, bt = data[np.minimum(start[a] + k, last)].astype(np.int16), data[np.minimum(start[b] + k, last)].astype(np.int16)
        return np.where(ended, size[a] - size[b], at - bt)

    width = 1
    while len(order) and width < counts.max():
        block = place // (2 * width) * (2 * width)
        left = place - block < width
        begin = np.minimum(np.where(left, block + width, block), number)
        low, high = begin.copy(), np.minimum(np.where(left, block + 2 * width, block + width), number)
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) // 2
            other = compare(order[base[busy] + middle], order[busy])
            before = (other < 0) | ((other == 0) & ~left[busy])
            low[busy] = np.where(before, middle + 1, low[busy])
            high[busy] = np.where(before, high[busy], middle)
        rank = block + place - np.where(left, block, block + width) + low - begin
        merged = np.empty_like(order)
        merged[base + rank] = order
        order = merged
        width *= 2
    longest = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        pairs = np.flatnonzero(group[a] == group[b])
        k = common_extension(hashes, start[a[pairs]], start[b[pairs]], np.minimum(size[a[pairs]], size[b[pairs]]))
        np.maximum.at(longest, a[pairs], k)
        np.maximum.at(longest, b[pairs], k)
    return order, longest


def repeated_windows(h, order, occ, first, n, off, texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows with an earlier equal one among runs of the same anchor: (run, first window, windows).

    Two suffix sorts per group, one to the right of the anchor and one of the reversed text to its left,
    give how far each run agrees with any other on either side, which leaves few windows in doubt. Those are
    grouped by hash, and each is compared byte by byte with the earliest of its group.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    anchor = begins + off
    hashes = PrefixHashes(data)
    _, group = np.unique(h, return_inverse=True)
    _, right = suffix_order(hashes, data, anchor, ends - anchor, group)
    backward = np.ascontiguousarray(data[::-1])
    _, left = suffix_order(PrefixHashes(backward), backward, len(data) - anchor, anchor - begins, group)
    low = np.maximum(0, off - left)
    high = np.minimum(n - 1, off + right - length)
    number = np.maximum(0, high - low + 1)
    run = np.repeat(np.arange(len(texts)), number)
    t = np.arange(len(run)) - np.repeat(np.cumsum(number) - number, number) + low[run]
    at = begins[run] + t
    value = hashes.span(at, at + length)
    by = np.lexsort((first[run] + t, occ[run], order[run], value, group[run]))
    new = np.ones(len(by), bool)
    new[1:] = (value[by][1:] != value[by][:-1]) | (group[run[by]][1:] != group[run[by]][:-1])
    head = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    repeat = np.zeros(len(by), bool)
    later = np.flatnonzero(~new)
    reach = np.arange(length)
    for some in np.array_split(later, max(1, len(later) // 20_000)):
        same = (data[at[by[some]][:, None] + reach] == data[at[head[some]][:, None] + reach]).all(axis=1)
        repeat[by[some[same]]] = True
        for i in some[~same]:  # one hash, different bytes: look through the group
            group_ = np.flatnonzero(head == head[i])
            mine = data[at[by[i]]:at[by[i]] + length].tobytes()
            repeat[by[i]] = any(data[at[by[j]]:at[by[j]] + length].tobytes() == mine for j in group_[group_ < i])
    where = np.flatnonzero(repeat)
    if not len(where):
        return (np.zeros(0, np.int64),) * 3
    split = np.flatnonzero(np.concatenate([[True], (run[where][1:] != run[where][:-1]) | (t[where][1:] != t[where][:-1] + 1)]))
    return run[where][split], t[where][split], np.diff(np.concatenate([split, [len(where)]]))


def judge_texts(wanted: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """Cut windows of runs whose anchor has different surroundings elsewhere."""
    asked = wanted.groupBy("ord").agg(F.collect_list(F.struct("occ", "h", "first", "n", "off")).alias("asked"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for order, occ, asked, value in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                data = bytes(value.as_buffer())
                for r in (r for r in asked if r["occ"] == occ):
                    out.append((r["h"] % buckets, r["h"], order, occ, r["first"], r["n"], r["off"], data[r["first"]:r["first"] + r["n"] - 1 + LENGTH]))
                if len(out) > 50_000:
                    yield _rows(out)
                    out = []
            yield _rows(out)

    def _rows(out):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["bucket", "h", "ord", "occ", "first", "n", "off", "text"])

    def judge(table: pa.Table) -> pa.Table:
        h, order, occ, first, n, off = (table[c].to_numpy() for c in ("h", "ord", "occ", "first", "n", "off"))
        run, t, k = repeated_windows(h, order, occ, first.astype(np.int64), n.astype(np.int64), off.astype(np.int64), table["text"].to_pylist())
        return pa.table({"ord": order[run], "occ": occ[run], "first": (first[run] + t).astype(np.int32), "n": k.astype(np.int32)})

    texts = rows.join(asked, "ord").select("ord", "occ", "asked", "text").mapInArrow(
        fetch, "bucket long, h long, ord long, occ int, first int, n int, off int, text binary")
    return texts.groupBy("bucket").applyInArrow(judge, RUN)


def judge_windows(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Cut windows of hot anchors one by one: the earliest per hash is an aggregate, so no key gets one task's rows.

    Windows are told apart by two independent 64-bit hashes.
    """
    asked = wanted.groupBy("ord").agg(F.collect_list(F.struct("occ", "first", "n")).alias("asked"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, occ, asked, value in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                one, two = PrefixHashes(data), PrefixHashes(mix(data.astype(U)))
                at = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.arange(r["first"], r["first"] + r["n"]) for r in asked if r["occ"] == occ]]))
                for some in np.array_split(at, max(1, len(at) // 50_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one.span(some, some + LENGTH).view(np.int64)), pa.array(two.span(some, some + LENGTH).view(np.int64)),
                         pa.array(np.full(len(some), order, np.int64)), pa.array(np.full(len(some), occ, np.int32)), pa.array(some.astype(np.int32))],
                        names=["one", "two", "ord", "occ", "first"])

    found = cut_lineage(rows.join(asked, "ord").select("ord", "occ", "asked", "text").mapInArrow(windows, "one long, two long, ord long, occ int, first int"))
    earliest = found.groupBy("one", "two").agg(F.min(F.struct("ord", "occ", "first")).alias("e"), F.count("*").alias("k")).where("k > 1")
    return found.join(earliest, ["one", "two"]).where(F.struct("ord", "occ", "first") != F.col("e")).select("ord", "occ", "first", F.lit(1).alias("n"))


def _kept(data: np.ndarray, cuts: list) -> tuple[int, int, np.ndarray]:
    """Bytes removed, maximal removed runs, and the bytes left."""
    change = np.zeros(len(data) + 1, np.int64)
    for r in cuts:
        change[r["first"]] += 1
        change[r["first"] + r["n"] - 1 + LENGTH] -= 1
    gone = np.cumsum(change[:-1]) > 0
    starts = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(bool(len(gone)) and bool(gone[0]))
    return int(gone.sum()), starts, data[~gone]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts without the bytes of any 100-byte string that starts earlier too: (key, n_bytes, n_removed, n_spans, kept).

    Earlier means in a document of smaller key, or before in the same one; strings are judged on the
    input. ``kept`` is the rest of the UTF-8 bytes, which may cut characters.

    Null texts count as empty, texts under 100 bytes stay whole. Null keys come first; rows of
    one key are ordered by text. Repeated rows stay repeated. Other columns do not matter.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.coalesce("id", F.lit(-(2**63))))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    repeated = not rows.groupBy("ord").agg(F.count("*").alias("k")).where("k > 1").isEmpty()
    occ = F.row_number().over(Window.partitionBy("ord").orderBy("text")) if repeated else F.lit(0)
    # at least as many parts as a shuffle has, else the joins below would deal the texts again
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    rows = rows.withColumn("occ", occ).select("ord", "occ", "id", F.col("text").cast("binary").alias("text"))
    # dealt once by document, and read three times from there; a lost executor's part is read again
    rows = rows.repartition(parts, "ord").persist(StorageLevel.MEMORY_AND_DISK)
    buckets = max(1, total // (36 * BUCKET_RUNS))
    judged = cut_lineage(judge_runs(find_runs(rows, buckets)))
    cuts = judged.where(F.col("kind") == CUT).select("ord", "occ", "first", "n")
    cuts = cuts.unionByName(judge_texts(judged.where(F.col("kind") == TEXT), rows, 4 * buckets))
    single = judged.where(F.col("kind") == WINDOWS)
    if not single.isEmpty():
        cuts = cuts.unionByName(judge_windows(single, rows))
    listed = cuts.groupBy("ord").agg(F.collect_list(F.struct("occ", "first", "n")).alias("cuts"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for occ, found, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                data = np.frombuffer(value.as_buffer(), np.uint8)
                removed, number, rest = _kept(data, [r for r in found or () if r["occ"] == occ])
                sizes.append(len(data))
                gone.append(removed)
                spans.append(number)
                kept.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans)), pa.array(kept, pa.binary())],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.join(listed, "ord", "left").select("id", "occ", "cuts", "text").mapInArrow(
        finish, f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept binary")
