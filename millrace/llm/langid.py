"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.workspace import cut_lineage

U = np.uint64
MAX_ENTRIES = 1_000_000  # four-grams of all languages in one piece of the models
MAX_CELLS = 25_000_000  # four-grams times languages in one piece: at most 100 MB of code lengths
DISCOUNT = 0.75
LEAST = 2.0  # bits per character that a text of two languages may lie above the usual
SLACK = 8.0  # rejected beyond so many deviations above the usual cross-entropy
_PIECE = 1 << 20


def _letter_table() -> np.ndarray:
    """For each 16-bit unit its lower-case unit if it is a letter or a surrogate (see ``grams``), else 0."""
    table = np.zeros(65536, np.uint16)
    for unit in range(65536):
        if 0xD800 <= unit < 0xE000:
            table[unit] = unit
        elif chr(unit).isalpha():
            low = chr(unit).lower()
            table[unit] = ord(low) if len(low) == 1 and ord(low) < 65536 else unit
    return table


_LETTERS: list[np.ndarray] = []


def grams(text: str) -> np.ndarray:
    """Four-grams of the lower-case letters of a text, as 64-bit values of four 16-bit units.

    Every run of other characters counts as one gap (0), also before and after the text. A text
    without letters has no four-gram.
    """
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    units = _LETTERS[0][np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)]
    half = (units >= 0xD800) & (units < 0xE000)
    if half.any():  # two units make one character, and only letters count
        first = np.flatnonzero(half[:-1] & half[1:] & (units[:-1] < 0xDC00) & (units[1:] >= 0xDC00))
        points = 0x10000 + ((units[first].astype(np.int64) - 0xD800) << 10) + (units[first + 1].astype(np.int64) - 0xDC00)
        letters = first[np.array([chr(c).isalpha() for c in points.tolist()], bool)]
        half[letters] = half[letters + 1] = False
        units = np.where(half, 0, units).astype(np.uint16)
    if not units.any():
        return np.zeros(0, U)
    padded = np.concatenate([[0, 0, 0], units, [0]]).astype(np.uint16)
    keep = np.ones(len(padded), bool)
    keep[4:] = (padded[4:] != 0) | (padded[3:-1] != 0)
    p = padded[keep].astype(U)
    return (p[:-3] << U(48)) | (p[1:-2] << U(32)) | (p[2:-1] << U(16)) | p[3:]


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all labelled rows; summed per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            size = 0
            for t, label in zip(batch.column(0), batch.column(1).to_pylist()):
                g = grams(t.as_py())
                held.setdefault(label, []).append(g)
                size += len(g)
                if size > 2 * _PIECE:
                    yield from _summed(held)
                    held, size = {}, 0
            yield from _summed(held)

    def _summed(held):
        for label, parts in held.items():
            values, n = np.unique(np.concatenate(parts), return_counts=True)
            if len(values):
                yield pa.record_batch([pa.array([label] * len(values)), pa.array(values.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class KneserNey:
    """One language: sorted n-gram hashes of each order with their interpolated probabilities.

    Orders 4 to 1; the top order uses counts, the lower ones the number of distinct left neighbours.
    ``level[k]`` holds the sorted n-grams and probabilities, ``weight[k]`` the sorted contexts and
    the share of probability they hand to the next lower order.

    All that a four-gram asks for, but for the single units, stands in four-grams with its third unit. So
    the four-grams of some third units, with ``units`` (single units and their distinct left neighbours)
    counted over all, give for those third units what all four-grams give.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, discount: float = DISCOUNT, units: tuple[np.ndarray, np.ndarray] | None = None):
        order = np.argsort(gram)
        keys, counts = gram[order], n[order].astype(float)
        raw = []
        for k in (4, 3, 2, 1):
            raw.append((k, keys, counts))
            keys, counts = np.unique(keys & U((1 << 16 * (k - 1)) - 1), return_counts=True) if k > 1 else (keys, counts)
            counts = counts.astype(float)
        if units is not None:
            raw[-1] = 1, units[0], units[1].astype(float)
        self.level: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.weight: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.floor = 1.0 / 65536
        for k, keys, counts in reversed(raw):
            context, at, kinds = np.unique(keys >> U(16), return_inverse=True, return_counts=True)
            total = np.bincount(at, weights=counts)
            self.weight[k] = context, discount * kinds / total
            lower = self._lower(k, keys)
            self.level[k] = keys, np.maximum(counts - discount, 0) / total[at] + (discount * kinds / total)[at] * lower

    def _lower(self, k: int, keys: np.ndarray) -> np.ndarray:
        return np.full(len(keys), self.floor) if k == 1 else self.probability(keys & U((1 << 16 * (k - 1)) - 1), k - 1)

    def probability(self, keys: np.ndarray, k: int = 4) -> np.ndarray:
        """P(last unit | the units before it), for n-grams of order ``k``."""
        out = np.zeros(len(keys))
        known, values = self.level[k]
        hit, at = _find(known, keys)
        out[hit] = values[at[hit]]
        rest = np.flatnonzero(~hit)
        if len(rest):
            contexts, weights = self.weight[k]
            seen, at = _find(contexts, keys[rest] >> U(16))
            share = np.ones(len(rest))
            share[seen] = weights[at[seen]]
            out[rest] = share * self._lower(k, keys[rest])
        return out


def _find(line: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key stands in the sorted line, and where."""
    if not len(line):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(line, keys), len(line) - 1)
    return line[at] == keys, at


class LanguageModels:
    """All languages, for the third units ``low`` to ``high``: one sorted array of known four-grams, and each language's code length for them."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray] | None]], low: int = 0, high: int = 65535):
        self.low, self.high = U(low), U(high)
        self.languages = [row[0] for row in rows]
        self.models = [KneserNey(gram, n, units=units) for _, gram, n, units in rows]
        self.known = np.unique(np.concatenate([row[1] for row in rows])) if rows else np.zeros(0, U)
        self.bits = np.stack([-np.log2(m.probability(self.known)) for m in self.models]).astype(np.float32) if rows else None

    def code_lengths(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of the four-grams with a third unit of this piece (texts × languages), and the number of all four-grams; whole texts."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        held: list[np.ndarray] = []
        ids: list[int] = []

        def flush():
            if not held:
                return
            flat = np.concatenate(held)
            hit, at = _find(self.known, flat)
            strange = np.flatnonzero(~hit)
            starts = np.concatenate([[0], np.cumsum([len(g) for g in held])[:-1]])
            for j, model in enumerate(self.models):
                bits = self.bits[j][at].astype(np.float64) if len(self.known) else np.zeros(len(flat))
                if len(strange):
                    bits[strange] = -np.log2(model.probability(flat[strange]))
                out[ids, j] = np.add.reduceat(bits, starts)
            held.clear()
            ids.clear()

        size = 0
        whole = self.low == 0 and self.high == 65535
        for i, text in enumerate(texts):
            g = grams(text) if text is not None else np.zeros(0, U)
            sizes[i] = len(g)
            if not whole:
                third = (g >> U(16)) & U(0xFFFF)
                g = g[(third >= self.low) & (third <= self.high)]
            if len(g) and self.models:
                held.append(g)
                ids.append(i)
                size += len(g)
                if size > _PIECE:
                    flush()
                    size = 0
        flush()
        return out, sizes


@dataclass(frozen=True)
class Training:
    """Counts of all four-grams, the languages, their single units, and the ranges of third units that make a piece each."""

    counts: DataFrame
    languages: list[str]
    units: dict[str, tuple[np.ndarray, np.ndarray]]
    ranges: list[tuple[int, int]]

    def piece(self, low: int, high: int) -> LanguageModels:
        rows = self.counts.where(_third().between(low, high)).toArrow()
        number = {name: j for j, name in enumerate(self.languages)}
        lang = np.array([number[x] for x in rows["lang"].to_pylist()], np.int64)
        gram, n = rows["gram"].to_numpy().view(U), rows["n"].to_numpy()
        order = np.argsort(lang, kind="stable")
        ends = np.searchsorted(lang[order], np.arange(len(self.languages) + 1))
        parts = [order[ends[j]:ends[j + 1]] for j in range(len(self.languages))]
        return LanguageModels([(name, gram[x], n[x], self.units[name]) for name, x in zip(self.languages, parts)], low, high)


def _third() -> Column:
    return F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(0xFFFF))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_entries: int | None = None) -> Training:
    """Counts from all rows of ``docs`` with a text and a language; every four-gram is kept.

    The models are dealt into pieces by ranges of the third unit, of at most ``max_entries`` four-grams and
    ``MAX_CELLS`` code lengths (or of one third unit), so that a piece can be broadcast whatever the
    input and the number of languages. Only the single units of each language are gathered for all pieces.
    """
    most = max_entries or MAX_ENTRIES
    counts = cut_lineage(count_grams(docs, text, lang))
    two, one = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF)), F.col("two").bitwiseAND(F.lit(0xFFFF))
    found: dict[str, list[tuple[int, int]]] = {}
    for r in counts.select("lang", two.alias("two")).distinct().groupBy("lang", one.alias("unit")).count().collect():
        found.setdefault(r["lang"], []).append((r["unit"], r["count"]))
    units = {name: tuple(np.array(x) for x in zip(*sorted(rows))) for name, rows in found.items()}
    units = {name: (keys.astype(U), n) for name, (keys, n) in units.items()}
    ranges, low, entries, cells = [], 0, 0, 0
    # at most 65,536 rows
    sizes = counts.groupBy(_third().alias("third"), "gram").count().groupBy("third").agg(F.sum("count").alias("n"), F.count("*").alias("known")).orderBy("third").collect()
    for r in sizes:
        wide = r["known"] * len(units)
        if entries and (entries + r["n"] > most or cells + wide > MAX_CELLS):
            ranges.append((low, r["third"] - 1))
            low, entries, cells = r["third"], 0, 0
        entries, cells = entries + r["n"], cells + wide
    return Training(counts, sorted(units), units, [*ranges, (low, 65535)])


SCORED = "best string, bits double, size long, score double"


def _best(languages: list[str], total: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """Language of lowest cross-entropy, its bits per four-gram, the number of four-grams and a 0 to 1 score."""
    best, low, share = [None] * len(sizes), np.zeros(len(sizes)), np.zeros(len(sizes))
    some = np.flatnonzero(sizes > 0) if languages else np.zeros(0, int)
    if len(some):
        b = total[some] / sizes[some][:, None]
        at = np.argmin(b, axis=1)
        low[some] = b[np.arange(len(some)), at]
        gap = (b - low[some][:, None]) * np.minimum(sizes[some], 50)[:, None]
        share[some] = 1 / np.exp2(-gap).sum(axis=1)
        for i, j in zip(some, at):
            best[i] = languages[j]
    return [pa.array(best, pa.string()), pa.array(low), pa.array(sizes), pa.array(share)]


def scored(docs: DataFrame, models: Training, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the language of lowest cross-entropy, its bits and a 0 to 1 score.

    One piece of the models is scored in one pass. Of several, one at a time is broadcast and passes over the
    texts; sums are kept per text, added in the order of the pieces and joined back.
    """
    spark, languages = docs.sparkSession, models.languages
    types = dict(docs.dtypes)
    if len(models.ranges) == 1:
        shared = spark.sparkContext.broadcast(models.piece(*models.ranges[0]))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _best(languages, *shared.value.code_lengths(batch.column(batch.num_columns - 1).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=[*keep, "best", "bits", "size", "score"])

        schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [SCORED])
        return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(score, schema)

    same = F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("same")
    parts = None
    for number, (low, high) in enumerate(models.ranges):
        shared = spark.sparkContext.broadcast(models.piece(low, high))

        def measure(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums, sizes = shared.value.code_lengths(batch.column(1).to_pylist())
                offsets = pa.array(np.arange(len(sums) + 1) * len(languages), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], names=["same", "size", "sums"])

        one = docs.select(same, F.col(text).alias("__text")).mapInArrow(measure, "same string, size long, sums array<double>")
        one = cut_lineage(one.groupBy("same").agg(F.first("size").alias("size"), F.first("sums").alias("sums")).withColumn("piece", F.lit(number)))
        parts = one if parts is None else parts.unionByName(one)
        shared.destroy()
    total = parts.groupBy("same").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("piece", "sums"))).alias("sums"))
    total = total.select("same", "size", F.aggregate(
        "sums", F.array_repeat(F.lit(0.0), len(languages)), lambda held, x: F.zip_with(held, x["sums"], lambda p, q: p + q)).alias("sums"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(languages))
            found = _best(languages, sums, batch.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["same", "best", "bits", "size", "score"])

    return docs.select(*keep, same).join(total.mapInArrow(decide, f"same string, {SCORED}"), "same").drop("same")


def identify(docs: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text", lang: str = "lang",
             slack: float = SLACK) -> DataFrame:
    """Language of every whole text: (key, learns, lang_pred, score, bits, rejected).

    ``learn`` marks the rows to learn from (default: all); of those, rows with a text and a language
    count. The prediction sees the text only and is the language with the lowest cross-entropy per
    character; ``score`` is its share against the others on at most 50 characters. A text is
    rejected if its cross-entropy lies more than ``slack`` deviations, and ``LEAST`` bits, above the median of its language
    and length class (powers of two; under 30 texts: of the language), measured on all rows; the
    deviation is the distance from the median to the 84th percentile.

    Null texts and texts without a letter, and all texts if nothing can be learnt: ``und``, score 0,
    rejected. Repeated rows stay repeated. Other columns do not matter.
    """
    learn = F.coalesce(learn, F.lit(False)) if learn is not None else F.lit(True)
    marked = docs.select(F.col(key), F.col(text), F.col(lang), (learn & F.col(lang).isNotNull()).alias("learns"))
    models = train(marked.where("learns"), text, lang)
    rows = cut_lineage(scored(marked, models, text, [key, "learns"]))
    rows = rows.withColumn("bin", F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))))
    spread = F.percentile_approx("bits", [0.5, 0.84], 10_000).alias("q")
    bins = rows.where("size > 0").groupBy("best", "bin").agg(F.count("*").alias("n"), spread)
    whole = rows.where("size > 0").groupBy("best").agg(spread)

    def limit(q: list[float]) -> float:
        return q[0] + max(slack * (q[1] - q[0]), LEAST)

    # one row per language, and 64 length classes at most: small enough to look up on the driver
    limits = {(r["best"], r["bin"]): limit(r["q"]) for r in bins.where("n >= 30").collect()}
    usual = {r["best"]: limit(r["q"]) for r in whole.collect()}
    found = [(b, k, float(v)) for (b, k), v in limits.items()] + [(b, None, float(v)) for b, v in usual.items()]
    bound = docs.sparkSession.createDataFrame(found, "best string, bin long, most double")
    by_bin = F.broadcast(bound.where("bin is not null"))
    by_lang = F.broadcast(bound.where("bin is null").select("best", F.col("most").alias("usual")))
    joined = rows.join(by_bin, ["best", "bin"], "left").join(by_lang, "best", "left")
    return joined.select(
        F.col(key), "learns", F.coalesce("best", F.lit("und")).alias("lang_pred"), "score", "bits",
        (F.col("best").isNull() | (F.col("bits") > F.coalesce("most", "usual", F.lit(float("inf"))))).alias("rejected"))
