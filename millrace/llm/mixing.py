"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.workspace import cut_lineage

PARTS = 256  # hash parts into which equal (source, size) classes are cut for ranking
STEPS = 60
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than blank, tab and the line breaks; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, source: str, weights: list[float]) -> DataFrame:
    """``weight`` by the place of a source in code point order, null last, repeating ``weights``.

    One row per source goes through one window.
    """
    w = Window.orderBy(F.col(source).asc_nulls_last())
    place = F.pmod(F.row_number().over(w) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place + 1).cast("int")))


def capped_targets(sources: DataFrame, most: float) -> DataFrame:
    """Add ``target``: the total of ``source_size`` shared by ``weight``, none above ``most`` times its size.

    The excess is reshared by weight. Sources at their cap come first in the order of cap per unit of
    weight, so prefix sums give the level of the others; one row per source goes through one window.
    """
    ratio = most * F.col("source_size") / F.col("weight")
    first = Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = sources.withColumn("ratio", ratio).withColumn("total", F.sum("source_size").over(whole))
    levels = levels.withColumn(
        "level", (F.col("total") - F.coalesce(F.sum(most * F.col("source_size")).over(first), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source whose level does not pass its own ratio gives the level of all after it
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(whole)["level"]
    return levels.withColumn("common", level).select(
        *sources.columns,
        F.when(F.col("common").isNull(), most * F.col("source_size")).otherwise(F.least(most * F.col("source_size"), F.col("common") * F.col("weight"))).cast("double").alias("target"))


def entropy_rates(classes: DataFrame, targets: DataFrame, group: str, most: float, tolerance: float = 1e-10) -> DataFrame:
    """Rates of least relative entropy that meet the token constraint of each group.

    ``classes`` has (group, size, n): n documents of one size. Words are the base measure, so the
    solution has the form ``rate = min(most, exp(tilt))`` with one multiplier per constraint. Newton steps
    on the convex dual start from the plain corpus (tilt 0); each is one aggregate over the classes,
    and the multipliers stay in a table. Returns (group, tilt, rate).
    """
    key = F.col(f"t.{group}").eqNullSafe(F.col(f"c.{group}"))
    goal = targets.select(group, F.col("target"), F.lit(0.0).alias("tilt"), F.lit(False).alias("met"))
    state = cut_lineage(goal)
    for _ in range(STEPS):
        rate = F.least(F.lit(float(most)), F.exp("tilt"))
        words = F.col("n") * F.col("size")
        sums = state.alias("t").join(classes.alias("c"), key, "left").groupBy(F.col(f"t.{group}").alias(group), "target", "tilt").agg(
            F.coalesce(F.sum(words * rate), F.lit(0.0)).alias("got"))
        # with words as base measure the slope of the dual is the sum itself
        step = F.when(F.col("got") > 0, (F.col("target") - F.col("got")) / F.col("got")).otherwise(0.0)
        met = F.abs(F.col("target") - F.col("got")) <= tolerance * F.greatest(F.col("target"), F.lit(1.0))
        # a step of more than 2 leaves the region where the second-order model holds
        state = cut_lineage(sums.select(
            group, "target", F.when(met, F.col("tilt")).otherwise(F.col("tilt") + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step))).alias("tilt"), met.alias("met")))
        if state.where(~F.col("met")).isEmpty():
            break
    return state.select(group, "tilt", F.least(F.lit(float(most)), F.exp("tilt")).alias("rate"))


def _rounded(classes: pa.Table) -> pa.Table:
    """How many documents of each size of one source get one copy more (``more``).

    From the largest size down, the words still due decide; what a size leaves over or takes too much is
    carried to the next, so the source ends within half its smallest documents. One row per distinct size.
    """
    classes = classes.sort_by([("size", "descending")])
    due, more = 0.0, []
    for size, n, rate, whole in zip(*(classes[c].to_pylist() for c in ("size", "n", "rate", "whole"))):
        due += max(0.0, rate - whole) * n * size
        least, most = 0, n if rate > whole + 1e-9 else 0
        extra = max(least, min(most, int(due / size + 0.5))) if size else round(max(0.0, rate - whole) * n)
        due -= extra * size
        more.append(extra)
    return classes.drop_columns(["rate"]).append_column("more", pa.array(more, pa.int64()))


def mix(docs: DataFrame, weights: list[float] = (5.0, 2.0, 1.0), most: int = 3, key: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """How often the mix takes each document: (key, source, size, source_size, target, copies, taken).

    Sources share the words of all documents by ``weights`` (see ``cyclic_weights``), at most ``most``
    times their own. Every document of a source gets the rate that solves the entropy dual, and
    rates are rounded to whole copies: from the largest size down, the words still due decide how many
    documents of each size get one copy more; which ones is decided by the hash of the key. Ranks are taken in hash parts, so no task
    gets all rows of one source and size.

    A null source is a source of its own. Documents without words have size 0 and get their rate like
    others, their copies count no words. Repeated rows count as documents of their own and may differ
    in copies. An empty table gives an empty result. Other columns do not matter.
    """
    rows = cut_lineage(docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
        .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int")))
    parts = cut_lineage(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")))
    classes = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = cut_lineage(capped_targets(cyclic_weights(sizes, "source", list(weights)), float(most)))
    rates = entropy_rates(classes, targets, "source", float(most))
    same = lambda a, b, *cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    plan = targets.alias("a").join(rates.alias("b"), same("a", "b", "source")).select("a.source", "source_size", "target", "rate")
    plan = classes.alias("a").join(plan.alias("b"), same("a", "b", "source")).select("a.source", "size", "n", "source_size", "target", "rate")
    plan = plan.withColumn("whole", F.floor(F.col("rate") + 1e-9))
    plan = plan.groupBy("source").applyInArrow(_rounded, "source string, size long, n long, source_size long, target double, whole long, more long")
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = parts.alias("p").join(plan.alias("q"), same("p", "q", "source", "size")).select(
        "p.source", "p.size", "p.part", F.col("p.n").alias("n"), "source_size", "target", "whole", "more")
    cut = cut.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("key", F.lit(1)), "key"))
    ranked = rows.withColumn("place", place)
    out = ranked.alias("r").join(cut.alias("c"), same("r", "c", "source", "size", "part"))
    copies = (F.col("whole") + F.when(F.col("earlier") + F.col("place") <= F.col("more"), 1).otherwise(0)).cast("long")
    return out.select(
        F.col("key").alias(key), F.col("r.source").alias(source), F.col("r.size").alias("size"),
        F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"), (copies * F.col("r.size")).alias("taken"))
