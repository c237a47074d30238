"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def day_partition(spark: SparkSession, path: str, day: str, column: str = "date") -> DataFrame:
    """One day of a date-partitioned table.

    The root is read and filtered, so Spark lists only that partition and the column is kept.
    """
    return spark.read.parquet(path).where(F.col(column) == F.lit(day).cast("date"))


class UnfilteredScan(ValueError):
    """A guarded table was asked for without a condition on its partition column."""


# Comparisons that bound a column when its other side is a constant.
BOUNDS = {"Between", "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual", "In", "InSet"}


def _children(node) -> list:
    found = node.children()
    return [found.apply(i) for i in range(found.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _bounds(node, column_id: int) -> bool:
    """Whether a resolved predicate can only hold on a bounded set of values of one column.

    Of a conjunction one side is enough, of a disjunction both have to be bounded.
    """
    kind = _kind(node)
    parts = [node.input(), node.lower(), node.upper()] if kind == "Between" else _children(node)
    if kind == "And":
        return any(_bounds(p, column_id) for p in parts)
    if kind == "Or":
        return all(_bounds(p, column_id) for p in parts)
    if kind not in BOUNDS:
        return False

    def is_column(part) -> bool:
        while _kind(part) == "Cast":
            part = _children(part)[0]
        return _kind(part) == "AttributeReference" and part.exprId().id() == column_id

    # A constant null compares to nothing; folding leaves no rows, so it bounds as well.
    return sum(is_column(p) for p in parts) == 1 and all(is_column(p) or p.foldable() for p in parts)


def guarded_scan(df: DataFrame, partition_column: str, condition: Column | None) -> DataFrame:
    """Scan of a table that must not be read whole: the condition has to bound its partition column.

    The analysed predicate is read: some conjunct must compare the column itself, at most cast, with
    a constant. A mere mention of its name, a test for null or a comparison with itself is refused.
    """
    if condition is None:
        raise UnfilteredScan(f"a filter on {partition_column} is required")
    kept = df.where(condition)
    plan = kept._jdf.queryExecution().analyzed()
    output = _children(plan)[0].output()
    ids = [a.exprId().id() for a in (output.apply(i) for i in range(output.size())) if a.name().lower() == partition_column.lower()]
    if _kind(plan) != "Filter" or not any(_bounds(plan.condition(), i) for i in ids):
        raise UnfilteredScan(f"a filter on {partition_column} is required")
    return kept


def look_back(column: Column | str, as_of: str, days: int) -> Column:
    """``as_of - days <= column <= as_of``, both ends included."""
    c = F.col(column) if isinstance(column, str) else column
    end = F.lit(as_of).cast("date")
    return c.cast("date").between(F.date_sub(end, days), end)


def typed(value, kind: str) -> Column:
    """A collected value as a literal of its column's type; a time without a zone is not moved to one."""
    return F.lit(str(value)).cast(kind) if kind == "timestamp_ntz" and value is not None else F.lit(value).cast(kind)


def after_mark(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows newer than a stored high-water mark; all rows when there is none yet."""
    return df if mark is None else df.where(F.col(column) > typed(mark, dict(df.dtypes)[column]))
