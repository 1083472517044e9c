"""Ranks and running totals as distributed prefix sums, so that no hot key ends up in one task.

A plain window sorts every row of a key in one task. Here the rows are dealt to ranges of (key, order,
tie-breaker) by sampled splitters and written out with the number of their range. Each (key, range) is
windowed on its own, and shifted by the totals of the same key in the ranges before it. There is one path
for every size, and any type that Spark can order will do as key, order or tie-breaker.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import materialize

# Most rows per key for which Spark turns a rank filter into a limit per task (a Spark setting's default).
GROUP_LIMIT = 1000

_RANGE, _LOCAL, _BEFORE = "_tide_range", "_tide_local", "_tide_before"


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key. ``order`` must end in a unique column to be repeatable.

    Up to ``GROUP_LIMIT`` rows, Spark turns the rank filter into a per-task limit before the shuffle, so at
    most ``n`` rows per key and task travel, however hot the key is. More rows are ranked by ranges.
    """
    if n > GROUP_LIMIT:
        return _numbered(df, keys, order, "_rn").filter(F.col("_rn") <= n).drop("_rn")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    tie_breaker: str,
    descending: bool = False,
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """``row_number`` per key over ``order_by``, ties broken by the unique ``tie_breaker``.

    NULLs sort as Spark sorts them: first when ascending, last when descending. Without ``keys`` all rows
    are ranked together. ``partitions`` sets the number of ranges; by default Spark's own setting does.
    """
    direction = Column.desc if descending else Column.asc
    ordering = [order_by] if isinstance(order_by, str) else list(order_by)
    order = [*(direction(F.col(c)) for c in ordering), F.col(tie_breaker).asc()]
    return _numbered(df, keys, order, name, partitions)


def running_total(
    df: DataFrame, keys: Sequence[str], order_by: str, value: Column, name: str, partitions: int | None = None
) -> DataFrame:
    """Running sum of ``value`` per key; ``order_by`` must be unique within a key."""
    order = [F.col(order_by).asc()]
    valued = _dealt(df.withColumn("_tide_value", value), keys, order, partitions)
    total = F.sum("_tide_value")
    frame = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    nothing = F.col(_LOCAL).isNull() & F.col(_BEFORE).isNull()
    both = F.coalesce(_LOCAL, F.lit(0)) + F.coalesce(_BEFORE, F.lit(0))
    shifted = _shifted(valued.withColumn(_LOCAL, total.over(frame)), valued, keys, total)
    return shifted.withColumn(name, F.when(nothing, None).otherwise(both)).drop("_tide_value", _LOCAL, _BEFORE)


def _numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, partitions: int | None = None
) -> DataFrame:
    dealt = _dealt(df, keys, order, partitions)
    local = F.row_number().over(Window.partitionBy(*keys, _RANGE).orderBy(*order))
    shifted = _shifted(dealt.withColumn(_LOCAL, local), dealt, keys, F.count(F.lit(1)))
    number = F.col(_LOCAL).cast("long") + F.coalesce(_BEFORE, F.lit(0))
    return shifted.withColumn(name, number).drop(_LOCAL, _BEFORE)


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[Column], partitions: int | None) -> DataFrame:
    """``df`` written in ranges that ascend with keys and order, each row with its range's number.

    What is written stays as it is: a later recomputation cannot move a row to another range. A number of
    ranges that the caller does not fix is coalesced by adaptive execution, which joins neighbours only.
    """
    by = [*(F.col(k).asc() for k in keys), *order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return materialize(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")


def _shifted(local: DataFrame, dealt: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """Add to each row the total of its key in earlier ranges, NULL where there is none.

    Ranges follow the keys, so only the first key of a range can have begun in an earlier one: there is at
    most one offset for each range, whatever the data, which is why they are broadcast.
    """
    parts = [*keys, _RANGE]
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*parts).agg(total.alias("_tide_total"))
    offsets = totals.withColumn(_BEFORE, F.sum("_tide_total").over(before)).filter(F.col(_BEFORE).isNotNull())
    offsets = F.broadcast(materialize(offsets.select(*parts, _BEFORE), "offsets"))
    match = reduce(Column.__and__, [F.col(f"r.{p}").eqNullSafe(F.col(f"o.{p}")) for p in parts])
    joined = local.alias("r").join(offsets.alias("o"), match, "left")
    return joined.select("r.*", F.col(f"o.{_BEFORE}")).drop(_RANGE)
