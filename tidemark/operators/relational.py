"""Joins, sets, sampling and aggregation helpers that plain DataFrame calls do not already give."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import range_partition
from tidemark.operators.ordered import top_n_per_key
from tidemark.session import broadcast_if_small, materialize


def quality_filter(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and a one-row report of rejects per rule.

    A rule that evaluates to NULL rejects the row, as a WHERE clause does.
    """
    kept = df.filter(reduce(Column.__and__, rules.values()))
    failed = [F.count_if(~F.coalesce(r, F.lit(False))).alias(f"rejected_{n}") for n, r in rules.items()]
    return kept, df.agg(F.count(F.lit(1)).alias("total_rows"), *failed)


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of either side without a partner, NULL for the other side's columns.

    Two anti joins give what a full outer join plus filter gives, without building the matches;
    the probing side of an anti join can be split on skew, which a full outer join cannot.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left_only = left.join(right.select(*keys).distinct(), keys, "left_anti")
    right_only = right.join(left.select(*keys).distinct(), keys, "left_anti")
    columns = [*keys, *[c for c in (*left.columns, *right.columns) if c not in keys]]
    return left_only.unionByName(right_only, allowMissingColumns=True).select(*columns)


def lookup_twice(
    fact: DataFrame, dim: DataFrame, dim_key: str, first_key: str, second_key: str, prefixes: tuple[str, str]
) -> DataFrame:
    """Left join one lookup table under two roles; its other columns come back prefixed."""
    out = fact
    for key, prefix in zip((first_key, second_key), prefixes):
        side = dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])
        out = out.join(broadcast_if_small(side), F.col(key) == F.col(f"{prefix}_{dim_key}"), "left")
    return out


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return top_n_per_key(df, keys, order, 1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the newest, given descending ``order`` columns ending in a tie-breaker."""
    return top_n_per_key(df, keys, order, 1)


def share_pct(df: DataFrame, key: str, count_name: str = "row_count", pct_name: str = "share_pct") -> DataFrame:
    """Rows per key and their percentage of the total.

    One pass over the rows: the counts per key are written out, and the total is a scalar subquery over these.
    """
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)), "shares")
    total = counts.agg(F.sum(count_name).alias("total")).scalar()
    return counts.withColumn(pct_name, F.col(count_name) * F.lit(100.0) / total)


def sample_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows picked by the md5 order of a unique ``key``: random-looking yet repeatable.

    Hashes of unique keys are uniform, so all but about ``n`` rows are dropped by a hash bound
    before the sort, and the rest is stored so that it is picked out only once. Should the bound
    keep fewer than ``n`` rows, it is not used.
    """
    digest = F.md5(F.col(key).cast("string"))
    total = df.count()
    candidates = df
    wanted = n + 10 * int(n**0.5) + 100
    if total > 4 * wanted:
        fraction = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
        bounded = materialize(df.filter(fraction < F.lit(wanted / total)), "sample")
        if bounded.count() >= n:
            candidates = bounded
    return candidates.orderBy(digest, F.col(key)).limit(n)


def best_match(
    df: DataFrame, exact: Mapping[str, object], lowest: Sequence[str], highest: Sequence[str], tie_breaker: str, n: int = 1
) -> DataFrame:
    """Exact matches, cheapest first, then best rated."""
    kept = df.filter(reduce(Column.__and__, [F.col(c) == F.lit(v) for c, v in exact.items()]))
    order = [*[F.col(c).asc() for c in lowest], *[F.col(c).desc() for c in highest], F.col(tie_breaker).asc()]
    return kept.orderBy(*order).limit(n)


def filtered_totals(df: DataFrame, predicate: Column, totals: Mapping[str, Column]) -> DataFrame:
    return df.filter(predicate).agg(*[F.sum(c).alias(name) for name, c in totals.items()])


def partition_counts(df: DataFrame, column: str, bounds: Sequence, groups: Sequence[str]) -> DataFrame:
    """Rows per range partition with its storage group; empty partitions are kept with 0."""
    if len(groups) != len(bounds) + 1:
        raise ValueError("one storage group per partition is needed")
    counts = df.groupBy(range_partition(column, bounds).alias("partition_number")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    layout = df.sparkSession.createDataFrame(
        list(enumerate(groups, start=1)), "partition_number int, storage_group string"
    )
    return counts.join(layout, "partition_number", "right").select(
        "partition_number", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "storage_group"
    )


def repartition_by_key(df: DataFrame, keys: Sequence[str], salts: int = 1, partitions: int | None = None) -> DataFrame:
    """Co-locate rows by key; with ``salts`` > 1 each key is spread over that many places."""
    by = [F.col(k) for k in keys]
    if salts > 1:
        by.append(F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    return df.repartition(partitions, *by) if partitions else df.repartition(*by)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max, one row per column, in one pass over the data."""
    aggs = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*aggs).alias("stats")).select(F.inline("stats"))
