"""File layout jobs: compaction and clustering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from tidemark.sources.readers import file_sizes

TARGET_BYTES = 256 * 1024 * 1024
ZORDER_BITS = 6

# Rows of the sample that ranges are cut by, and characters of a text that they see.
SAMPLE_ROWS, PREFIX = 16_384, 64


def file_stats(spark: SparkSession, path: str | list[str], label: str = "") -> DataFrame:
    """Number and size of the Parquet files under one or more paths (listing only)."""
    return file_sizes(spark, path).agg(
        F.lit(label).alias("state"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.min("length").alias("min_bytes"),
        F.max("length").alias("max_bytes"),
    )


def target_files(spark: SparkSession, path: str | list[str], target_bytes: int = TARGET_BYTES) -> int:
    """How many files of ``target_bytes`` the data under ``path`` fills."""
    total = file_stats(spark, path).first()["total_bytes"]
    return max(1, -(-total // target_bytes))


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite small files as few even ones; returns the before/after file report.

    ``coalesce`` joins neighbouring input splits, so nothing is shuffled.
    """
    files = target_files(spark, path, target_bytes)
    spark.read.parquet(path).coalesce(files).write.mode("overwrite").parquet(out)
    return file_stats(spark, path, "before").unionByName(file_stats(spark, out, "after"))


def splitters(df: DataFrame, columns: Sequence[str], n: int, rows: int = SAMPLE_ROWS) -> list[list]:
    """Per column, at most ``n - 1`` ascending values that cut it into ranges of about as many rows each.

    They are picked by Spark's own order from a sample of at most ``rows`` rows, drawn by a hash of the values, so any
    type that Spark can order will do. Only the first ``PREFIX`` characters of a text are looked at: the order of texts is
    that of their beginnings, and a sample stays small.
    """
    short = [F.left(c, F.lit(PREFIX)).alias(c) if df.schema[c].dataType == StringType() else F.col(c) for c in columns]
    drawn = df.select(*short).withColumn("_row", F.monotonically_increasing_id())
    drawn = drawn.orderBy(F.xxhash64(*columns, "_row")).limit(rows)
    held = drawn.agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns])  # at most `rows` values each, without NULLs
    found = held.select(*[F.array_distinct(_quantiles(F.col(c), n)).alias(c) for c in columns]).first()
    return [[x for x in v if x is not None] for v in found]


def _quantiles(values: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get(values, F.floor(i * F.size(values) / n).cast("int")))


def _bucket(column: str, cuts: list) -> Column:
    """Number of the range that a value lies in: 0 for NULL and what is below the first cut."""
    return reduce(add, [F.when(F.col(column) >= F.lit(c), 1).otherwise(0) for c in cuts], F.lit(0))


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """Interleaved bits of the columns' range numbers: rows close in all columns sort together."""
    buckets = [_bucket(c, cuts) for c, cuts in zip(columns, splitters(df, columns, 1 << bits))]
    places = []
    for b in range(bits):
        for i, bucket in enumerate(buckets):
            bit = F.shiftright(bucket.cast("long"), b).bitwiseAND(F.lit(1))
            places.append(F.shiftleft(bit, b * len(buckets) + i))
    return reduce(add, places)


def cluster(
    df: DataFrame, columns: Sequence[str], path: str, partitions: int | None = None, like: DataFrame | None = None
) -> DataFrame:
    """Write ``df`` so that filters on ``columns`` skip files by their min/max statistics.

    Rows are dealt to ranges of the column, or of a curve through the ranges of several columns. Columns may be of any
    type that Spark can order. What closes the order is a hash of the columns and the row's place in the input, so that a
    value that most rows share, and rows that are all alike, are spread over even files too. ``like`` is a cheaper frame
    whose values of the columns are distributed alike, for the sample that the ranges of several columns are cut by.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_row", F.monotonically_increasing_id())
    by = [F.col(c) for c in columns]
    if len(columns) > 1:
        keyed = keyed.withColumn("_z", zorder_key(like if like is not None else df, columns))
        by = [F.col("_z"), *by]
    by.append(F.xxhash64(*columns, "_row"))
    ranged = keyed.repartitionByRange(partitions, *by) if partitions else keyed.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).select(*df.columns).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
