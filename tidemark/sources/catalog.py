"""Catalog listing, CTAS, row-count comparison and schema text."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def catalog_overview(spark: SparkSession) -> DataFrame:
    """Databases and tables with type and temporary flag (catalog metadata only)."""
    rows = []
    for db in spark.catalog.listDatabases():
        rows.append((db.name, None, "DATABASE", False))
        for t in spark.catalog.listTables(db.name):
            rows.append((None if t.isTemporary else db.name, t.name, t.tableType, t.isTemporary))
    return spark.createDataFrame(
        rows, "database string, table_name string, table_type string, is_temporary boolean"
    ).distinct()


def schema_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One ``table(col1, col2, ...)`` line per table, sorted by name."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, f"{name}({', '.join(df.columns)})") for name, df in sorted(tables.items())]
    return spark.createDataFrame(rows, "table_name string, line string")


def compare_counts(tables: Mapping[str, DataFrame], label: str = "source") -> DataFrame:
    """Labelled row counts of several tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ctas(spark: SparkSession, name: str, df: DataFrame, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table from a query; ``path`` makes it an external one."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


@contextlib.contextmanager
def with_cached_view(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Cache ``df`` under a view name for the length of a block, then release it.

    The default storage level spills to disk, so a frame larger than memory still works.
    """
    spark = df.sparkSession
    df.createOrReplaceTempView(name)
    spark.catalog.cacheTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.catalog.uncacheTable(name)
        spark.catalog.dropTempView(name)
