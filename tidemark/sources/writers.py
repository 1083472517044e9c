"""Sinks and load-time stamping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), rebalance: bool = False
) -> DataFrame:
    """Write Parquet and return the table as stored.

    Every task writes a file per partition value it meets. ``rebalance`` shuffles the rows first so
    that files come out whole: by partition value, with adaptive execution cutting hot values.
    """
    columns = df.schema
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(columns).parquet(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("delimiter", delimiter).csv(path)
    return path


def split_by_key(df: DataFrame, column: str, values: Sequence, path: str, rebalance: bool = False) -> dict:
    """One table per key value, written in a single pass.

    Returns ``{value: DataFrame}``; each frame reads only its own folder through partition
    pruning, so no value costs a scan of the others.
    """
    stored = write_table(df.filter(F.col(column).isin(*values)), path, "overwrite", [column], rebalance)
    return {v: stored.filter(F.col(column) == F.lit(v)).select(*df.columns) for v in values}


def with_ingestion_ts(df: DataFrame, fmt: str | None = None, name: str = "ingestion_timestamp") -> DataFrame:
    """Stamp the load time, as a timestamp or as text in ``fmt``."""
    now = F.current_timestamp()
    return df.withColumn(name, F.date_format(now, fmt) if fmt else now)
