"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from tidemark.sources.readers import RESCUED, rescued_lines, rescued_schema


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
    rescue: bool = False,
    options: dict | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream, oldest first.

    ``max_files`` bounds one micro-batch. With ``rescue`` what does not fit is kept in ``_rescued_data`` instead of
    failing or vanishing; CSV columns are then found by each file's own header, as ``read_rescued`` does.
    """
    if rescue and fmt == "csv":
        lines = spark.readStream.option("latestFirst", "false")
        if max_files:
            lines = lines.option("maxFilesPerTrigger", str(max_files))
        return rescued_lines(lines.options(**(options or {})).text(path), schema)
    reader = spark.readStream.format(fmt).schema(rescued_schema(schema) if rescue else schema)
    reader = reader.option("latestFirst", "false")
    if fmt == "csv":
        reader = reader.option("header", "true")
    if rescue:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stored Parquet table as a stream of its present and later files."""
    return stream_files(spark, path, spark.read.parquet(path).schema, max_files=max_files)


def stream_rate(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Generated ``(timestamp, value)`` rows in real time."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks reject ``timestamp_ntz``; read such a column as a session-zone timestamp."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df
