"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import materialize, ship_package, small_batches

# Words are runs of bytes other than the ASCII blanks; ``bytes.split()`` cuts at the same six.
BLANKS = "\x20\x09-\x0d"

# Rows of a side that may be broadcast: at most this many ids or small tuples, counted before the join.
BROADCAST_ROWS = 1_000_000


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, and keep Arrow batches small."""
    ship_package(spark)
    small_batches(spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read again: computed once, no lineage left."""
    return materialize(df, f"llm-{label}")


def texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only key and text, a null text as the empty one; other columns cannot clash."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text with A-Z in lower case, and no other letter changed."""
    return text.lower().split()


def n_words(text: Column) -> Column:
    """Number of words of a text, on the JVM; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def same_type(df: DataFrame, column: str, name: str) -> StructField:
    return StructField(name, df.schema[column].dataType, True)


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None]],
    schema: StructType | str,
) -> DataFrame:
    """Run a function over Arrow batches; ``make`` builds it once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        try:
            for batch in batches:
                out = step(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                elif out is not None:
                    yield from out
        finally:  # the worker lives on for other tasks
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def hint_if_counted(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow frame of ``rows`` counted rows if they are few; else any join strategy."""
    return F.broadcast(df) if rows <= limit else df
