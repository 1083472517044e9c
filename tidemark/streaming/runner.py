"""Run a streaming frame into a sink until its input is used up, and hand back a batch frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, TimeoutError as LimitPassed

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import top_n_per_key
from tidemark.session import workspace

BATCH = "_batch_id"


class StreamTimeout(RuntimeError):
    """A stream had not used up its input when its time limit passed; what it committed stays committed."""


def run_stream(
    df: DataFrame,
    mode: str = "append",
    sink: str = "parquet",
    path: str | None = None,
    checkpoint: str | None = None,
    keys: Sequence[str] = (),
    trigger: dict | None = None,
    limit_seconds: float | None = None,
    progress: list[dict] | None = None,
    once_per_batch: bool = False,
) -> DataFrame:
    """Drive ``df`` over all input at hand and return what the sink holds.

    ``append`` writes through the exactly-once Parquet sink (``sink="table"`` also registers the
    result as a catalog table). ``complete`` overwrites one folder per batch. ``update`` stores each
    batch's changed rows under its batch number and returns the last row per ``keys``; a replayed
    batch overwrites its own folder. ``once_per_batch`` says that a batch gives each key once, as an aggregation
    grouped by ``keys`` does: what a single batch has written is then returned without a ranking.
    ``sink="memory"`` holds the result in the driver: only for results known to be small.

    The default trigger is ``availableNow``. A query with a clock trigger such as ``{"processingTime": "5 seconds"}``
    has no end of its own: it is stopped once it has committed all that its sources had to give. ``limit_seconds`` is
    a limit that raises ``StreamTimeout`` when it passes before that, for sources that never run dry; no result is
    ever a part of the input. ``progress`` gets Spark's progress reports.
    """
    spark = df.sparkSession
    path = path or workspace(spark, "stream")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or f"{path}-checkpoint")
    trigger = trigger or {"availableNow": True}
    writer = writer.trigger(**trigger)
    name = f"{sink}_" + path.rsplit("-", 1)[-1]
    finish = lambda query: _finish(query, trigger, limit_seconds, progress)
    if sink == "memory":
        finish(writer.format("memory").queryName(name).start())
        return spark.table(name)
    if sink == "table":
        finish(writer.option("path", path).format("parquet").toTable(name))
        return spark.table(name)
    if mode == "append":
        finish(writer.format("parquet").start(path))
        return stored(spark, path, df)
    if mode == "complete":
        finish(writer.foreachBatch(_overwrite(path)).start())
        return stored(spark, path, df)
    finish(writer.foreachBatch(_keep_batch(path)).start())
    changed = stored(spark, path, df.withColumn(BATCH, F.lit(0).cast("long")))
    return last_per_key(changed, keys, once_per_batch) if keys else changed


def last_per_key(changed: DataFrame, keys: Sequence[str], once_per_batch: bool = False) -> DataFrame:
    """The row of the latest batch per key. Where a batch gives each key once, and all rows are of the same batch,
    these are the rows themselves; to see that reads the batch numbers only, which are folder names."""
    if once_per_batch:
        first, last = changed.agg(F.min(BATCH), F.max(BATCH)).first()
        if first == last:
            return changed.drop(BATCH)
    return top_n_per_key(changed, keys, [F.col(BATCH).desc()]).drop(BATCH)


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What a sink wrote so far; empty if nothing has been written yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def _finish(query: StreamingQuery, trigger: dict, limit: float | None, progress: list[dict] | None) -> None:
    """Wait until the query has committed its input, then stop it."""
    try:
        if "availableNow" in trigger or "once" in trigger:
            done = query.awaitTermination(limit) if limit is not None else query.awaitTermination() is None
        else:
            done = _drained(query, limit)
        if progress is not None:
            progress.extend(query.recentProgress)
        if not done:
            raise StreamTimeout(f"input left after {limit} seconds")
    finally:
        query.stop()


def _drained(query: StreamingQuery, limit: float | None) -> bool:
    """Whether a query without an end has, within ``limit``, committed everything that its sources had."""
    waiter = ThreadPoolExecutor(1)
    waiting = waiter.submit(query.processAllAvailable)
    try:
        waiting.result(limit)
        return True
    except LimitPassed:
        return False
    finally:
        waiter.shutdown(wait=False)  # stopping the query ends the call that is still waiting


def _overwrite(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def _keep_batch(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a checkpoint has committed, -1 if none."""
    try:
        names = spark.read.text(f"{checkpoint}/commits").select(F.col("_metadata.file_name").cast("long").alias("n"))
        return names.agg(F.coalesce(F.max("n"), F.lit(-1))).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def run_with_retry(
    start: Callable[[str], DataFrame], spark: SparkSession, checkpoint: str | None = None, label: str = "retry"
) -> DataFrame:
    """``start(checkpoint)``; if it fails before it has committed anything, once more with a fresh checkpoint.

    A checkpoint that does not fit the query (other sources, another state) only shows when the stream begins, as the
    same exception that a failure in mid-run raises. So what tells them apart is the checkpoint's list of commits: a run
    that added to it has made progress, keeps its checkpoint and is not retried.

    ``start`` must write to a sink of its own for each checkpoint, for instance a folder named after it: a file sink
    remembers batch numbers, and would leave out the rows of a new checkpoint that counts from 0 again.
    """
    checkpoint = checkpoint or workspace(spark, f"{label}-checkpoint")
    before = last_committed(spark, checkpoint)
    try:
        return start(checkpoint)
    except Exception as first:  # noqa: BLE001 - any failure to start earns the one retry
        if last_committed(spark, checkpoint) > before:
            raise
        print(f"stream failed to start ({type(first).__name__}); retrying once with a fresh checkpoint")
        return start(workspace(spark, f"{label}-checkpoint"))
