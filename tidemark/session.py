"""Session-level helpers: where scratch data goes, and when a side may be broadcast."""

from __future__ import annotations

import os
import re
import shutil
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest join side, by Catalyst's own size estimate, that gets a broadcast hint.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024

# Largest input, by the same estimate, that is dealt out to all cores before costly row work.
SPREAD_LIMIT_BYTES = 256 * 1024 * 1024
SPREAD_SHARE_BYTES = 8 * 1024 * 1024

# Rows and bytes of an Arrow batch at most. A worker holds a batch of texts several times over (as Arrow, as strings, as
# results), and the JVM its buffers beside the heap; with some megabytes the cost of a batch is still small.
BATCH_ROWS, BATCH_BYTES = 1_000, "4m"

_local_root: dict[str, str] = {}
_shipped: set[str] = set()


def workspace_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it (it then gets one temporary folder): on a
    cluster a machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root[app]


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused folder path for one job."""
    return f"{workspace_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's executors, once per application.

    Needed where executors cannot import it by themselves (no ``--py-files``, other folder).
    """
    app = spark.conf.get("spark.app.id", "local")
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-ship-"), "tidemark")
    zipped = shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    spark.addArtifacts(zipped, pyfile=True)
    _shipped.add(app)


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small, so that a Python worker's memory does not grow with its task's rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``.

    Without column statistics the estimate never shrinks under filters and multiplies
    under joins, so it errs on the large side.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a Connect client cannot see it: leave the choice to the server
        return sys.maxsize
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Plan nodes whose output Catalyst's estimate bounds: those that give out no more rows than they get, unions (the sum of
# both sides) and joins (the product), over files whose size is known or local rows.
BOUNDED = {
    "Aggregate", "Deduplicate", "Distinct", "Filter", "GlobalLimit", "Join", "LocalLimit", "LocalRelation", "Project", "Relation",
    "Sort", "Union",
}


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether ``df`` is known to be under ``limit`` bytes.

    Catalyst's estimate is trusted only for plans of ``BOUNDED`` nodes: it knows nothing of what an explode or a Python
    function multiplies.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a Connect client cannot see it: leave the choice to the server
        return False
    optimized = plan.queryExecution().optimizedPlan()
    named = [re.match(r"[ :+\-]*!?(\w+)", line) for line in optimized.toString().splitlines() if line.strip()]
    nodes = {m[1] if m else "" for m in named}
    return nodes <= BOUNDED and int(str(optimized.stats().sizeInBytes())) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only for a side that is known to be under ``limit``.

    Any other frame is returned as is: the join becomes a shuffled one, which adaptive execution can split on skew
    or turn into a broadcast once it has seen real sizes.
    """
    return F.broadcast(df) if is_small(df, limit) else df


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a small batch input before costly per-row work.

    A table of one file with one row group is one task however wide it is. Inputs beyond
    ``SPREAD_LIMIT_BYTES`` come in many splits already and are left alone: no shuffle at scale.
    """
    size = sys.maxsize if df.isStreaming else estimated_bytes(df)
    if size > SPREAD_LIMIT_BYTES:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_SHARE_BYTES)))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the workspace and read it back: short lineage, safe on executor loss."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
