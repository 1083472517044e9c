"""A versioned Parquet table: a base snapshot plus one small set of changed rows per version.

Layout under the table folder::

    snapshots/_version=K/   the whole table, at the first version and after each compaction
    changes/_version=N/     only the rows version N changed, with ``_change_type``
    history/                one JSON row per version, written last: it commits the version

A change therefore costs a scan for the touched rows and a small write, never a rewrite of the
table, and the change feed is simply the stored changes. Reading version N takes the newest
snapshot at or before N, drops the keys changed since and adds their last images. One writer at
a time is assumed; a failed write leaves no history row and its folder is overwritten next time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.operators.layout import target_files
from tidemark.operators.merge import (
    CHANGE_TYPE,
    DELETE,
    INSERT,
    POSTIMAGE,
    PREIMAGE,
    MergePlan,
    merge_into,
)
from tidemark.operators.ordered import top_n_per_key
from tidemark.session import broadcast_if_small, materialize

VERSION = "_version"
COMMIT_TIME = "_commit_timestamp"
HISTORY_SCHEMA = (
    "version int, timestamp timestamp, operation string, batch_tag string, schema string, "
    "snapshot boolean, inserted long, updated long, deleted long"
)


_CHANGE_FIELDS = [StructField(CHANGE_TYPE, StringType()), StructField(VERSION, IntegerType())]


class VersionedTable:
    """``key``, one column or several that are unique per row together, is needed for update, delete and merge; appends
    work without. A NULL in a key is a value like any other."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key or [])

    # -- reading ---------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """version, timestamp, operation and row metrics, one row per committed version."""
        try:
            return self.spark.read.schema(HISTORY_SCHEMA).json(f"{self.path}/history")
        except AnalysisException as error:  # a history that is there but cannot be read is no new table
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY_SCHEMA)

    def _log(self) -> list:
        """Committed versions in order: metadata, one small row each."""
        return sorted(self.history().collect(), key=lambda r: r.version)

    def latest_version(self) -> int:
        log = self._log()
        return log[-1].version if log else -1

    def versions_since_snapshot(self) -> int:
        """Versions that a read puts on top of the newest snapshot."""
        log = self._log()
        return log[-1].version - max(r.version for r in log if r.snapshot) if log else 0

    def schema(self) -> StructType:
        """Columns of the latest version."""
        log = self._log()
        return self._schema(log, log[-1].version)

    def _schema(self, log: list, version: int) -> StructType:
        return StructType.fromDDL(next(r.schema for r in log if r.version == version))

    def as_of(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        """The table at a version, at a point in time, or now."""
        return self._at(self._log(), version, timestamp)

    def _at(self, log: list, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        if timestamp is not None:
            log = [r for r in log if r.timestamp <= timestamp]
        if version is not None:
            log = [r for r in log if r.version <= version]
        if not log or (version is not None and log[-1].version != version):
            raise ValueError(f"no such version of {self.path}")
        last = log[-1].version
        base = max(r.version for r in log if r.snapshot)
        schema = self._schema(log, last)
        columns = schema.names
        table = self._folder("snapshots", base, schema)
        touched = [r for r in log if r.version > base and (r.inserted or r.updated or r.deleted)]
        if not touched:
            return table.select(*columns)
        changes = self._changes(base + 1, last, schema)
        if not any(r.updated or r.deleted for r in touched):
            return table.select(*columns).unionByName(changes.select(*columns))
        image_order = F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE).desc()
        final = top_n_per_key(changes, self.keys, [F.col(VERSION).desc(), image_order])
        live = final.filter(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)).select(*columns)
        return without_keys(table.select(*columns), changes, self.keys).unionByName(live)

    def change_feed(self, from_version: int = 0, to_version: int | None = None) -> DataFrame:
        """Row changes with ``_change_type``, ``_version`` and ``_commit_timestamp``.

        Only the folders of the asked versions are read; the rows of a full write come from its
        snapshot, so they are not stored twice.
        """
        log = self._log()
        last = log[-1].version if to_version is None else to_version
        schema = self._schema(log, last)
        asked = [r for r in log if from_version <= r.version <= last]
        parts = [
            self._folder("snapshots", r.version, schema)
            .withColumn(CHANGE_TYPE, F.lit(INSERT))
            .withColumn(VERSION, F.lit(r.version))
            for r in asked
            if r.operation == "WRITE"
        ]
        if any(r.operation not in ("WRITE", "OPTIMIZE") or r.deleted for r in asked):
            parts.append(self._changes(from_version, last, schema))
        if not parts:  # compactions only
            parts = [self.spark.createDataFrame([], StructType([*schema.fields, *_CHANGE_FIELDS]))]
        feed = reduce(DataFrame.unionByName, parts)
        times = self.history().select(F.col("version").alias(VERSION), F.col("timestamp").alias(COMMIT_TIME))
        return feed.join(broadcast_if_small(times), VERSION).select(*schema.names, CHANGE_TYPE, VERSION, COMMIT_TIME)

    def snapshot_path(self, version: int) -> str:
        """Folder of the snapshot that ``create`` or ``compact`` wrote as ``version``."""
        return f"{self.path}/snapshots/{VERSION}={version}"

    def _folder(self, kind: str, version: int, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/{VERSION}={version}")

    def _changes(self, first: int, last: int, schema: StructType) -> DataFrame:
        stored = StructType([*schema.fields, *_CHANGE_FIELDS])
        changes = self.spark.read.schema(stored).parquet(f"{self.path}/changes")
        return changes.filter(F.col(VERSION).between(first, last))

    # -- writing ---------------------------------------------------------------------------

    def create(self, df: DataFrame, batch_tag: str | None = None) -> int:
        """Version 0, or an overwrite of everything: a new snapshot."""
        log = self._log()
        version = len(log)
        replaced = 0
        if log:
            path = self._write_changes(self._at(log).withColumn(CHANGE_TYPE, F.lit(DELETE)), version)
            replaced = self.spark.read.parquet(path).count()
        df.write.mode("overwrite").parquet(f"{self.path}/snapshots/{VERSION}={version}")
        counts = {INSERT: self._folder("snapshots", version, df.schema).count(), DELETE: replaced}
        return self._commit(version, "WRITE", counts, df.schema, snapshot=True, batch_tag=batch_tag)

    def append(self, df: DataFrame, evolve: bool = False, batch_tag: str | None = None) -> int | None:
        """Add rows. With ``evolve`` new columns join the schema, NULL in older rows."""
        log = self._log()
        if self._done(log, batch_tag):
            return None
        current = self._schema(log, log[-1].version)
        extra = [f for f in df.schema.fields if f.name not in current.names]
        if extra and not evolve:
            raise ValueError(f"new columns {[f.name for f in extra]}: pass evolve=True to add them")
        empty = self.spark.createDataFrame([], current)
        rows = empty.unionByName(df, allowMissingColumns=True)
        return self._record(len(log), rows.withColumn(CHANGE_TYPE, F.lit(INSERT)), "APPEND", batch_tag)

    def update(self, predicate: Column, values: Mapping[str, Column]) -> int | None:
        log = self._log()
        current = self._at(log)
        new_row = [
            values[f.name].cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name)
            for f in current.schema.fields
        ]
        images = F.array(
            F.struct(F.lit(PREIMAGE).alias(CHANGE_TYPE), *current.columns),
            F.struct(F.lit(POSTIMAGE).alias(CHANGE_TYPE), *new_row),
        )
        changes = current.filter(predicate).select(F.explode(images).alias("c")).select("c.*")
        return self._record(len(log), changes, "UPDATE")

    def delete(self, predicate: Column) -> int | None:
        log = self._log()
        gone = self._at(log).filter(predicate)
        return self._record(len(log), gone.withColumn(CHANGE_TYPE, F.lit(DELETE)), "DELETE")

    def merge(
        self,
        source: DataFrame,
        on: str | list[str],
        clauses: Callable[[MergePlan], MergePlan],
        batch_tag: str | None = None,
        source_is_unique: bool = False,
        null_safe: bool = False,
    ) -> int | None:
        """Merge ``source``; ``clauses`` adds the WHEN clauses. A ``batch_tag`` is applied once only.

        The source is used several times, so it is written out first; that also tells its true size.
        """
        log = self._log()
        if self._done(log, batch_tag):
            return None
        source = materialize(source, "merge-source")
        plan = clauses(merge_into(self._at(log), source, on, source_is_unique, null_safe))
        return self._record(len(log), plan.changes(), "MERGE", batch_tag)

    def compact(self) -> int:
        """Write a new snapshot of the latest version, in files of even size.

        Their number follows from the newest snapshot and the changes since, not from older snapshots.
        """
        log = self._log()
        version = len(log)
        current = self._at(log)
        base = max(r.version for r in log if r.snapshot)
        parts = [self.snapshot_path(base)]
        parts += [f"{self.path}/changes/{VERSION}={r.version}" for r in log if r.version > base]
        files = target_files(self.spark, parts)
        path = self.snapshot_path(version)
        current.repartition(files).write.mode("overwrite").parquet(path)
        return self._commit(version, "OPTIMIZE", {}, current.schema, snapshot=True)

    def _done(self, log: list, batch_tag: str | None) -> bool:
        return batch_tag is not None and any(r.batch_tag == batch_tag for r in log)

    def _write_changes(self, changes: DataFrame, version: int) -> str:
        path = f"{self.path}/changes/{VERSION}={version}"
        changes.write.mode("overwrite").parquet(path)
        return path

    def _record(self, version: int, changes: DataFrame, operation: str, batch_tag: str | None = None) -> int:
        path = self._write_changes(changes, version)
        stored = self.spark.read.schema(changes.schema).parquet(path)
        counts = {r[0]: r[1] for r in stored.groupBy(CHANGE_TYPE).count().collect()}
        return self._commit(version, operation, counts, changes.drop(CHANGE_TYPE).schema, batch_tag=batch_tag)

    def _commit(
        self,
        version: int,
        operation: str,
        counts: Mapping[str, int],
        schema: StructType,
        snapshot: bool = False,
        batch_tag: str | None = None,
    ) -> int:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        now = datetime.now(timezone.utc)
        metrics = [counts.get(k, 0) for k in (INSERT, POSTIMAGE, DELETE)]
        entry = self.spark.createDataFrame([(version, now, operation, batch_tag, ddl, snapshot, *metrics)], HISTORY_SCHEMA)
        entry.coalesce(1).write.mode("append").json(f"{self.path}/history")
        return version


def without_keys(table: DataFrame, changed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of ``table`` whose key is not among those of ``changed``; NULL is a value like any other."""
    keys = [key] if isinstance(key, str) else list(key)
    names = [f"_stale{i}" for i in range(len(keys))]
    stale = broadcast_if_small(changed.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct())
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return table.join(stale, match, "left_anti")


def sync_index(
    index: DataFrame, feed: DataFrame, key: str | Sequence[str], derive: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Bring a derived index up to date from a change feed.

    Only the last image of each changed key is derived again; every other row stays as it is.
    """
    order = [F.col(VERSION).desc(), F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE).desc()]
    last = top_n_per_key(feed, [key] if isinstance(key, str) else list(key), order)
    live = last.filter(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)).drop(CHANGE_TYPE, VERSION, COMMIT_TIME)
    return without_keys(index, feed, key).unionByName(derive(live))
