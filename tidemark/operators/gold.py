"""Window tables that follow a versioned table through its change feed.

A window table is a versioned table with a row per window and key. A run reads the changes that its source has
committed since the last run, folds them to one row per touched window, and merges these: sums take what the
post-images add and the pre-images take away; a pick (such as the row with the largest value) cannot be taken back,
so its windows, and only those, are read again from the source. Windows that no change touches keep their files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.merge import CHANGE_TYPE, INSERT, POSTIMAGE, MergePlan
from tidemark.operators.versions import VersionedTable
from tidemark.session import materialize

START, END, ROWS, LATEST = "window_start", "window_end", "n_rows", "latest"

# Versions that a table collects before its next run writes a new snapshot.
COMPACT_AFTER = 32

_TAG = "source@"


@dataclass(frozen=True)
class WindowSpec:
    """What a window table holds.

    ``sums`` are whole-number columns of the source: each is kept as ``<name>_sum`` and ``<name>_n``, the number of values
    that are not NULL. ``picks`` are aggregates (SQL) that are worked out again from the rows of a touched window.
    ``shown`` (SQL) makes the columns that a reader sees, of windows that end ``lateness`` before the latest event or
    earlier.
    """

    duration: str
    lateness: timedelta
    slide: str | None = None
    keys: Sequence[str] = ()
    sums: Sequence[str] = ()
    picks: Mapping[str, str] = field(default_factory=dict)
    shown: Mapping[str, str] = field(default_factory=dict)

    @property
    def on(self) -> list[str]:
        return [START, *self.keys]

    def windowed(self, df: DataFrame, ts: str) -> DataFrame:
        """``df`` once for each window that a row's event time lies in; rows without one are in none."""
        window = F.window(ts, self.duration, self.slide) if self.slide else F.window(ts, self.duration)
        return df.filter(F.col(ts).isNotNull()).withColumn("_w", window).withColumns({START: F.col("_w.start"), END: F.col("_w.end")}).drop("_w")


class WindowTable:
    """The window table of ``spec`` at ``path``, over the event times ``ts`` of ``source``."""

    def __init__(self, spark: SparkSession, path: str, spec: WindowSpec, source: VersionedTable, ts: str):
        self.spec, self.source, self.ts = spec, source, ts
        self.table = VersionedTable(spark, path, key=spec.on)

    def applied(self) -> int:
        """The last version of the source that this table has taken in, -1 if none."""
        tags = self.table.history().filter(F.startswith("batch_tag", F.lit(_TAG)))
        return tags.agg(F.coalesce(F.max(F.substring("batch_tag", len(_TAG) + 1, 20).cast("int")), F.lit(-1))).first()[0]

    def refresh(self) -> int | None:
        """Take in what the source has committed since the last run; the version written, None if nothing is new.

        The source's version is the tag of the commit, so a run that is repeated after a failure is applied once.
        """
        done, now = self.applied(), self.source.latest_version()
        if now <= done:
            return None
        delta = materialize(self._delta(done + 1, now), "window-delta")
        rows = self._picked(delta, now) if self.spec.picks else delta
        tag = f"{_TAG}{now}"
        if done < 0:
            return self.table.create(rows, batch_tag=tag)
        version = self.table.merge(rows, self.spec.on, self._clauses, batch_tag=tag, source_is_unique=True, null_safe=True)
        if version is not None and self.table.versions_since_snapshot() > COMPACT_AFTER:
            self.table.compact()
        return version

    def read(self) -> DataFrame:
        """The windows that are closed, in the columns of ``shown``."""
        rows = self.table.as_of()
        high = rows.agg(F.max(LATEST)).first()[0]  # one value
        closed = rows.filter((F.col(ROWS) > 0) & (F.col(END) <= F.lit(high) - F.lit(self.spec.lateness)))
        return closed.select(START, END, *self.spec.keys, *[F.expr(c).alias(n) for n, c in self.spec.shown.items()])

    def _delta(self, first: int, last: int) -> DataFrame:
        """One row per touched window: what to add to its sums, and the latest event time that it has been given.

        A change that leaves a window as it was (an update of another column) is no row.
        """
        feed = self.source.change_feed(first, last)
        sign = F.when(F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE), F.lit(1)).otherwise(F.lit(-1)).cast("long")
        changes = self.spec.windowed(feed.withColumn("_sign", sign), self.ts)
        aggs = [F.sum("_sign").alias(ROWS), F.max(F.when(F.col("_sign") > 0, F.col(self.ts))).alias(LATEST)]
        for name in self.spec.sums:
            value = F.col(name)
            aggs.append(F.coalesce(F.sum(F.col("_sign") * value.cast("long")), F.lit(0).cast("long")).alias(f"{name}_sum"))
            aggs.append(F.sum(F.when(value.isNotNull(), F.col("_sign")).otherwise(F.lit(0).cast("long"))).alias(f"{name}_n"))
        delta = changes.groupBy(START, END, *self.spec.keys).agg(*aggs)
        if self.spec.picks:
            return delta  # another row may be picked although no sum has changed
        moved = F.col(ROWS) != 0
        for name in self.spec.sums:
            moved = moved | (F.col(f"{name}_sum") != 0) | (F.col(f"{name}_n") != 0)
        return delta.filter(moved)

    def _picked(self, delta: DataFrame, version: int) -> DataFrame:
        """The touched windows with their picks, from those rows of the source whose time lies among them."""
        bounds = delta.agg(F.min(START), F.max(END)).first()  # two values
        on = [*self.spec.on]
        rows = self.source.as_of(version)
        if bounds[0] is not None:
            rows = rows.filter(F.col(self.ts).between(F.lit(bounds[0]), F.lit(bounds[1])))
        touched = delta.select(*[F.col(c).alias(f"_{c}") for c in on])
        same = F.lit(True)
        for c in on:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        again = self.spec.windowed(rows, self.ts).join(touched, same, "left_semi")
        picks = again.groupBy(*[F.col(c).alias(f"_{c}") for c in on]).agg(*[F.expr(p).alias(n) for n, p in self.spec.picks.items()])
        return delta.join(picks, same, "left").drop(*[f"_{c}" for c in on])

    def _clauses(self, plan: MergePlan) -> MergePlan:
        added = [ROWS, *(f"{n}_{kind}" for n in self.spec.sums for kind in ("sum", "n"))]
        values = {c: F.col(f"t.{c}") + F.col(f"s.{c}") for c in added}
        values[LATEST] = F.greatest(f"t.{LATEST}", f"s.{LATEST}")
        values |= {c: F.col(f"s.{c}") for c in self.spec.picks}
        return plan.when_matched_update(values).when_not_matched_insert()
