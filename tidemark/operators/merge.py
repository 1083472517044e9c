"""MERGE, UPDATE and DELETE as DataFrame jobs.

``MergePlan`` can give the resulting table, or only the changed rows with their change type
(what a change feed stores). Target columns are referred to as ``t.x``, source columns as ``s.x``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import is_small

CHANGE_TYPE = "_change_type"
INSERT, DELETE = "insert", "delete"
PREIMAGE, POSTIMAGE = "update_preimage", "update_postimage"


# Why a merge or a difference fails: the outcome would be arbitrary. Raised by the tasks that see the rows.
DUPLICATE_SOURCE = "several source rows share one merge key"
DUPLICATE_KEY = "several rows of a snapshot share one key"


@dataclass
class _Matched:
    condition: Column
    values: Mapping[str, Column] | None  # None: delete


@dataclass
class MergePlan:
    target: DataFrame
    source: DataFrame
    on: Sequence[str]
    source_is_unique: bool = False
    null_safe: bool = False
    matched: list[_Matched] = field(default_factory=list)
    not_matched: list[tuple[Column, Mapping[str, Column]]] = field(default_factory=list)

    def when_matched_update(self, values: Mapping[str, Column], condition: Column | None = None) -> MergePlan:
        self.matched.append(_Matched(_or_true(condition), dict(values)))
        return self

    def when_matched_delete(self, condition: Column | None = None) -> MergePlan:
        self.matched.append(_Matched(_or_true(condition), None))
        return self

    def when_not_matched_insert(
        self, values: Mapping[str, Column] | None = None, condition: Column | None = None
    ) -> MergePlan:
        """Insert the source row; target columns not named in ``values`` become NULL.

        Without ``values`` every target column is taken from the source by name.
        """
        if values is None:
            values = {c: F.col(f"s.{c}") for c in self.target.columns}
        self.not_matched.append((_or_true(condition), dict(values)))
        return self

    def to_df(self) -> DataFrame:
        """The whole table after the merge."""
        columns = self.target.columns
        deletes = [i for i, m in enumerate(self.matched) if m.values is None]
        gone = F.col("_action").isin(*deletes) if deletes else F.lit(False)
        if self._travels():
            kept = self._acted(self._pairs("left")).filter(~gone).select(*[self._value(c) for c in columns])
            inserts = self._inserts(self._unmatched())
        else:
            both = self._acted(self._pairs("full" if self.not_matched else "left"))
            here = F.col("t._here").isNotNull()
            rows = F.when(here, F.struct(*[self._value(c) for c in columns])).otherwise(self._inserted())
            kept = both.filter(F.when(here, ~gone).otherwise(F.col("_clause") >= 0)).select(rows.alias("c")).select("c.*")
            inserts = self._inserts(self._keyless())
        return kept.unionByName(inserts) if inserts is not None else kept

    def changes(self) -> DataFrame:
        """Only the rows the merge touches, as change-feed rows."""
        columns = self.target.columns
        deletes = [i for i, m in enumerate(self.matched) if m.values is None]
        gone = F.col("_action").isin(*deletes) if deletes else F.lit(False)
        image = lambda kind, row: F.struct(F.lit(kind).alias(CHANGE_TYPE), row.alias("row"))
        old = F.struct(*[F.col(f"t.{c}").alias(c) for c in columns])
        new = F.struct(*[self._value(c) for c in columns])
        images = F.when(gone, F.array(image(DELETE, old))).otherwise(F.array(image(PREIMAGE, old), image(POSTIMAGE, new)))
        hit = F.col("_action") >= 0
        if self._travels():
            acted, inserts = self._acted(self._pairs("inner")).filter(hit), self._inserts(self._unmatched())
        else:
            fresh = F.col("t._here").isNull()
            acted = self._acted(self._pairs("full" if self.not_matched else "inner"))
            acted = acted.filter(hit | (fresh & (F.col("_clause") >= 0)))
            images = F.when(fresh, F.array(image(INSERT, self._inserted()))).otherwise(images)
            inserts = self._inserts(self._keyless())
        told = acted.select(F.explode(images).alias("c")).select(f"c.{CHANGE_TYPE}", "c.row.*")
        if inserts is not None:
            told = told.unionByName(inserts.select(F.lit(INSERT).alias(CHANGE_TYPE), *columns))
        return told

    def _travels(self) -> bool:
        """Whether the source is small enough to be sent to every task, so that the target stays where it is.

        Otherwise both sides are shuffled once by their keys: the source is reduced to a row per key by the same
        shuffle that then meets the target, and one outer join tells matched rows from new ones.
        """
        return is_small(self.source)

    def _keyed(self) -> DataFrame:
        """The source as ``s``, a row per key, with ``_hit``; rows whose key has a NULL only where those can match.

        A key that comes twice makes the task that finds it fail, so no pass of its own is needed for the check.
        """
        keys = list(self.on)
        source = self.source if self.null_safe else self.source.dropna(subset=keys)
        if self.source_is_unique or not self.matched:
            return source.withColumn("_hit", F.lit(True)).alias("s")
        grouped = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*source.columns)).alias("_row"))
        once = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{DUPLICATE_SOURCE} of {keys}")).cast("boolean")).otherwise(F.lit(True))
        rest = [F.col(f"_row.{c}").alias(c) for c in source.columns if c not in keys]
        return grouped.select(*keys, *rest, once.alias("_hit")).alias("s")

    def _pairs(self, how: str) -> DataFrame:
        """Target rows joined to their source row."""
        t, s = self.target.withColumn("_here", F.lit(True)).alias("t"), self._keyed()
        return t.join(F.broadcast(s) if self._travels() else s, self._match("t", "s"), how)

    def _match(self, left: str, right: str) -> Column:
        one = lambda k: (
            F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) if self.null_safe else F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        )
        return reduce(Column.__and__, map(one, self.on))

    def _acted(self, pairs: DataFrame) -> DataFrame:
        """With the index of the clause that applies to a matched row (-1: none), and to a new one."""
        action, clause = F.lit(-1), F.lit(-1)
        for i, matched in reversed(list(enumerate(self.matched))):
            action = F.when(F.col("t._here") & F.col("s._hit") & matched.condition, F.lit(i)).otherwise(action)
        for i, (condition, _) in reversed(list(enumerate(self.not_matched))):
            clause = F.when(condition, F.lit(i)).otherwise(clause)
        return pairs.withColumns({"_action": action, "_clause": clause})

    def _value(self, column: str) -> Column:
        value = F.col(f"t.{column}")
        for i, clause in enumerate(self.matched):
            if clause.values and column in clause.values:
                value = F.when(F.col("_action") == i, clause.values[column]).otherwise(value)
        return value.cast(self.target.schema[column].dataType).alias(column)

    def _inserted(self) -> Column:
        """The row that a new source row becomes, by the clause that applies to it."""
        fields = []
        for f in self.target.schema.fields:
            value = F.lit(None)
            for i, (_, values) in enumerate(self.not_matched):
                value = F.when(F.col("_clause") == i, values.get(f.name, F.lit(None))).otherwise(value)
            fields.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*fields)

    def _keyless(self) -> DataFrame | None:
        """Source rows that cannot match as their key has a NULL, as ``s``."""
        if self.null_safe or not self.not_matched:
            return None
        return self.source.filter(reduce(Column.__or__, [F.col(k).isNull() for k in self.on])).alias("s")

    def _unmatched(self) -> DataFrame | None:
        """Source rows without a target row, as ``s``; the target is reduced to the source's keys first, unshuffled."""
        if not self.not_matched:
            return None
        keys = F.broadcast(self.source.select(*self.on).distinct()).alias("k")
        known = self.target.select(*self.on).alias("t").join(keys, self._match("t", "k"), "left_semi").distinct()
        return self.source.alias("s").join(known.alias("t"), self._match("s", "t"), "left_anti")

    def _inserts(self, fresh: DataFrame | None) -> DataFrame | None:
        if fresh is None:
            return None
        clause = F.lit(-1)
        for i, (condition, _) in reversed(list(enumerate(self.not_matched))):
            clause = F.when(condition, F.lit(i)).otherwise(clause)
        told = fresh.withColumn("_clause", clause).filter(F.col("_clause") >= 0)
        return told.select(self._inserted().alias("c")).select("c.*")


def _or_true(condition: Column | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    source_is_unique: bool = False,
    null_safe: bool = False,
) -> MergePlan:
    """A merge to which WHEN clauses are added. Several source rows per key make it fail, unless ``source_is_unique``
    says that there are none. A NULL in a key matches nothing, or with ``null_safe`` another NULL."""
    return MergePlan(target, source, [on] if isinstance(on, str) else list(on), source_is_unique, null_safe)


def update(df: DataFrame, predicate: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``: every expression sees the row as it was."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(
        *[
            F.when(hit, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def delete(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE ... WHERE``: a row whose predicate is NULL stays."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def insert_values(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Append literal rows, given in column order."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Change-feed rows that lead from one snapshot to the next (``key`` unique in both; a NULL is a value of it).

    The two snapshots are tagged, put together and grouped by key: one shuffle checks that keys are unique, pairs the
    rows and compares them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = new.columns
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    tagged = lambda df, tag: df.select(*named, F.lit(tag).alias("_new"), F.struct(*columns).alias("_row"))
    sides = {c: F.col("_new") if c == "n" else ~F.col("_new") for c in ("o", "n")}
    row = [F.first(F.when(at, F.col("_row")), ignorenulls=True).alias(c) for c, at in sides.items()]
    count = [F.count(F.when(at, F.lit(1))).alias(f"_{c}s") for c, at in sides.items()]
    pairs = tagged(old, False).unionByName(tagged(new, True)).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(*row, *count)
    image = lambda kind, side: F.struct(F.lit(kind).alias(CHANGE_TYPE), F.col(side).alias("row"))
    images = (
        F.when(F.greatest("_os", "_ns") > 1, F.raise_error(F.lit(f"{DUPLICATE_KEY} of {keys}")))
        .when(F.col("o").eqNullSafe(F.col("n")), F.array())
        .when(F.col("o").isNull(), F.array(image(INSERT, "n")))
        .when(F.col("n").isNull(), F.array(image(DELETE, "o")))
        .otherwise(F.array(image(PREIMAGE, "o"), image(POSTIMAGE, "n")))
    )
    return pairs.select(F.explode(images).alias("c")).select(f"c.{CHANGE_TYPE}", "c.row.*")
