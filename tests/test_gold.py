"""Window tables that follow a change feed, against windows worked out afresh from the source."""

from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import gold
from tidemark.operators.gold import WindowSpec, WindowTable
from tidemark.operators.versions import VersionedTable
from tidemark.plans.flights import GOLD
from tidemark.session import workspace

HOUR = 3600
LANDED = "id long, at long, dock string, crates int"


def landed(spark, data):
    frame = spark.createDataFrame(data, LANDED)
    return frame.select("id", F.timestamp_seconds(F.lit(1_700_006_400) + F.col("at")).alias("at"), "dock", "crates")


@pytest.fixture
def dock(spark):
    table = VersionedTable(spark, workspace(spark, "dock"), key="id")
    table.create(landed(spark, [(k, 600 * k, "abc"[k % 3] if k % 7 else None, k % 5 if k % 4 else None) for k in range(60)]))
    return table


SUMS = WindowSpec("1 hour", timedelta(hours=1), keys=["dock"], sums=["crates"], shown={"n": "n_rows", "crates": "CASE WHEN crates_n > 0 THEN crates_sum END", "seen": "crates_n"})
PICKS = WindowSpec("3 hours", timedelta(0), "1 hour", picks={"most": "max(crates)", "who": "max_by(id, struct(crates, id))"}, shown={"n": "n_rows", "most": "most", "who": "who"})


def afresh(source, spec, high):
    """The same windows from the source as it stands; ``high`` is the latest time that was ever loaded."""
    aggs = [F.count("*").alias("n_rows")]
    for c in spec.sums:
        aggs += [F.sum(F.col(c).cast("long")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    aggs += [F.expr(p).alias(n) for n, p in spec.picks.items()]
    out = spec.windowed(source.as_of(), "at").groupBy("window_start", "window_end", *spec.keys).agg(*aggs)
    out = out.filter(F.col("window_end") <= F.timestamp_seconds(F.lit(high)) - F.lit(spec.lateness))
    return out.select("window_start", "window_end", *spec.keys, *[F.expr(c).alias(n) for n, c in spec.shown.items()])


@pytest.mark.parametrize("spec", [SUMS, PICKS])
def test_runs_between_changes_equal_one_afresh(spark, dock, spec):
    kept = WindowTable(spark, workspace(spark, "gold"), spec, dock, "at")
    high = lambda: 1_700_006_400 + last
    last = 600 * 59
    steps = [
        lambda: None,
        lambda: dock.update(F.col("id") % 6 == 0, {"crates": F.col("crates") + 10}),
        lambda: dock.delete((F.col("id") % 5 == 0) | (F.col("id") > 55)),  # the latest rows too
        lambda: dock.update(F.col("id") == 8, {"at": F.col("at") + F.expr("INTERVAL 2 HOURS"), "dock": F.lit(None).cast("string")}),
        lambda: dock.append(landed(spark, [(100, -5 * HOUR, "z", 9), (101, 600 * 80, "a", 1), (102, None, "a", 1)])),
        lambda: dock.compact(),
        lambda: (dock.update(F.col("id") == 100, {"crates": F.lit(3)}), dock.delete(F.col("id") == 100)),
    ]
    for n, step in enumerate(steps):
        step()
        if n >= 4:
            last = 600 * 80
        kept.refresh()
        assert rows(kept.read()) == rows(afresh(dock, spec, high()))
        assert kept.applied() == dock.latest_version()


def test_a_run_without_news_writes_nothing(spark, dock):
    kept = WindowTable(spark, workspace(spark, "gold"), SUMS, dock, "at")
    assert kept.refresh() == 0
    assert kept.refresh() is None and kept.table.latest_version() == 0


def test_untouched_windows_keep_their_files(spark, dock):
    """A change of one hour writes that hour's rows and no other; a change of another column writes no window."""
    kept = WindowTable(spark, workspace(spark, "gold"), SUMS, dock, "at")
    kept.refresh()
    files = lambda: {r.path: (r.modificationTime, r.length) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{kept.table.path}/snapshots").select("path", "modificationTime", "length").collect()}
    before = files()
    dock.update(F.col("id") == 13, {"crates": F.lit(50)})
    version = kept.refresh()
    assert files() == before
    changed = kept.table.change_feed(version, version)
    assert changed.count() == 2 and changed.select("window_start").distinct().count() == 1
    dock.update(F.col("id") == 13, {"id": F.lit(1300).cast("long")})
    version = kept.refresh()
    assert kept.table.change_feed(version, version).count() == 0


def test_picks_read_touched_windows_only(spark, dock, monkeypatch):
    kept = WindowTable(spark, workspace(spark, "gold"), PICKS, dock, "at")
    kept.refresh()
    dock.update(F.col("id") == 30, {"crates": F.lit(0)})
    version = kept.refresh()
    assert kept.table.change_feed(version, version).select("window_start").distinct().count() == 3  # one hour, three windows


def test_a_failed_run_is_repeated_once(spark, dock):
    """The commit carries the source's version: files without it are nothing, and the next run starts from the feed again."""
    kept = WindowTable(spark, workspace(spark, "gold"), SUMS, dock, "at")
    kept.refresh()
    dock.update(F.col("id") < 9, {"crates": F.lit(7)})
    delta = kept._delta(1, 1).withColumn("_change_type", F.lit("insert"))
    delta.write.parquet(f"{kept.table.path}/changes/_version=1")  # as a writer leaves it that dies before the commit
    assert kept.applied() == 0
    kept.refresh()
    kept.refresh()
    assert rows(kept.read()) == rows(afresh(dock, SUMS, 1_700_006_400 + 600 * 59))


def test_window_tables_are_compacted(spark, dock, monkeypatch):
    monkeypatch.setattr(gold, "COMPACT_AFTER", 1)
    kept = WindowTable(spark, workspace(spark, "gold"), SUMS, dock, "at")
    for n in range(3):
        dock.update(F.col("id") == n + 1, {"crates": F.lit(40 + n)})
        kept.refresh()
    assert kept.table.versions_since_snapshot() <= 1
    assert rows(kept.read()) == rows(afresh(dock, SUMS, 1_700_006_400 + 600 * 59))


def test_every_gold_table_has_a_reader_s_columns():
    assert all(spec.shown for spec in GOLD.values())
