"""Tables, merges, versions, windows and small functions on made-up rows, with results worked out by hand or by a model."""

import datetime as dt
import random
from functools import partial

import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import Row, functions as F

from tidemark.functions import bucket_case, extract_fenced, extract_score, fold_elements, range_partition, route_status
from tidemark.operators.documents import chunk_fixed
from tidemark.operators.layout import target_files
from tidemark.operators.merge import DUPLICATE_KEY, DUPLICATE_SOURCE, merge_into, snapshot_diff
from tidemark.operators.relational import partition_counts, unmatched
from tidemark.operators.versions import VersionedTable
from tidemark.session import is_small, workspace
from tidemark.streaming.windows import sliding, tumbling

BOAT = "boat int, name string, rig string, metres int"


@pytest.fixture
def boats(spark):
    data = [(31, "Heron", "sloop", 9), (32, "Tern", "ketch", 14), (33, "Dunlin", "dinghy", 4), (34, "Gannet", "sloop", 12), (35, "Plover", "dinghy", 5), (36, "Knot", "ketch", 17)]
    return spark.createDataFrame(data, BOAT)


@pytest.fixture
def visits(spark):
    data = [(1, 32, 3), (2, 32, 2), (3, 34, 1), (4, 33, 6), (5, 36, 2), (6, 77, 4), (7, None, 1)]
    return spark.createDataFrame(data, "visit int, boat int, nights int")


def test_sort_by_a_column_left_out(boats):
    out = boats.filter("metres >= 9").select("name").orderBy(F.col("metres").desc())
    assert [r[0] for r in out.collect()] == ["Knot", "Tern", "Gannet", "Heron"]


def test_nights_per_rig(boats, visits):
    out = visits.join(boats, "boat").groupBy("rig").agg(F.sum("nights"))
    assert rows(out) == [("dinghy", 6), ("ketch", 7), ("sloop", 1)]


@pytest.fixture(params=["sent", "shuffled"])
def either_way(request, monkeypatch):
    """Merges with a source that is sent to all tasks, and with one that is shuffled."""
    monkeypatch.setattr("tidemark.operators.merge.is_small", lambda df: request.param == "sent")
    return request.param


def test_upsert(spark, boats, either_way):
    surveys = spark.createDataFrame([(34, 13), (40, 8), (None, 6)], "boat int, length int")
    fill = {"boat": F.col("s.boat"), "name": F.lit("unnamed"), "metres": F.col("s.length")}
    plan = merge_into(boats, surveys, "boat").when_matched_update({"metres": F.col("s.length")}).when_not_matched_insert(fill)
    got = {r.boat: (r.name, r.rig, r.metres) for r in plan.to_df().collect()}
    assert got[34] == ("Gannet", "sloop", 13) and got[31] == ("Heron", "sloop", 9)
    assert got[40] == ("unnamed", None, 8) and got[None] == ("unnamed", None, 6)
    assert len(got) == 8
    kinds = plan.changes().groupBy("_change_type").count()
    assert rows(kinds) == [("insert", 2), ("update_postimage", 1), ("update_preimage", 1)]


def test_merge_refuses_an_ambiguous_source(spark, boats, either_way):
    surveys = spark.createDataFrame([(34, 13), (34, 14)], "boat int, length int")
    plan = merge_into(boats, surveys, "boat").when_matched_update({"metres": F.col("s.length")})
    for told in (plan.to_df(), plan.changes()):
        with pytest.raises(PySparkException, match=DUPLICATE_SOURCE):
            told.collect()


def test_target_rows_may_share_a_key(spark, either_way):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (3, "y")], "k int, v string")
    plan = merge_into(target, source, "k").when_matched_update({"v": F.concat("t.v", "s.v")}).when_not_matched_insert()
    assert rows(plan.to_df()) == [(1, "az"), (1, "bz"), (2, "c"), (3, "y")]


def test_first_clause_wins_and_null_keys_never_match(spark, either_way):
    target = spark.createDataFrame([(4, 40), (5, 50), (6, 60), (None, 70)], "k int, v int")
    source = spark.createDataFrame([(4, -1), (5, -2), (None, -3), (None, -4), (8, -5), (9, 5)], "k int, v int")
    plan = merge_into(target, source, "k").when_matched_delete(F.col("s.v") == -2).when_matched_update({"v": F.col("t.v") + F.col("s.v")})
    plan.when_not_matched_insert(condition=F.col("s.v") < -4).when_not_matched_insert({"k": F.lit(0)}, F.col("s.k").isNull())
    assert rows(plan.to_df()) == sorted([(4, 39), (6, 60), (None, 70), (8, -5), (0, None), (0, None)], key=str)
    assert rows(plan.changes()) == sorted(
        [("delete", 5, 50), ("update_preimage", 4, 40), ("update_postimage", 4, 39), ("insert", 8, -5), ("insert", 0, None), ("insert", 0, None)], key=str
    )


def test_null_safe_merge(spark, either_way):
    target = spark.createDataFrame([(1, None, 10), (None, None, 20)], "a int, b string, v int")
    source = spark.createDataFrame([(None, None, 5), (1, "x", 6)], "a int, b string, v int")
    plan = merge_into(target, source, ["a", "b"], null_safe=True).when_matched_update({"v": F.col("s.v")}).when_not_matched_insert()
    assert rows(plan.to_df()) == sorted([(1, None, 10), (None, None, 5), (1, "x", 6)], key=str)


def test_a_merge_shuffles_each_side_once(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.merge.is_small", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, source = (spark.range(n).selectExpr("id AS k", "id * 2 AS v") for n in (1_000, 1_500))
        plan = merge_into(target, source, "k").when_matched_update({"v": F.col("s.v")}).when_not_matched_insert()
        joined = plan_of(merge_into(target, source, "k", null_safe=True).when_matched_update({"v": F.col("s.v")}).when_not_matched_insert().to_df())
        assert joined.count("hashpartitioning") == 2 and joined.count("SortMergeJoin") >= 1
        assert plan.to_df().count() == 1_500
        diff = snapshot_diff(target, source, "k")
        assert plan_of(diff).count("hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_difference_of_snapshots(spark):
    cols = "k int, part string, v int"
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3), (None, "a", 4), (3, None, 5)], cols)
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 9), (None, "a", 7), (3, None, 5), (4, "a", 6)], cols)
    assert rows(snapshot_diff(old, new, ["k", "part"])) == sorted(
        [
            ("update_preimage", 1, "b", 2), ("update_postimage", 1, "b", 9), ("delete", 2, "a", 3),
            ("update_preimage", None, "a", 4), ("update_postimage", None, "a", 7), ("insert", 4, "a", 6),
        ],
        key=str,
    )
    with pytest.raises(PySparkException, match=DUPLICATE_KEY):
        snapshot_diff(old, new, "k").collect()


def test_broadcast_hints_need_a_known_size(spark, tables):
    assert is_small(tables.nation) and is_small(tables.nation.filter("n_nationkey > 3").distinct())
    blown_up = tables.nation.select(F.explode(F.sequence(F.lit(0), F.lit(50_000_000))).alias("n"))
    assert not is_small(blown_up)
    assert is_small(tables.nation.join(tables.region, F.col("n_regionkey") == F.col("r_regionkey")))
    assert not is_small(tables.lineitem.join(tables.orders, F.col("l_orderkey") == F.col("o_orderkey")))
    assert not is_small(blown_up.groupBy("n").count()) and not is_small(blown_up.union(blown_up))
    assert not is_small(tables.nation.mapInPandas(lambda batches: batches, tables.nation.schema))


def test_unmatched_rows_of_either_side(boats, visits):
    out = unmatched(boats, visits, "boat").select("boat", "name", "visit")
    assert rows(out) == sorted([(31, "Heron", None), (35, "Plover", None), (77, None, 6), (None, None, 7)], key=str)


def test_boats_that_never_called(boats, visits):
    assert rows(boats.join(visits, "boat", "left_anti").select("boat")) == [(31,), (35,)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_steps_against_a_model(spark, seed):
    """A versioned table and a dictionary go through the same steps; every version is as the dictionary was then."""
    rng = random.Random(seed)
    table = VersionedTable(spark, workspace(spark, "walk"), key=["shelf", "slot"])
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], "shelf string, slot int, jars int")
    model = {(s, n): n for s in ("a", None) for n in range(4)}
    table.create(frame(model))
    states = [dict(model)]
    for step in range(7):
        kind = rng.choice(["update", "delete", "append", "merge", "compact"])
        n = rng.randrange(6)
        if kind == "update":
            table.update(F.col("slot") >= n, {"jars": F.col("jars") * 3 + n})
            model = {k: v * 3 + n if k[1] >= n else v for k, v in model.items()}
        elif kind == "delete":
            table.delete((F.col("slot") == n) & F.col("shelf").isNull())
            model.pop((None, n), None)
        elif kind == "append":
            new = {("new", 100 * step + k): k for k in range(n)}
            table.append(frame(new))
            model = model | new
        elif kind == "merge":
            source = {(rng.choice(["a", "b", None]), k): -k for k in range(n)}
            clauses = lambda p: p.when_matched_delete(F.col("t.jars") % 2 == 1).when_matched_update({"jars": F.col("s.jars")}).when_not_matched_insert()
            table.merge(frame(source), ["shelf", "slot"], clauses, null_safe=True)
            odd = {k for k in source if k in model and model[k] % 2 == 1}
            model = {k: v for k, v in (model | source).items() if k not in odd}
        else:
            table.compact()
        states.append(dict(model))
    for version, state in enumerate(states):
        assert rows(table.as_of(version)) == sorted([(*k, v) for k, v in state.items()], key=str)
    assert rows(table.change_feed(1).groupBy().agg(F.count("*"))) == rows(table.history().filter("version > 0").agg(F.sum(F.col("inserted") + 2 * F.col("updated") + F.col("deleted"))))


HIVE = "hive long, queen string, field string"


@pytest.fixture
def hives(spark):
    table = VersionedTable(spark, workspace(spark, "hives"), key="hive")
    table.create(spark.createDataFrame([(70, "Ada", "heath"), (71, "Bee", "clover"), (72, "Cleo", "lime"), (73, "Dora", "heath")], HIVE))
    table.delete(F.col("field") == "lime")
    table.update(F.col("hive") > 71, {"field": F.lit("rape")})
    return table


def test_change_feed(hives):
    feed = hives.change_feed().drop("_commit_timestamp")
    first = [(70, "Ada", "heath"), (71, "Bee", "clover"), (72, "Cleo", "lime"), (73, "Dora", "heath")]
    want = [(*r, "insert", 0) for r in first] + [(72, "Cleo", "lime", "delete", 1)]
    want += [(73, "Dora", "heath", "update_preimage", 2), (73, "Dora", "rape", "update_postimage", 2)]
    assert rows(feed) == sorted(want, key=str)
    assert hives.change_feed(1, 1).count() == 1


def test_feed_equals_snapshot_diff(hives):
    stored = hives.change_feed(1).select("_change_type", "hive", "queen", "field")
    assert rows(stored) == rows(snapshot_diff(hives.as_of(0), hives.as_of(), "hive"))


def test_time_travel_by_timestamp(hives):
    first = next(r.timestamp for r in hives.history().collect() if r.version == 0)
    assert hives.as_of(timestamp=first).count() == 4
    with pytest.raises(ValueError):
        hives.as_of(40)


def test_overwrite_is_a_version(spark, hives):
    hives.create(spark.createDataFrame([(80, "Eve", "moor")], HIVE))
    assert rows(hives.as_of()) == [(80, "Eve", "moor")]
    assert hives.as_of(0).count() == 4
    assert rows(hives.change_feed(3).groupBy("_change_type").count()) == [("delete", 3), ("insert", 1)]


def test_update_sees_the_row_as_it_was(spark):
    table = VersionedTable(spark, workspace(spark, "swap"), key="k")
    table.create(spark.createDataFrame([(4, "left", "right")], "k int, a string, b string"))
    table.update(F.lit(True), {"a": F.col("b"), "b": F.col("a")})
    assert rows(table.as_of()) == [(4, "right", "left")]


def test_a_batch_is_applied_once(spark):
    table = VersionedTable(spark, workspace(spark, "once"))
    table.create(spark.range(7))
    assert table.append(spark.range(4), batch_tag="feed#9") == 1
    assert table.append(spark.range(4), batch_tag="feed#9") is None
    assert table.as_of().count() == 11


def test_an_uncommitted_write_is_invisible(spark, hives):
    orphan = spark.createDataFrame([(99, "Nobody", "moor", "insert")], HIVE + ", _change_type string")
    orphan.write.parquet(f"{hives.path}/changes/_version=3")
    assert hives.as_of().count() == 3
    hives.append(spark.createDataFrame([(81, "Flo", "moor")], HIVE))
    assert sorted(r.hive for r in hives.as_of().collect()) == [70, 71, 73, 81]


def test_appending_new_columns_needs_consent(spark):
    table = VersionedTable(spark, workspace(spark, "evolve"))
    table.create(spark.range(3))
    wider = spark.range(10, 11).withColumn("remark", F.lit("late"))
    with pytest.raises(ValueError):
        table.append(wider)
    table.append(wider, evolve=True)
    assert rows(table.as_of()) == [(0, None), (1, None), (10, "late"), (2, None)]
    assert table.as_of(0).columns == ["id"]


def test_range_partitions(spark):
    parcels = spark.createDataFrame([(g,) for g in (2, 40, 41, 500, 501, 502, 9_000)], "grams int")
    out = partition_counts(parcels, "grams", [40, 500], ["letter", "packet", "freight"])
    assert rows(out) == [(1, 2, "letter"), (2, 2, "packet"), (3, 3, "freight")]
    edge = spark.createDataFrame([(7,), (8,), (None,)], "v int").select(range_partition("v", [7]))
    assert [r[0] for r in edge.collect()] == [1, 2, 1]


def test_delay_status(spark):
    delays = spark.createDataFrame([(d,) for d in (-300, -1, 0, 9, 10, 29, 30, 400, None)], "delay int")
    got = [r[0] for r in delays.select(route_status("delay")).collect()]
    assert got == ["Early", "Early", "On Time", "On Time", "Late", "Late", "Delay", "Delay", "Delay"]
    with pytest.raises(ValueError):
        bucket_case("delay", [1], ["only one"])


@pytest.fixture
def tides(spark):
    """Water levels of two harbours every four seconds, by a rule."""
    noon = dt.datetime(2024, 3, 9, 12, 0, 0)
    data = [(port, float((7 * n + shift) % 13), noon + dt.timedelta(seconds=4 * n)) for port, shift in (("north", 0), ("south", 5)) for n in range(12)]
    return data, spark.createDataFrame(data, "port string, level double, at timestamp")


def by_window(data, size, slide):
    """Levels per port and window start (seconds of the epoch), by the definition."""
    out = {}
    for port, level, at in data:
        second = int(at.replace(tzinfo=dt.timezone.utc).timestamp())
        for start in range(second // slide * slide, second - size, -slide):
            out.setdefault((port, start), []).append(level)
    return out


def epoch(df):
    return df.withColumn("start", F.unix_timestamp("window_start"))


def test_tumbling_means(tides):
    data, frame = tides
    out = epoch(tumbling(frame, "at", "10 seconds", [F.round(F.avg("level"), 6).alias("mean")], keys=["port"]))
    want = {k: round(sum(v) / len(v), 6) for k, v in by_window(data, 10, 10).items()}
    assert {(r.port, r.start): r["mean"] for r in out.collect()} == want


def test_sliding_maximum(tides):
    data, frame = tides
    out = epoch(sliding(frame, "at", "24 seconds", "8 seconds", ["port"], [F.max("level").alias("top")]))
    assert {(r.port, r.start): r.top for r in out.collect()} == {k: max(v) for k, v in by_window(data, 24, 8).items()}


def test_fixed_chunks(spark):
    text = "".join(chr(97 + i % 26) for i in range(1000)) + "é😀"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, text string")
    for size, overlap in ((512, 50), (512, 0), (100, 80), (7, 6)):
        step = size - overlap
        want = [text[s : s + size] for s in range(0, len(text), step)]
        got = chunk_fixed(df, "id", "text", size, overlap).orderBy("chunk_index").collect()
        assert [r.chunk_text for r in got] == want
        assert {r.id for r in got} == {1}
    with pytest.raises(ValueError):
        chunk_fixed(df, "id", "text", 50, 50)


def test_arrays(spark):
    throws = spark.createDataFrame([Row(player="x", points=[4, 20]), Row(player="y", points=[]), Row(player="z", points=[1, 1, 5, 2])])
    out = throws.select("player", F.size("points"), F.array_max("points"))
    assert rows(out) == [("x", 2, 20), ("y", 0, None), ("z", 4, 5)]
    each = throws.select("player", F.explode_outer("points").alias("point"))
    assert each.count() == 7
    assert rows(each.groupBy("player").agg(F.avg("point"))) == [("x", 12.0), ("y", None), ("z", 2.25)]


def test_union_is_positional(spark):
    a = spark.createDataFrame([(5, "oak")], "ring int, Tree string")
    b = spark.createDataFrame([("elm", 6)], "species string, year int").select("year", "species")
    assert a.union(b).columns == ["ring", "Tree"]
    assert rows(a.union(b)) == [(5, "oak"), (6, "elm")]


def test_folded_elements_start_with_the_separator(spark):
    df = spark.createDataFrame(
        [
            ('{"document":{"elements":[{"content":"a"},{"content":"b"}]}}',),
            ('{"document":{"elements":[]}}',),
            ('{"document":{"elements":[{"content":"a"},{}]}}',),
        ],
        "j string",
    )
    assert [r[0] for r in df.select(fold_elements("j")).collect()] == ["\na\nb", "", None]


def test_scores_and_code_blocks(spark):
    texts = ["Score 7.5/10", "SCORE: 42", "none", "0 of ten", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(extract_score("t")).collect()] == [7.5, 10.0, 5.0, 1.0, 5.0]
    raw = spark.createDataFrame([("x\n```python\nprint(1)\n\n```\ny",), ("  plain \n",), ("```\na\n``` ```\nb\n```",)], "t string")
    assert [r[0] for r in raw.select(extract_fenced("t")).collect()] == ["print(1)", "plain", "a"]


def test_null_key_is_a_key(spark):
    table = VersionedTable(spark, workspace(spark, "nullkey"), key="id")
    table.create(spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string"))
    table.update(F.col("id").isNull(), {"v": F.lit("c")})
    assert rows(table.as_of()) == rows(spark.createDataFrame([(1, "a"), (None, "c")], "id int, v string"))


def test_compaction_counts_live_files_only(spark, monkeypatch):
    monkeypatch.setattr("tidemark.operators.versions.target_files", partial(target_files, target_bytes=20_000))
    table = VersionedTable(spark, workspace(spark, "compacted"), key="id")
    table.create(spark.range(10_000).select("id", F.md5(F.col("id").cast("string")).alias("v")))
    counts = []
    for _ in range(3):
        version = table.compact()
        files = spark.read.parquet(table.snapshot_path(version)).select("_metadata.file_path").distinct().count()
        counts.append(files)
    assert max(counts) <= counts[0] + 2
    assert table.as_of().count() == 10_000
