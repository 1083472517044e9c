"""Restarts, replays, late data and batch/stream agreement."""

import pytest
from conftest import SMALL, plan_of, rows
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators.versions import VersionedTable
from tidemark.plans import derive
from tidemark.plans.flights import GOLD, run_flight_pipeline
from tidemark.queries import pipelines
from tidemark.queries.streams import Streamed
from tidemark.session import workspace
from tidemark.sources import RESCUED_COLUMN, read_rescued, write_csv
from tidemark.streaming import flights, windows
from tidemark.streaming.feed import stream_changes
from tidemark.streaming.runner import StreamTimeout, last_committed, run_stream, run_with_retry
from tidemark.streaming.sources import event_time, stream_files, stream_rate, stream_table


def test_complete_mode_equals_batch(spark, tables):
    aggs = [F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("v")]
    batch = windows.tumbling(tables.events, "ts", "1 hour", aggs, keys=["event_type"])
    live = windows.tumbling(Streamed(spark, SMALL).events, "ts", "1 hour", aggs, keys=["event_type"])
    assert rows(run_stream(live, mode="complete")) == rows(batch)


def test_only_new_files_are_read_after_a_restart(spark):
    landing, sink = workspace(spark, "landing"), workspace(spark, "sink")
    counts = []
    for new in (10, 5, 0):
        if new:
            spark.range(new).write.mode("append").parquet(landing)
        counts.append(run_stream(stream_table(spark, landing), path=sink).count())
    assert counts == [10, 15, 15]


def test_append_without_watermark_is_refused(spark, tables):
    running = Streamed(spark, SMALL).events.groupBy("event_type").count()
    with pytest.raises(AnalysisException):
        run_stream(running)


def test_rate_source_counts(spark):
    """A source that never runs dry ends by its limit, and says so; what it had committed is there."""
    counted = []
    rate = stream_rate(spark, 50).groupBy((F.col("value") % 3).alias("g")).count()
    query = rate.writeStream.outputMode("complete").foreachBatch(lambda df, n: counted.append(df.agg(F.sum("count")).first()[0]))
    running = query.option("checkpointLocation", workspace(spark, "rate")).trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(60):
            if any(counted) or not running.isActive:
                break
            running.awaitTermination(0.5)
    finally:
        running.stop()
    assert any(counted)


def many_files(spark, n, rows_each=20):
    """``n`` files, one per hour of event time, each a micro-batch of its own."""
    landing = workspace(spark, "hours")
    for hour in range(n):
        start = 1704067200 + 3600 * hour
        df = spark.range(rows_each).selectExpr(f"timestamp_seconds({start} + id * 60) AS ts", "id % 4 AS k", "id AS v")
        df.coalesce(1).write.mode("append").parquet(landing)
    return landing


def test_a_clock_trigger_reads_all_its_input(spark):
    """More micro-batches than fit into any short time; nothing is left out."""
    landing = many_files(spark, 8)
    slow = stream_table(spark, landing, max_files=1).select("v")
    assert run_stream(slow, trigger={"processingTime": "1 second"}).count() == 160


def test_a_limit_raises_and_never_returns_a_part(spark):
    landing = many_files(spark, 8)
    checkpoint, sink = workspace(spark, "limited"), workspace(spark, "limited-sink")
    frame = lambda: stream_table(spark, landing, max_files=1).select("v")
    for trigger in ({"processingTime": "2 seconds"}, {"availableNow": True}):
        with pytest.raises(StreamTimeout):
            run_stream(frame(), trigger=trigger, limit_seconds=0.5)
    with pytest.raises(StreamTimeout):
        run_stream(frame(), path=sink, checkpoint=checkpoint, trigger={"processingTime": "2 seconds"}, limit_seconds=3)
    assert run_stream(frame(), path=sink, checkpoint=checkpoint).count() == 160  # goes on where it was stopped


@pytest.mark.parametrize("kind", ["max", "words", "mean"])
def test_state_of_closed_windows_is_dropped(spark, kind):
    """Ten files an hour apart: the state of the tenth is as large as that of the third."""
    stream = stream_table(spark, many_files(spark, 10), max_files=1)
    if kind == "max":
        df, keys = windows.sliding(stream, "ts", "20 seconds", "10 seconds", ["k"], [F.max("v").alias("top")], "10 minutes"), ["window_start", "k"]
    elif kind == "mean":
        df, keys = windows.tumbling(stream, "ts", "10 seconds", [F.avg("v").alias("mean")], "10 minutes", ["k"]), ["window_start", "k"]
    else:
        lines = stream.select("ts", F.concat_ws(" ", F.lit("a"), F.col("v").cast("string")).alias("text"))
        df, keys = windows.stream_word_count(lines, "ts", "text"), ["window_start", "word"]
    progress = []
    out = run_stream(df, mode="update", keys=keys, progress=progress)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["numInputRows"]]
    assert len(sizes) == 10 and max(sizes[2:]) <= sizes[2] < sum(p["stateOperators"][0]["numRowsUpdated"] for p in progress)
    assert out.select("window_start").distinct().count() > 10 * 10  # closed windows stay in the sink


def test_one_batch_of_updates_is_not_ranked(spark):
    """Rows of one batch are the result; with a second batch the last image of each key is."""
    landing, sink = workspace(spark, "words"), workspace(spark, "words-sink")

    def counted(*texts):
        made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
        made.selectExpr("timestamp_seconds(1704067200 + i) AS ts", "text").coalesce(1).write.mode("append").parquet(landing)
        df = windows.stream_word_count(stream_table(spark, landing), "ts", "text")
        return run_stream(df, mode="update", path=sink, keys=["window_start", "word"], once_per_batch=True)

    def expected():
        return rows(windows.stream_word_count(spark.read.parquet(landing), "ts", "text", watermark=None))

    once = counted("a b a", None, "b  c")
    assert "Window" not in plan_of(once) and rows(once) == expected()
    twice = counted("a", "", "d")
    assert "Window" in plan_of(twice) and rows(twice) == expected()


def test_keys_that_repeat_in_a_batch_are_still_ranked(spark):
    """Without the promise, one batch may give a key several times; one row per key is returned."""
    stream = stream_table(spark, many_files(spark, 1)).select("k", "v")
    assert sorted(r.k for r in run_stream(stream, mode="update", keys=["k"]).collect()) == [0, 1, 2, 3]


def test_no_updates_give_no_rows(spark):
    stream = stream_table(spark, many_files(spark, 1)).where("v < 0").groupBy("k").count()
    assert run_stream(stream, mode="update", keys=["k"], once_per_batch=True).collect() == []


def test_one_retry_with_a_fresh_checkpoint(spark):
    tried = []

    def start(checkpoint):
        tried.append(checkpoint)
        if len(tried) == 1:
            raise RuntimeError("stale offsets")
        return spark.range(3)

    assert run_with_retry(start, spark).count() == 3
    assert tried[0] != tried[1]

    def broken(checkpoint):
        raise RuntimeError("always")

    with pytest.raises(RuntimeError):
        run_with_retry(broken, spark)


def test_a_checkpoint_of_two_sources_is_retried(spark):
    """The real thing: a query over one source meets offsets of two, which the stream itself finds out."""
    one, two = many_files(spark, 1), many_files(spark, 1)
    taken = workspace(spark, "taken")
    run_stream(stream_table(spark, one).union(stream_table(spark, two)), checkpoint=taken)
    tried = []

    def start(checkpoint):
        tried.append(checkpoint)
        return run_stream(stream_table(spark, one), checkpoint=checkpoint)

    assert run_with_retry(start, spark, taken).count() == 20
    assert len(tried) == 2 and tried[0] == taken


def test_a_failure_in_mid_run_is_not_retried(spark):
    landing, checkpoint, tried = many_files(spark, 4), workspace(spark, "mid-run"), []

    def fails_later(batch, n):
        if n == 2:
            raise RuntimeError("sink is gone")

    def start(checkpoint):
        tried.append(checkpoint)
        flights.drain(stream_table(spark, landing, max_files=1), fails_later, checkpoint)

    with pytest.raises(StreamingQueryException):
        run_with_retry(start, spark, checkpoint)
    assert tried == [checkpoint] and last_committed(spark, checkpoint) == 1


def test_malformed_lines_are_rescued(spark):
    path = workspace(spark, "drift")
    lines = ["id,name", "1,a", "2,b,extra", "x,c"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    got = read_rescued(spark, path, "id int, name string").select("id", "name", RESCUED_COLUMN)
    assert rows(got) == sorted([(1, "a", None), (2, "b", "2,b,extra"), (None, "c", "x,c")], key=str)
    live = run_stream(stream_files(spark, path, "id int, name string", "csv", rescue=True))
    assert rows(live) == rows(got)


@pytest.fixture
def silver(spark):
    data = [(1, "01010000", "A-B", 100, 5, 3), (2, "01010001", "A-C", 100, 5, 3), (3, "01010002", "B-C", 100, 5, 3)]
    table = VersionedTable(spark, workspace(spark, "silver"), key="flight_id")
    table.create(spark.createDataFrame(data, "flight_id int, date string, standardized_route string, distance int, delay int, seq int"))
    return table


def event(action, seq, date, route, delay):
    payload = f'{{"date":"{date}","standardized_route":"{route}","distance":200,"delay":{delay}}}'
    return ("2025-01-01", action, seq, payload)


def cdc(spark, *events):
    return spark.createDataFrame(list(events), flights.CDC_SCHEMA)


def test_change_events(spark, silver):
    batch = cdc(
        spark,
        event("UPDATE", 4, "01010000", "A-B", 50),
        event("UPDATE", 5, "01010000", "A-B", 60),
        event("DELETE", 3, "01010001", "A-C", 0),
        event("INSERT", 9, "01010002", "B-C", 70),
        event("UPDATE", 9, "01019999", "Z-Z", 70),
    )
    merge = flights.cdc_merge_batch(silver, "s")
    merge(batch, 0)
    want = [(1, "01010000", "A-B", 200, 60, 5), (3, "01010002", "B-C", 100, 5, 3)]
    assert rows(silver.as_of()) == want
    version = silver.latest_version()
    merge(batch, 0)  # a replay of the same batch
    assert silver.latest_version() == version
    assert rows(silver.as_of()) == want


def test_older_events_by_option(spark, silver):
    old = cdc(spark, event("UPDATE", 1, "01010000", "A-B", 99))
    flights.cdc_merge_batch(silver, "guarded", sequence_by="seq")(old, 0)
    assert silver.as_of().filter("flight_id = 1").first().delay == 5
    flights.cdc_merge_batch(silver, "plain")(old, 0)
    assert silver.as_of().filter("flight_id = 1").first().delay == 99


@pytest.fixture
def stock(spark):
    """A versioned table with a snapshot, appended columns, an update, a delete and a compaction."""
    table = VersionedTable(spark, workspace(spark, "stock"), key="id")
    when = F.timestamp_seconds(F.lit(1700000000) + F.col("id"))
    table.create(spark.range(40).select("id", (F.col("id") % 3).cast("int").alias("n"), when.alias("at"), F.lit("1.50").cast("decimal(9,2)").alias("price")))
    table.append(spark.range(40, 45).select("id", F.lit(1).alias("n"), F.lit("x").alias("note")), evolve=True)
    table.update(F.col("id") < 5, {"n": F.lit(9)})
    table.compact()
    table.delete(F.col("id") > 42)
    return table


def streamed(table, name, **options):
    sink = f"{table.path}-{name}"
    return run_stream(stream_changes(table, **options), path=sink, checkpoint=f"{sink}-checkpoint")


def test_streamed_changes_are_the_feed(stock):
    got = streamed(stock, "whole")
    assert got.schema == stock.change_feed().schema
    assert rows(got) == rows(stock.change_feed())


def test_a_restarted_change_stream_reads_new_versions_only(spark, stock):
    before = streamed(stock, "live").count()
    # A version that is being written, or whose writer died: files without a history row.
    stock.as_of().limit(3).withColumn("_change_type", F.lit("insert")).write.parquet(f"{stock.path}/changes/_version=5")
    assert streamed(stock, "live").count() == before
    stock.update(F.col("id") == 7, {"n": F.lit(0)})  # takes its place
    progress = []
    sink = f"{stock.path}-live"
    after = run_stream(stream_changes(stock), path=sink, checkpoint=f"{sink}-checkpoint", progress=progress)
    assert sum(p["numInputRows"] for p in progress) == 2
    assert rows(after) == rows(stock.change_feed())


def test_a_change_stream_starts_at_a_version(stock):
    assert rows(streamed(stock, "late", starting_version=2)) == rows(stock.change_feed(2))


def test_changes_follow_an_overwrite(spark, stock):
    stock.create(spark.createDataFrame([(1, "again")], "id long, note string"))
    got = streamed(stock, "over", starting_version=5)
    assert rows(got.groupBy("_change_type").count()) == [("delete", 43), ("insert", 1)]


def test_unknown_airports(spark):
    raw = spark.createDataFrame([("01010000", "5", "10", "A", "X")], "date string, delay string, distance string, origin string, destination string")
    airports = spark.createDataFrame([("A", "Aville", "AA")], "airport_code string, city string, state string")
    clean = flights.clean_flights(raw, 2025)
    row = flights.enrich_flights(clean, airports).first()
    assert (row.departure, row.arrival, row.standardized_route, row.seq) == ("Aville, AA", "", "A-X", 3)
    assert flights.enrich_flights(clean, airports, require_places=True).count() == 0


def test_event_time_of_plain_timestamps(tables):
    assert event_time(tables.events, "ts").schema["ts"].dataType.typeName() == "timestamp"


def test_flight_pipeline_is_incremental(spark, tables):
    out, landing = workspace(spark, "flights"), workspace(spark, "landing")
    columns = "date string, delay string, distance string, origin string, destination string"
    sides = [derive.flights(tables).filter(f"flight_id % 2 = {i}").drop("flight_id") for i in (0, 1)]
    totals = []
    for side in sides:
        path = write_csv(side, f"{landing}/batch")
        tables_out = run_flight_pipeline(spark, f"{landing}/batch", derive.airports(tables), None, out, 2024, columns, ["hourly_tumbling_flights"])
        totals.append((tables_out["bronze"].count(), tables_out["silver"].count()))
        assert path
    assert totals == [(500, 500), (1000, 1000)]
    assert tables_out["silver"].select("flight_id").distinct().count() == 1000


def test_the_flight_job_builds_every_gold_table(tables, monkeypatch):
    built = {}

    def kept(*args, **options):
        built.update(run_flight_pipeline(*args, **options))
        return built

    monkeypatch.setattr(pipelines, "run_flight_pipeline", kept)
    pipelines.medallion_flights(tables)
    assert set(GOLD) <= set(built)
    tagged = {r.gold: r.n for r in pipelines.medallion_flights_gold(tables).groupBy("gold").agg(F.count("*").alias("n")).collect()}
    assert tagged == {name: n for name in GOLD if (n := built[name].count())}
