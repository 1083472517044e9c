"""Structured Streaming: sources, windows, modes, restarts and change-data-capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.versions import VersionedTable
from tidemark.plans import derive
from tidemark.queries import maintenance
from tidemark.queries.registry import query
from tidemark.session import workspace
from tidemark.sources import Tables, write_csv
from tidemark.streaming import windows
from tidemark.streaming.feed import stream_changes
from tidemark.streaming.flights import CDC_SCHEMA, clean_flights, enrich_flights, run_cdc_stream
from tidemark.streaming.runner import run_stream, run_with_retry
from tidemark.streaming.sources import event_time, stream_files, stream_table

_SILVER = f"WITH {derive.FLIGHTS_SQL} "


class Streamed(Tables):
    """The same tables as streams."""

    def __getattr__(self, name: str) -> DataFrame:
        # The pattern lets a table be one file as well as a folder of files.
        path = f"{self.folder}/{name}.parquet"
        return stream_files(self.spark, f"{path}*", self.spark.read.parquet(path).schema)


def flight_stream(t: Tables) -> DataFrame:
    live = Streamed(t.spark, t.folder)
    return enrich_flights(clean_flights(derive.flights(live), derive.EVENT_YEAR), derive.airports(t))


def plain_times(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as plain ones, for comparison with other engines."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def tumbling_sql(size: str, select: str, late: str, keys: str = "") -> str:
    """Closed windows only: append mode never gives out one that ends after the watermark."""
    return (
        _SILVER + f"SELECT w AS window_start, w + INTERVAL '{size}' AS window_end, {select} FROM (SELECT *, "
        f"time_bucket(INTERVAL '{size}', event_timestamp, TIMESTAMP '1970-01-01') AS w FROM silver) "
        f"GROUP BY w{keys} HAVING w + INTERVAL '{size}' <= (SELECT max(event_timestamp) - INTERVAL '{late}' FROM silver)"
    )


def sliding_sql(size: str, slide: str, n: int, select: str, late: str, keys: str = "") -> str:
    fmt = "'%Y-%m-%d %H:%M:%S'"
    return (
        _SILVER + f"SELECT strftime(w, {fmt}) AS window_start, strftime(w + INTERVAL '{size}', {fmt}) AS window_end, {select} "
        f"FROM (SELECT *, time_bucket(INTERVAL '{slide}', event_timestamp, TIMESTAMP '1970-01-01') "
        f"- i * INTERVAL '{slide}' AS w FROM silver, range({n}) r(i)) "
        f"GROUP BY w{keys} HAVING w + INTERVAL '{size}' <= (SELECT max(event_timestamp) - INTERVAL '{late}' FROM silver)"
    )


@query("stream_file_source", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def stream_file_source(t: Tables) -> DataFrame:
    path = write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), workspace(t.spark, "landing"))
    return run_stream(stream_files(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double", "csv"))


@query("stream_table_source", "SELECT event_id, user_id, event_type, value FROM events")
def stream_table_source(t: Tables) -> DataFrame:
    return run_stream(Streamed(t.spark, t.folder).events.select("event_id", "user_id", "event_type", "value"))


@query(
    "stream_change_feed",
    maintenance._FEED + "SELECT _change_type AS change_type, count(*) AS n_changes FROM feed GROUP BY 1",
)
def stream_change_feed(t: Tables) -> DataFrame:
    """Changes per type and 10 seconds of commit time, streamed from the table itself version by version; the times
    are those of this run, so the counts are added up over the windows."""
    feed = stream_changes(maintenance._accounts(t))
    per_window = run_stream(windows.stream_change_counts(feed), mode="update", keys=["window_start", "change_type"], once_per_batch=True)
    return per_window.groupBy("change_type").agg(F.sum("n_changes").alias("n_changes"))


@query(
    "stream_enrich",
    _SILVER + "SELECT * FROM silver",
)
def stream_enrich(t: Tables) -> DataFrame:
    columns = [*maintenance._SILVER[:8], "event_timestamp", "seq"]
    return plain_times(run_stream(flight_stream(t).select(*columns)))


@query("stream_tumbling_count", tumbling_sql("1 hour", "count(*) AS flight_count", "1 hour"))
def stream_tumbling_count(t: Tables) -> DataFrame:
    return plain_times(run_stream(windows.hourly_counts(flight_stream(t), "event_timestamp")))


@query(
    "stream_tumbling_avg",
    tumbling_sql("30 days", "round(avg(delay / 60.0::double), 2) AS moving_avg_delay", "7 days"),
)
def stream_tumbling_avg(t: Tables) -> DataFrame:
    return plain_times(run_stream(windows.average_delay_hours(flight_stream(t), "event_timestamp")))


@query(
    "stream_tumbling_avg_keyed",
    "SELECT user_id, time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') AS window_start, "
    "time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds' AS window_end, "
    "round(avg(value), 6) AS avg_value FROM events GROUP BY 1, 2, 3",
)
def stream_tumbling_avg_keyed(t: Tables) -> DataFrame:
    """Mean per sensor (user) and 10 seconds: a window's last image stays, its state goes when it is closed."""
    events = Streamed(t.spark, t.folder).events
    aggs = [F.round(F.avg("value"), 6).alias("avg_value")]
    means = windows.tumbling(events, "ts", "10 seconds", aggs, "10 minutes", ["user_id"])
    return plain_times(run_stream(means, mode="update", keys=["window_start", "user_id"], once_per_batch=True))


@query("stream_tumbling_sum", tumbling_sql("14 days", "sum(distance)::bigint AS total_distance", "7 days"))
def stream_tumbling_sum(t: Tables) -> DataFrame:
    return plain_times(run_stream(windows.distance_totals(flight_stream(t), "event_timestamp")))


@query(
    "stream_tumbling_max_by",
    tumbling_sql(
        "30 days",
        "arg_min(standardized_route, (-delay, standardized_route)) AS worst_route, "
        "round(max(delay) / 60.0::double, 2) AS max_delay",
        "7 days",
    ),
)
def stream_tumbling_max_by(t: Tables) -> DataFrame:
    return plain_times(run_stream(windows.worst_routes(flight_stream(t), "event_timestamp")))


@query(
    "stream_sliding_avg",
    sliding_sql("7 days", "1 day", 7, "round(avg(delay / 60.0::double), 2) AS rolling_avg_delay_hours", "8 days"),
)
def stream_sliding_avg(t: Tables) -> DataFrame:
    return run_stream(windows.text_bounds(windows.rolling_delay(flight_stream(t), "event_timestamp")))


@query(
    "stream_sliding_route",
    sliding_sql(
        "14 days",
        "7 days",
        2,
        "standardized_route, count(*) AS flight_count, sum(distance)::bigint AS total_distance",
        "15 days",
        ", standardized_route",
    ),
)
def stream_sliding_route(t: Tables) -> DataFrame:
    return run_stream(windows.text_bounds(windows.route_traffic(flight_stream(t), "event_timestamp")))


@query(
    "stream_sliding_status",
    sliding_sql("3 hours", "1 hour", 3, "take_off_status, count(*) AS flight_count", "4 hours", ", take_off_status"),
)
def stream_sliding_status(t: Tables) -> DataFrame:
    return run_stream(windows.text_bounds(windows.status_counts(flight_stream(t), "event_timestamp")))


@query(
    "stream_sliding_max",
    "SELECT w AS window_start, w + INTERVAL '20 seconds' AS window_end, event_type, max(value) AS max_value "
    "FROM (SELECT *, time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '10 seconds' AS w "
    "FROM events, range(2) r(i)) GROUP BY w, event_type",
)
def stream_sliding_max(t: Tables) -> DataFrame:
    """The largest value per type; a window's last image stays, its state goes when it is closed."""
    events = Streamed(t.spark, t.folder).events
    top = [F.max("value").alias("max_value")]
    largest = windows.sliding(events, "ts", "20 seconds", "10 seconds", ["event_type"], top, "10 minutes")
    return plain_times(run_stream(largest, mode="update", keys=["window_start", "event_type"], once_per_batch=True))


@query(
    "stream_word_count",
    "SELECT w AS window_start, w + INTERVAL '5 seconds' AS window_end, word, count(*) AS n FROM ("
    "SELECT word, second, TIMESTAMP '2024-01-01' + (second // 2 * 2 - 2 * i) * INTERVAL '1 second' AS w, "
    "second // 2 * 2 - 2 * i + 5 > second AS inside FROM ("
    "SELECT unnest(string_split(text, ' ')) AS word, conv_id * 8 + turn AS second FROM conversations), range(3) r(i)) "
    "WHERE inside GROUP BY w, word",
)
def stream_word_count(t: Tables) -> DataFrame:
    """Messages arrive one per second; words per 5 seconds every 2 seconds, update mode."""
    lines = Streamed(t.spark, t.folder).conversations.select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 8 + F.col("turn")).alias("timestamp"), "text"
    )
    counts = windows.stream_word_count(lines, "timestamp", "text")
    return plain_times(run_stream(counts, mode="update", keys=["window_start", "word"], once_per_batch=True))


@query("stream_running_count", 'SELECT event_id % 3 AS "group", count(*) AS n FROM events GROUP BY 1')
def stream_running_count(t: Tables) -> DataFrame:
    events = Streamed(t.spark, t.folder).events
    running = events.groupBy((F.col("event_id") % 3).alias("group")).agg(F.count("*").alias("n"))
    return run_stream(running, mode="complete")


@query(
    "stream_late_data",
    "WITH wm AS (SELECT max(ts) - INTERVAL '1 hour' AS first, max(ts) + INTERVAL '47 hours' AS last FROM events), "
    "delivered AS (SELECT 1 AS run, ts FROM events UNION ALL SELECT 2, ts - INTERVAL '30 minutes' FROM events "
    "UNION ALL SELECT 3, ts + INTERVAL '2 days' FROM events), "
    "windowed AS (SELECT run, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS w FROM delivered) "
    "SELECT w AS window_start, w + INTERVAL '1 hour' AS window_end, count(*) AS n FROM windowed, wm "
    "WHERE run = 1 OR w + INTERVAL '1 hour' > wm.first GROUP BY w, wm.last HAVING w + INTERVAL '1 hour' <= wm.last",
)
def stream_late_data(t: Tables) -> DataFrame:
    """Three deliveries with one checkpoint: the events, copies half an hour older, copies two days
    newer. Rows of windows that the first delivery closed are dropped."""
    landing, out = workspace(t.spark, "late"), workspace(t.spark, "late-out")
    events = event_time(t.events, "ts").select("event_id", "ts")
    result = None
    for shift in ("0 minutes", "-30 minutes", "2 days"):
        events.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL '{shift}'")).write.mode("append").parquet(landing)
        counts = windows.tumbling(stream_table(t.spark, landing), "ts", "1 hour", [F.count("*").alias("n")], "1 hour")
        result = run_stream(counts, path=out)
    return plain_times(result)


@query(
    "stream_output_modes",
    "WITH w AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS d, count(*) AS n FROM events GROUP BY 1), "
    "closed AS (SELECT * FROM w WHERE d + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)) "
    "SELECT 'append' AS mode, count(*) AS n_windows, sum(n)::bigint AS n_events FROM closed "
    "UNION ALL SELECT 'update', count(*), sum(n)::bigint FROM w UNION ALL SELECT 'complete', count(*), sum(n)::bigint FROM w",
)
def stream_output_modes(t: Tables) -> DataFrame:
    out = None
    for mode in ("append", "update", "complete"):
        events = Streamed(t.spark, t.folder).events
        counts = windows.tumbling(events, "ts", "1 day", [F.count("*").alias("n")], "1 hour")
        stored = run_stream(counts, mode=mode, keys=["window_start"], once_per_batch=True)
        row = stored.agg(F.count("*").alias("n_windows"), F.sum("n").alias("n_events"))
        row = row.select(F.lit(mode).alias("mode"), "n_windows", "n_events")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "stream_triggers",
    "SELECT 'availableNow' AS kind, count(*) AS n_events, max(value) AS top FROM events "
    "UNION ALL SELECT 'processingTime', count(*), max(value) FROM events",
)
def stream_triggers(t: Tables) -> DataFrame:
    out = None
    for kind, trigger in (("availableNow", {"availableNow": True}), ("processingTime", {"processingTime": "1 second"})):
        events = Streamed(t.spark, t.folder).events.select("event_id", "value")
        row = run_stream(events, trigger=trigger).agg(F.count("*").alias("n_events"), F.max("value").alias("top"))
        row = row.select(F.lit(kind).alias("kind"), "n_events", "top")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "stream_checkpoint_resume",
    "WITH c AS (SELECT count(*) AS n FROM customer), s AS (SELECT count(*) AS n FROM supplier) "
    "SELECT 1 AS run, c.n AS n_rows FROM c UNION ALL SELECT 2, c.n + s.n FROM c, s UNION ALL SELECT 3, c.n + s.n FROM c, s",
)
def stream_checkpoint_resume(t: Tables) -> DataFrame:
    """Run, add files, run, run again: only new files are processed."""
    landing, sink = workspace(t.spark, "landing"), workspace(t.spark, "resumed")
    deliveries = [
        t.customer.select(F.col("c_name").alias("name")),
        t.supplier.select(F.col("s_name").alias("name")),
        None,
    ]
    rows = []
    for run, delivery in enumerate(deliveries, start=1):
        if delivery is not None:
            delivery.write.mode("append").parquet(landing)
        stored = run_stream(stream_table(t.spark, landing), path=sink)
        rows.append((run, stored.count()))
    return t.spark.createDataFrame(rows, "run int, n_rows bigint")


@query("stream_retry_fresh_ckpt", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_retry_fresh_ckpt(t: Tables) -> DataFrame:
    """The first attempt meets the checkpoint of a query over two sources and fails; the second
    starts afresh."""
    live = Streamed(t.spark, t.folder)
    taken = workspace(t.spark, "taken-checkpoint")
    both = live.customer.select(F.col("c_name").alias("name")).union(live.supplier.select("s_name"))
    run_stream(both, checkpoint=taken)
    counts = live.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return run_with_retry(lambda checkpoint: run_stream(counts, mode="complete", checkpoint=checkpoint), t.spark, taken)


def silver_table(t: Tables) -> VersionedTable:
    silver = maintenance.silver_flights(t)
    table = VersionedTable(t.spark, workspace(t.spark, "silver"), key="flight_id")
    table.create(silver.select(*maintenance._SILVER[:8], "event_timestamp", "seq"))
    return table


@query("stream_cdc_merge", f"WITH {derive.FLIGHTS_SQL}, {derive.CDC_SQL} SELECT * FROM merged")
def stream_cdc_merge(t: Tables) -> DataFrame:
    landing = workspace(t.spark, "cdc")
    derive.cdc_events(t).write.json(landing)
    events = stream_files(t.spark, landing, CDC_SCHEMA, "json")
    return plain_times(run_cdc_stream(events, silver_table(t), workspace(t.spark, "cdc-checkpoint")))


@query(
    "stream_sinks",
    "SELECT 'parquet' AS sink, count(*) AS n FROM events UNION ALL SELECT 'table', count(*) FROM events "
    "UNION ALL SELECT 'memory', count(*) FROM events",
)
def stream_sinks(t: Tables) -> DataFrame:
    """The memory sink only gets a count per event type."""
    events = Streamed(t.spark, t.folder).events
    per_type = events.groupBy("event_type").agg(F.count("*").alias("n"))
    stored = [
        run_stream(events.select("event_id")).agg(F.lit("parquet").alias("sink"), F.count("*").alias("n")),
        run_stream(events.select("event_id"), sink="table").agg(F.lit("table").alias("sink"), F.count("*").alias("n")),
        run_stream(per_type, mode="complete", sink="memory").agg(F.lit("memory").alias("sink"), F.sum("n").alias("n")),
    ]
    return stored[0].unionByName(stored[1]).unionByName(stored[2])
