"""Flights from a landing folder to windowed business tables, with change events merged between."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.gold import ROWS, WindowSpec, WindowTable
from tidemark.operators.versions import VersionedTable
from tidemark.sources.writers import with_ingestion_ts
from tidemark.streaming import windows
from tidemark.streaming.flights import CDC_SCHEMA, clean_flights, drain, enrich_flights, load_batch, run_cdc_stream
from tidemark.streaming.runner import run_stream
from tidemark.streaming.sources import stream_files, stream_table

# Fixed value: the columns of the landed files.
LANDING_SCHEMA = "date string, delay string, distance string, origin string, destination string"
# The columns of the silver table and the names of the gold tables.
SILVER = [
    "flight_id",
    "date",
    "departure",
    "arrival",
    "standardized_route",
    "distance",
    "delay",
    "take_off_status",
    "ingestion_timestamp",
    "event_timestamp",
    "seq",
]
_HOURS = "round(try_divide(delay_sum, delay_n * 60D), 2)"
_FLIGHTS = {"flight_count": ROWS}
_DISTANCE = {"total_distance": "CASE WHEN distance_n > 0 THEN distance_sum END"}
_WORST = {
    # One ordering value carries delay and route, so the pick does not depend on row order.
    "worst_route": "min_by(standardized_route, CASE WHEN delay IS NOT NULL THEN struct(-delay, standardized_route) END)",
    "worst_delay": "max(delay)",
}
GOLD = {
    "monthly_delays": WindowSpec("30 days", timedelta(days=7), sums=["delay"], shown={"moving_avg_delay": _HOURS}),
    "biweekly_distance": WindowSpec("14 days", timedelta(days=7), sums=["distance"], shown=_DISTANCE),
    "monthly_max_delay": WindowSpec(
        "30 days", timedelta(days=7), picks=_WORST, shown={"worst_route": "worst_route", "max_delay": "round(worst_delay / 60D, 2)"}
    ),
    "hourly_tumbling_flights": WindowSpec("1 hour", timedelta(hours=1), shown=_FLIGHTS),
    "sliding_avg_delay": WindowSpec("7 days", timedelta(days=8), "1 day", sums=["delay"], shown={"rolling_avg_delay_hours": _HOURS}),
    "sliding_route_traffic": WindowSpec(
        "14 days", timedelta(days=15), "7 days", ["standardized_route"], ["distance"], shown=_FLIGHTS | _DISTANCE
    ),
    "sliding_hourly_status": WindowSpec("3 hours", timedelta(hours=4), "1 hour", ["take_off_status"], shown=_FLIGHTS),
}

# Versions that silver collects before the next run writes a new snapshot of it.
COMPACT_AFTER = 32


def run_flight_pipeline(
    spark: SparkSession,
    landing: str,
    airports: DataFrame,
    cdc: str | None,
    out: str,
    year: int | str,
    landing_schema: str = LANDING_SCHEMA,
    gold: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Run every stage on what is available now; a later run picks up only new files.

    Rows are given a ``flight_id`` at ingestion unless the landing schema has one. Change events make silver more than
    a growing table, so the gold tables follow its change feed (``WindowTable``): each takes in the versions that it has
    not seen, and rewrites the windows that these touch. A window is shown once it is closed: its end lies the table's
    lateness before the latest flight that has been loaded.
    """
    ck = f"{out}/checkpoints"
    raw = with_ingestion_ts(stream_files(spark, landing, landing_schema, "csv", rescue=True), "yyyy-MM-dd HH:mm:ss")
    if "flight_id" not in raw.columns:
        raw = raw.withColumn("flight_id", F.expr("uuid()"))
    bronze = run_stream(raw, path=f"{out}/bronze/flights", checkpoint=f"{ck}/bronze")
    enriched = enrich_flights(clean_flights(stream_table(spark, f"{out}/bronze/flights"), year), airports).select(*SILVER)
    silver = VersionedTable(spark, f"{out}/silver/flights", key="flight_id")
    drain(enriched, load_batch(silver, f"{ck}/silver"), f"{ck}/silver")
    if cdc is not None:
        run_cdc_stream(stream_files(spark, cdc, CDC_SCHEMA, "json"), silver, f"{ck}/cdc")
    if silver.versions_since_snapshot() > COMPACT_AFTER:
        silver.compact()
    tables = {"bronze": bronze, "silver": silver.as_of()}
    for name in gold if gold is not None else GOLD:
        kept = WindowTable(spark, f"{out}/gold/{name}", GOLD[name], silver, "event_timestamp")
        kept.refresh()
        shown = kept.read()
        tables[name] = windows.text_bounds(shown) if GOLD[name].slide else shown
    return tables
