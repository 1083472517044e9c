"""Flight enrichment and change-data-capture merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import canonical_pair, cast_columns, parse_event_ts, route_status
from tidemark.operators.merge import MergePlan
from tidemark.operators.ordered import top_n_per_key
from tidemark.operators.relational import lookup_twice
from tidemark.operators.versions import VersionedTable

BASE_SEQ = 3  # Fixed value: sequence number of a row that no change event has touched.
ROUTE_KEY = ["standardized_route", "date"]
PAYLOAD = "date string, departure string, arrival string, standardized_route string, distance int, delay int"
CDC_SCHEMA = "update_ts string, action string, seq int, payload string"


def clean_flights(df: DataFrame, year: int | str) -> DataFrame:
    """Cast the text columns and build the event time from a date without year."""
    typed = cast_columns(df, {"delay": "int", "distance": "int", "origin": "string", "destination": "string"})
    return typed.withColumn("event_timestamp", parse_event_ts("date", year))


def enrich_flights(flights: DataFrame, airports: DataFrame, require_places: bool = False) -> DataFrame:
    """Add departure, arrival, take-off status, route key and sequence number.

    ``airports`` has ``airport_code, city, state``. A code it lacks gives an empty place text;
    ``require_places`` drops such flights.
    """
    places = lookup_twice(flights, airports, "airport_code", "origin", "destination", ("orig", "dest"))
    if require_places:
        places = places.filter(F.col("orig_airport_code").isNotNull() & F.col("dest_airport_code").isNotNull())
    return places.withColumns(
        {
            "departure": F.concat_ws(", ", "orig_city", "orig_state"),
            "arrival": F.concat_ws(", ", "dest_city", "dest_state"),
            "take_off_status": route_status("delay"),
            "standardized_route": canonical_pair("origin", "destination"),
            "seq": F.lit(BASE_SEQ),
        }
    ).drop(*[f"{p}_{c}" for p in ("orig", "dest") for c in airports.columns])


def parse_cdc(events: DataFrame) -> DataFrame:
    """``action, seq`` and the payload fields of change events."""
    return events.select(
        "action", F.col("seq").cast("int").alias("seq"), F.from_json("payload", PAYLOAD).alias("p")
    ).select("action", "seq", "p.*")


def latest_cdc(events: DataFrame) -> DataFrame:
    """Newest event per route and date. Equal ``seq``: DELETE first, then the smaller delay and
    distance, so that the outcome does not depend on row order."""
    order = [F.col("seq").desc(), F.col("action").asc(), F.col("delay").asc(), F.col("distance").asc()]
    return top_n_per_key(parse_cdc(events), ROUTE_KEY, order)


def cdc_clauses(plan: MergePlan, sequence_by: str | None = None) -> MergePlan:
    """UPDATE and DELETE events apply to matching rows; anything else is ignored.

    ``sequence_by`` also ignores events older than the row they meet.
    """
    newer = F.lit(True) if sequence_by is None else F.col(f"s.{sequence_by}") >= F.col(f"t.{sequence_by}")
    values = {c: F.col(f"s.{c}") for c in ("delay", "distance", "seq")}
    return plan.when_matched_update(values, (F.col("s.action") == "UPDATE") & newer).when_matched_delete(
        (F.col("s.action") == "DELETE") & newer
    )


def cdc_merge_batch(table: VersionedTable, stream_id: str, sequence_by: str | None = None):
    """A ``foreachBatch`` callback that merges change events; a replayed batch is skipped.

    ``stream_id`` names the stream across restarts (its checkpoint folder does).
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream_id}#{batch_id}"
        clauses = lambda plan: cdc_clauses(plan, sequence_by)
        table.merge(latest_cdc(batch), ROUTE_KEY, clauses, batch_tag=tag, source_is_unique=True)

    return merge


def load_batch(table: VersionedTable, stream_id: str):
    """A ``foreachBatch`` callback that appends rows to ``table``; a replayed batch is skipped."""

    def load(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream_id}#{batch_id}"
        if table.latest_version() < 0:
            table.create(batch, batch_tag=tag)
        else:
            table.append(batch, batch_tag=tag)

    return load


def drain(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every available micro-batch to ``each_batch``."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_cdc_stream(events: DataFrame, table: VersionedTable, checkpoint: str, sequence_by: str | None = None) -> DataFrame:
    """Apply every available change event and return the table as it then stands."""
    drain(events, cdc_merge_batch(table, checkpoint, sequence_by), checkpoint)
    return table.as_of()
