"""The end-to-end jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.plans import derive
from tidemark.plans.documents import answer_questions, index_documents
from tidemark.plans.flights import LANDING_SCHEMA, run_flight_pipeline
from tidemark.plans.taxi import run_taxi_pipeline
from tidemark.queries.documents import CATEGORY_SQL, FALLBACK_SQL, FIXED_SQL, SLOT_SQL, category_of, reference_texts
from tidemark.queries.registry import query
from tidemark.queries.relational import ROUTE_TOTALS_SQL
from tidemark.queries.streams import plain_times
from tidemark.session import materialize, workspace
from tidemark.sources import Tables, write_csv
from tidemark.streaming import windows


@query("medallion_taxi", ROUTE_TOTALS_SQL)
def medallion_taxi(t: Tables) -> DataFrame:
    """Trips in two loads through bronze, silver and gold; the gold table of route totals."""
    trips = materialize(derive.trips(t), "raw-trips")
    first = F.col("VendorID") <= 3
    tables = run_taxi_pipeline(
        t.spark, [trips.filter(first), trips.filter(~first)], derive.zones(t), workspace(t.spark, "taxi")
    )
    return tables["trip_aggregates_with_locations"]


# A watermark follows the flights that were loaded, whether or not change events have deleted the latest since.
_CLOSED = "HAVING w + INTERVAL '{size}' <= (SELECT max(event_timestamp) - INTERVAL '{late}' FROM silver)"


@query(
    "medallion_flights",
    f"WITH {derive.FLIGHTS_SQL}, {derive.CDC_SQL} SELECT 'hourly' AS gold, w AS window_start, count(*) AS amount FROM "
    "(SELECT *, time_bucket(INTERVAL '1 hour', event_timestamp, TIMESTAMP '1970-01-01') AS w FROM merged) GROUP BY w "
    + _CLOSED.format(size="1 hour", late="1 hour")
    + " UNION ALL SELECT 'biweekly', w, sum(distance)::bigint FROM "
    "(SELECT *, time_bucket(INTERVAL '14 days', event_timestamp, TIMESTAMP '1970-01-01') AS w FROM merged) GROUP BY w "
    + _CLOSED.format(size="14 days", late="7 days"),
)
def medallion_flights(t: Tables) -> DataFrame:
    """Landing files through bronze, silver, change events and all gold tables; two of these."""
    tables = _flight_tables(t)
    pick = lambda name, gold, amount: tables[name].select(
        F.lit(gold).alias("gold"), "window_start", F.col(amount).alias("amount")
    )
    hourly = pick("hourly_tumbling_flights", "hourly", "flight_count")
    return plain_times(hourly.unionByName(pick("biweekly_distance", "biweekly", "total_distance")))


def _flight_tables(t: Tables) -> dict[str, DataFrame]:
    """All tables of the flight job."""
    landing = write_csv(derive.flights(t), workspace(t.spark, "landing"))
    cdc = workspace(t.spark, "cdc")
    derive.cdc_events(t).write.json(cdc)
    return run_flight_pipeline(
        t.spark,
        landing,
        derive.airports(t),
        cdc,
        workspace(t.spark, "flights"),
        derive.EVENT_YEAR,
        landing_schema=f"{LANDING_SCHEMA}, flight_id bigint",
    )


# Gold tables as rows of one: size, slide, windows per row and lateness, SQL and column of the key, column of the count,
# SQL and column of the amount.
_GOLD = {
    "monthly_delays": ("30 days", "30 days", 1, "7 days", None, None, "round(sum(delay) / (count(delay) * 60.0::double), 2)", "moving_avg_delay"),
    "biweekly_distance": ("14 days", "14 days", 1, "7 days", None, None, "sum(distance)", "total_distance"),
    "monthly_max_delay": (
        "30 days", "30 days", 1, "7 days", ("arg_min(standardized_route, (-delay, standardized_route))", "worst_route"), None,
        "round(max(delay) / 60.0::double, 2)", "max_delay",
    ),
    "hourly_tumbling_flights": ("1 hour", "1 hour", 1, "1 hour", None, "flight_count", None, None),
    "sliding_avg_delay": ("7 days", "1 day", 7, "8 days", None, None, "round(sum(delay) / (count(delay) * 60.0::double), 2)", "rolling_avg_delay_hours"),
    "sliding_route_traffic": (
        "14 days", "7 days", 2, "15 days", ("standardized_route", "standardized_route"), "flight_count", "sum(distance)", "total_distance",
    ),
    "sliding_hourly_status": ("3 hours", "1 hour", 3, "4 hours", ("take_off_status", "take_off_status"), "flight_count", None, None),
}


def _gold_sql(gold: str) -> str:
    size, slide, n, late, key, flights, amount, _ = _GOLD[gold]
    fmt = "'%Y-%m-%d %H:%M:%S'"
    by = f", {key[0]}" if key and key[0] == key[1] else ""
    return (
        f"SELECT '{gold}' AS gold, strftime(w, {fmt}) AS window_start, strftime(w + INTERVAL '{size}', {fmt}) AS window_end, "
        f"{key[0] if key else 'NULL::varchar'} AS key, {'count(*)' if flights else 'NULL::bigint'} AS flights, "
        f"({amount or 'NULL'})::double AS amount FROM (SELECT *, time_bucket(INTERVAL '{slide}', event_timestamp, "
        f"TIMESTAMP '1970-01-01') - i * INTERVAL '{slide}' AS w FROM merged, range({n}) r(i)) GROUP BY w{by} "
        + _CLOSED.format(size=size, late=late)
    )


@query("medallion_flights_gold", f"WITH {derive.FLIGHTS_SQL}, {derive.CDC_SQL} " + " UNION ALL ".join(map(_gold_sql, _GOLD)))
def medallion_flights_gold(t: Tables) -> DataFrame:
    """The same job; all seven gold tables, tagged."""
    tables = _flight_tables(t)

    def rows(gold: str) -> DataFrame:
        *_, key, flights, _, amount = _GOLD[gold]
        table = tables[gold] if gold.startswith("sliding") else windows.text_bounds(tables[gold])
        return table.select(
            F.lit(gold).alias("gold"),
            "window_start",
            "window_end",
            (F.col(key[1]) if key else F.lit(None).cast("string")).alias("key"),
            (F.col(flights) if flights else F.lit(None).cast("bigint")).alias("flights"),
            (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"),
        )

    return reduce(DataFrame.unionByName, map(rows, _GOLD))


def _slots_sql(name: str, table: str, key: str, text: str) -> str:
    """Hashed term counts of a text column, and their norms."""
    return (
        f"{name} AS (SELECT {key}, {SLOT_SQL} AS slot, count(*) AS n FROM (SELECT {key}, unnest(string_split(replace("
        f"lower({text}), chr(10), ' '), ' ')) AS w FROM {table}) WHERE w <> '' GROUP BY 1, 2), "
        f"{name}_norm AS (SELECT {key}, sqrt(sum(n * n)) AS norm FROM {name} GROUP BY 1)"
    )


_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))"


@query(
    "rag_documents",
    f"WITH chunks AS (SELECT {{'d': doc_id, 'i': chunk_index}} AS vec_id, chunk_text FROM ({FIXED_SQL})), "
    + _slots_sql("c", "chunks", "vec_id", "chunk_text")
    + ", "
    + _slots_sql("q", "benchmark", "item_id", "text")
    + ", scored AS (SELECT item_id, vec_id, round(sum(c.n * q.n) / (any_value(q_norm.norm) * any_value(c_norm.norm) + 1e-10), 12) "
    "AS s FROM c JOIN q USING (slot) JOIN c_norm USING (vec_id) JOIN q_norm USING (item_id) GROUP BY 1, 2), "
    "hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, vec_id) AS rank FROM scored QUALIFY rank <= 3), "
    "ctx AS (SELECT item_id, string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits JOIN chunks USING (vec_id) GROUP BY 1), "
    "graded AS (SELECT item_id, b.text AS question, context, CASE WHEN len(list_intersect("
    + f"{_WORDS.format('b.text')}, {_WORDS.format('context')}))::double / len({_WORDS.format('b.text')}) >= 0.5 "
    + "THEN 'yes' ELSE 'no' END AS grade FROM benchmark b JOIN ctx USING (item_id)) "
    "SELECT item_id AS query_id, 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || question AS prompt, "
    "grade, CASE WHEN grade = 'yes' THEN 'end' ELSE 'fallback' END AS route, "
    f"CASE WHEN grade = 'yes' THEN context ELSE {FALLBACK_SQL} END AS answer FROM (SELECT *, {CATEGORY_SQL} AS cat FROM graded)",
)
def rag_documents(t: Tables) -> DataFrame:
    """The benchmark passages as questions to the indexed documents."""
    questions = t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    index = materialize(index_documents(t.documents, "doc_id", "text"), "index")
    return answer_questions(index, questions, reference_texts(t), category_of("question"))
