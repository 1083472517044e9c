"""Inputs of the lessons, derived from the TPC-H-like test tables.

Trips come from order lines, flights and change events from events, zones and airports from
nations. Each function reads the whole table; the SQL twins repeat the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import canonical_pair
from tidemark.session import broadcast_if_small, spread
from tidemark.sources.readers import Tables

EVENT_YEAR = 2024


def trips(t: Tables) -> DataFrame:
    """Order lines as taxi trips: pickup zone is the customer's nation, drop-off the supplier's."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    pickups = orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    suppliers = broadcast_if_small(t.supplier.select("s_suppkey", "s_nationkey"))
    lines = t.lineitem.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    amount = F.col("l_quantity").cast("int")
    return lines.join(pickups, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        (F.col("l_quantity") - 5).alias("trip_distance"),
        (amount % 7).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        (amount % 5).alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        (F.col("l_tax") * 2).alias("tolls_amount"),
        (F.col("l_extendedprice") - 1000).alias("total_amount"),
        F.lit(1.25).alias("airport_fee"),
    )


TRIPS_SQL = """
trips AS (
  SELECT l_linenumber AS VendorID, o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
         l_quantity - 5 AS trip_distance, l_quantity::int % 7 AS RatecodeID,
         CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         c_nationkey AS PULocationID, s_nationkey AS DOLocationID, l_quantity::int % 5 AS payment_type,
         l_extendedprice AS fare_amount, l_tax AS mta_tax, l_discount AS tip_amount, l_tax * 2 AS tolls_amount,
         l_extendedprice - 1000 AS total_amount, 1.25::double AS airport_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey),
silver AS (
  SELECT * EXCLUDE (airport_fee),
         round((epoch(tpep_dropoff_datetime)::bigint - epoch(tpep_pickup_datetime)::bigint) / 60.0, 2)
           AS trip_duration_minutes,
         NULL::double AS airport_fee
  FROM trips WHERE trip_distance > 0 AND total_amount >= 0)"""


def zones(t: Tables) -> DataFrame:
    """Nations and their regions as the zone lookup."""
    regions = broadcast_if_small(t.region)
    return t.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone"), F.col("r_name").alias("Borough")
    )


ZONES_SQL = """
zones AS (
  SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def flights(t: Tables) -> DataFrame:
    """Events as raw flight rows: every column text, the date without its year."""
    k = F.from_json("props", "k int")["k"]
    return spread(t.events).select(
        F.date_format("ts", "MMddHHmm").alias("date"),
        (k - 20).cast("string").alias("delay"),
        (F.floor(F.col("value") * 10).cast("int") + 50).cast("string").alias("distance"),
        F.concat(F.lit("N"), F.col("user_id") % 26).alias("origin"),
        F.concat(F.lit("N"), F.col("event_id") % 25).alias("destination"),
        F.col("event_id").alias("flight_id"),
    )


def airports(t: Tables) -> DataFrame:
    """Nations as airports. Flights also use a code that is not among them."""
    return zones(t).select(
        F.concat(F.lit("N"), F.col("LocationID")).alias("airport_code"),
        F.col("Zone").alias("city"),
        F.col("Borough").alias("state"),
    )


FLIGHTS_SQL = """
flights AS (
  SELECT strftime(ts, '%m%d%H%M') AS date, json_extract_string(props, '$.k')::int - 20 AS delay,
         floor(value * 10)::int + 50 AS distance, 'N' || (user_id % 26) AS origin,
         'N' || (event_id % 25) AS destination, event_id AS flight_id, ts
  FROM events),
airports AS (
  SELECT 'N' || n_nationkey AS airport_code, n_name AS city, r_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey),
silver AS (
  SELECT f.flight_id, f.date, coalesce(o.city || ', ' || o.state, '') AS departure,
         coalesce(d.city || ', ' || d.state, '') AS arrival,
         least(origin, destination) || '-' || greatest(origin, destination) AS standardized_route,
         distance, delay,
         CASE WHEN delay < 0 THEN 'Early' WHEN delay < 10 THEN 'On Time' WHEN delay < 30 THEN 'Late' ELSE 'Delay' END
           AS take_off_status,
         date_trunc('minute', ts) AS event_timestamp, 3 AS seq
  FROM flights f LEFT JOIN airports o ON f.origin = o.airport_code
       LEFT JOIN airports d ON f.destination = d.airport_code)"""


def cdc_events(t: Tables) -> DataFrame:
    """Change events against those flights: a tenth deletes, a third of the rest to be ignored."""
    raw = flights(t)
    event = F.col("flight_id")
    payload = F.to_json(
        F.struct(
            "date",
            F.lit("from").alias("departure"),
            F.lit("to").alias("arrival"),
            canonical_pair("origin", "destination").alias("standardized_route"),
            (F.col("distance").cast("int") + 1).alias("distance"),
            (F.col("delay").cast("int") + 5).alias("delay"),
        )
    )
    action = F.when(event % 10 == 0, "DELETE").when(event % 3 == 0, "IGNORE").otherwise("UPDATE")
    return raw.select(
        F.concat(F.lit(f"{EVENT_YEAR}-"), "date").alias("update_ts"),
        action.alias("action"),
        (event % 6).cast("int").alias("seq"),
        payload.alias("payload"),
    )


CDC_SQL = """
cdc AS (
  SELECT * FROM (
    SELECT CASE WHEN flight_id % 10 = 0 THEN 'DELETE' WHEN flight_id % 3 = 0 THEN 'IGNORE' ELSE 'UPDATE' END AS action,
           (flight_id % 6)::int AS seq, date,
           least(origin, destination) || '-' || greatest(origin, destination) AS standardized_route,
           distance + 1 AS distance, delay + 5 AS delay
    FROM flights)
  QUALIFY row_number() OVER (PARTITION BY standardized_route, date
                             ORDER BY seq DESC, action, delay, distance) = 1),
merged AS (
  SELECT s.flight_id, s.date, s.departure, s.arrival, s.standardized_route,
         CASE WHEN c.action = 'UPDATE' THEN c.distance ELSE s.distance END AS distance,
         CASE WHEN c.action = 'UPDATE' THEN c.delay ELSE s.delay END AS delay,
         s.take_off_status, s.event_timestamp,
         CASE WHEN c.action = 'UPDATE' THEN c.seq ELSE s.seq END AS seq
  FROM silver s LEFT JOIN cdc c ON s.standardized_route = c.standardized_route AND s.date = c.date
  WHERE c.action IS NULL OR c.action <> 'DELETE')"""
