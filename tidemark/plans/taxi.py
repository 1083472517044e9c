"""Taxi trips from raw files to business tables, and the business questions themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import RATE_CODES, decode_map, duration_minutes, surrogate_key
from tidemark.operators.layout import cluster
from tidemark.operators.merge import merge_into
from tidemark.operators.relational import dedup_first, quality_filter, sample_n, share_pct
from tidemark.operators.versions import VersionedTable
from tidemark.session import broadcast_if_small
from tidemark.sources.writers import split_by_key, with_ingestion_ts, write_table

TRIP_KEY = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime"]
UPDATE_ROWS = 10_000  # Fixed value: how many trips the simulated payment update picks.
SILVER_LAYOUT = ["VendorID", "tpep_pickup_datetime"]
VENDORS = (1, 2, 4, 5, 6)  # Fixed values: vendor ids that get a table of their own.

# Result column per summed amount.
ROUTE_SUMS = {
    "total_fare_amount": "fare_amount",
    "total_airport_fee": "airport_fee",
    "total_tip_amount": "tip_amount",
    "total_amount_paid": "total_amount",
    "total_tolls_amount": "tolls_amount",
    "total_mta_tax": "mta_tax",
}


def quality_rules() -> dict[str, Column]:
    return {"distance": F.col("trip_distance") > 0, "amount": F.col("total_amount") >= 0}


def clean_trips(trips: DataFrame) -> DataFrame:
    kept, _ = quality_filter(trips, quality_rules())
    return kept.withColumns(
        {
            "trip_duration_minutes": duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"),
            "airport_fee": F.lit(None).cast("double"),
        }
    )


def payment_updates(silver: DataFrame, n: int = UPDATE_ROWS) -> DataFrame:
    """A repeatable pick of ``n`` trips with the next payment type, one row per trip key."""
    keyed = silver.select(*TRIP_KEY, "payment_type", surrogate_key(*sorted(silver.columns)).alias("_row"))
    picked = sample_n(keyed, n, "_row").withColumn("payment_type", F.col("payment_type") % 5 + 1)
    return dedup_first(picked, TRIP_KEY, [F.col("_row")]).select(*TRIP_KEY, "payment_type")


def apply_payment_updates(silver: DataFrame, updates: DataFrame) -> DataFrame:
    """``updates`` has one row per trip key, as ``payment_updates`` gives it."""
    plan = merge_into(silver, updates, TRIP_KEY, source_is_unique=True)
    return plan.when_matched_update({"payment_type": F.col("s.payment_type")}).to_df()


def with_driver_notes(silver: DataFrame) -> DataFrame:
    return silver.withColumn("driver_notes", decode_map("RatecodeID", RATE_CODES))


def zone_month_fares(trips: DataFrame) -> DataFrame:
    """Average fare and trip count per pickup zone and month."""
    return trips.groupBy("PULocationID", F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("month")).agg(
        F.avg("fare_amount").alias("Average_Fare_Amount"), F.count(F.lit(1)).alias("Total_Trip")
    )


def route_totals(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and summed amounts per pickup and drop-off zone.

    Trips are first summed per pair of zone ids, so the two name lookups meet a few rows per
    pair instead of every trip; the second sum joins ids that share a name.
    """
    per_ids = trips.groupBy("PULocationID", "DOLocationID").agg(
        F.count(F.lit(1)).alias("total_trips"), *[F.sum(c).alias(name) for name, c in ROUTE_SUMS.items()]
    )
    side = lambda p: broadcast_if_small(
        zones.select(
            F.col("LocationID").alias(f"_{p}"), F.col("Zone").alias(f"{p}_zone"), F.col("Borough").alias(f"{p}_borough")
        )
    )
    named = per_ids.join(side("pickup"), F.col("PULocationID") == F.col("_pickup")).join(
        side("dropoff"), F.col("DOLocationID") == F.col("_dropoff")
    )
    return named.groupBy("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough").agg(
        F.sum("total_trips").alias("total_trips"), *[F.round(F.sum(name), 3).alias(name) for name in ROUTE_SUMS]
    )


def vendor_share(trips: DataFrame) -> DataFrame:
    return share_pct(trips, "VendorID", "vendor_count", "vendor_percentage")


def tip_ratio(trips: DataFrame) -> DataFrame:
    return trips.agg(F.try_divide(F.sum("tip_amount"), F.sum("fare_amount")).alias("ratio"))


def vehicle_memory_pct(trips: DataFrame) -> DataFrame:
    stored = F.when(F.col("store_and_fwd_flag") == "Y", 1).otherwise(0)
    return trips.agg(F.round(F.avg(stored) * 100, 3).alias("vehicle_memory_pct"))


def run_taxi_pipeline(spark: SparkSession, loads: list[DataFrame], zones: DataFrame, out: str) -> dict[str, DataFrame]:
    """Bronze, silver and gold tables under ``out``.

    ``loads`` are the raw trip frames in load order; each is one version of the bronze table.
    """
    bronze = VersionedTable(spark, f"{out}/bronze/taxi_trips")
    first, *later = [with_ingestion_ts(df) for df in loads]
    bronze.create(first)
    for df in later:
        bronze.append(df)
    # Bronze is scanned again where cleaned trips are needed: silver itself is written once, in its final layout.
    clean = clean_trips(bronze.as_of())
    updates = write_table(payment_updates(clean.drop("ingestion_timestamp")), f"{out}/silver/payment_updates")
    merged = with_driver_notes(apply_payment_updates(clean, updates))
    silver = cluster(merged, SILVER_LAYOUT, f"{out}/silver/taxi_trips", like=bronze.as_of())
    vendors = split_by_key(silver, "VendorID", VENDORS, f"{out}/silver/by_vendor", rebalance=True)
    lookup = write_table(zones, f"{out}/bronze/taxi_zone_lookup")
    return {
        "bronze": bronze.as_of(),
        "silver": silver,
        "avg_fare": write_table(zone_month_fares(silver), f"{out}/gold/avg_fare"),
        "trip_aggregates_with_locations": cluster(
            route_totals(silver, lookup), ["pickup_zone"], f"{out}/gold/trip_aggregates_with_locations"
        ),
        "vendor_share": vendor_share(silver),
        **{f"nyc_yellowtaxi_{v}": df for v, df in vendors.items()},
    }
