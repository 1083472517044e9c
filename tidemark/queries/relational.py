"""Joins, sets, aggregation, windows and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import rank_within
from tidemark.operators.relational import (
    best_match,
    dedup_first,
    describe,
    filtered_totals,
    latest_per_key,
    lookup_twice,
    partition_counts,
    repartition_by_key,
    share_pct,
    unmatched,
)
from tidemark.plans import derive, taxi
from tidemark.queries.registry import query
from tidemark.session import broadcast_if_small, materialize, workspace
from tidemark.sources import Tables, compare_counts, with_cached_view, write_table

_TRIPS = f"WITH {derive.TRIPS_SQL} "
_TRIPS_ZONES = f"WITH {derive.TRIPS_SQL}, {derive.ZONES_SQL} "
_FLIGHTS = f"WITH {derive.FLIGHTS_SQL} "


def _by_year(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders, and their lines, each with the year of its own date: an order has partners only among the lines that were
    shipped in its year, so at any size both sides have rows without one."""
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"), F.year("o_orderdate").alias("year"), "o_totalprice")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_key"), F.year("l_shipdate").alias("year"), "l_linenumber", "l_suppkey", "l_extendedprice"
    )
    return orders, lines


_BY_YEAR = """WITH o AS (SELECT o_orderkey AS order_key, year(o_orderdate)::int AS year, o_totalprice FROM orders),
l AS (SELECT l_orderkey AS order_key, year(l_shipdate)::int AS year, l_linenumber, l_suppkey, l_extendedprice FROM lineitem) """


@query("join_inner_multi", _BY_YEAR + "SELECT * FROM o JOIN l USING (order_key, year)")
def join_inner_multi(t: Tables) -> DataFrame:
    orders, lines = _by_year(t)
    return orders.join(lines, ["order_key", "year"], "inner")


@query("join_left", _BY_YEAR + "SELECT * FROM o LEFT JOIN l USING (order_key, year)")
def join_left(t: Tables) -> DataFrame:
    orders, lines = _by_year(t)
    return orders.join(lines, ["order_key", "year"], "left")


@query("join_right", _BY_YEAR + "SELECT * FROM o RIGHT JOIN l USING (order_key, year)")
def join_right(t: Tables) -> DataFrame:
    orders, lines = _by_year(t)
    return orders.join(lines, ["order_key", "year"], "right")


@query("join_full", _BY_YEAR + "SELECT * FROM o FULL JOIN l USING (order_key, year)")
def join_full(t: Tables) -> DataFrame:
    orders, lines = _by_year(t)
    return orders.join(lines, ["order_key", "year"], "outer")


@query(
    "join_semi",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def join_semi(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(urgent.distinct(), "c_custkey", "leftsemi")


@query(
    "join_anti",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def join_anti(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(urgent.distinct(), "c_custkey", "leftanti")


def _sales(t: Tables) -> DataFrame:
    """Order lines as sales, some of products that are not in the part table."""
    return t.lineitem.select(
        (F.col("l_partkey") + 100).alias("product_id"), F.col("l_orderkey").alias("sale_id"), "l_linenumber"
    )


@query(
    "full_join_unmatched",
    "SELECT product_id, p_name AS product_name, sale_id, l_linenumber FROM (SELECT p_partkey AS product_id, p_name FROM part) p "
    "FULL JOIN (SELECT l_partkey + 100 AS product_id, l_orderkey AS sale_id, l_linenumber FROM lineitem) s USING (product_id) "
    "WHERE p_name IS NULL OR sale_id IS NULL",
)
def full_join_unmatched(t: Tables) -> DataFrame:
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    return unmatched(products, _sales(t), "product_id")


@query(
    "join_then_agg",
    "SELECT p_brand, sum(l_quantity) AS total_items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand ORDER BY total_items",
)
def join_then_agg(t: Tables) -> DataFrame:
    """Quantities are summed per part before the join, so a best-seller does not skew it."""
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    parts = t.part.select("p_partkey", "p_brand")
    per_brand = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
    return per_brand.agg(F.sum("q").alias("total_items")).orderBy("total_items")


@query(
    "join_dim_twice",
    _TRIPS_ZONES + "SELECT tpep_pickup_datetime, fare_amount, p.Zone AS pickup_zone, p.Borough AS pickup_borough, "
    "d.Zone AS dropoff_zone, d.Borough AS dropoff_borough FROM trips "
    "JOIN zones p ON PULocationID = p.LocationID JOIN zones d ON DOLocationID = d.LocationID",
)
def join_dim_twice(t: Tables) -> DataFrame:
    zones = broadcast_if_small(derive.zones(t))
    pickup, dropoff = zones.alias("pickup"), zones.alias("dropoff")
    trips = derive.trips(t).select("tpep_pickup_datetime", "fare_amount", "PULocationID", "DOLocationID")
    return (
        trips.join(pickup, F.col("PULocationID") == F.col("pickup.LocationID"))
        .join(dropoff, F.col("DOLocationID") == F.col("dropoff.LocationID"))
        .select(
            "tpep_pickup_datetime",
            "fare_amount",
            F.col("pickup.Zone").alias("pickup_zone"),
            F.col("pickup.Borough").alias("pickup_borough"),
            F.col("dropoff.Zone").alias("dropoff_zone"),
            F.col("dropoff.Borough").alias("dropoff_borough"),
        )
    )


@query(
    "join_broadcast_lookup",
    _FLIGHTS + "SELECT flight_id, origin, destination, o.city AS orig_city, o.state AS orig_state, "
    "d.city AS dest_city, d.state AS dest_state FROM flights LEFT JOIN airports o ON origin = o.airport_code "
    "LEFT JOIN airports d ON destination = d.airport_code",
)
def join_broadcast_lookup(t: Tables) -> DataFrame:
    flights = derive.flights(t).select("flight_id", "origin", "destination")
    found = lookup_twice(flights, derive.airports(t), "airport_code", "origin", "destination", ("orig", "dest"))
    return found.drop("orig_airport_code", "dest_airport_code")


@query(
    "join_cross_scalar",
    "SELECT l_linenumber AS vendor, count(*) AS vendor_count, count(*) / t.total::double AS vendor_fraction "
    "FROM lineitem CROSS JOIN (SELECT count(*) AS total FROM lineitem) t GROUP BY l_linenumber, t.total",
)
def join_cross_scalar(t: Tables) -> DataFrame:
    """The one-row total is a scalar subquery over the stored counts: one scan of the lines, and no cross join to plan."""
    counts = t.lineitem.groupBy(F.col("l_linenumber").alias("vendor")).agg(F.count(F.lit(1)).alias("vendor_count"))
    counts = materialize(counts, "vendor-counts")
    total = counts.agg(F.sum("vendor_count").alias("total")).scalar()
    return counts.withColumn("vendor_fraction", F.col("vendor_count") / total)


@query(
    "join_star_top1",
    "SELECT s_suppkey, s_name, n_name, sum(l_quantity) AS popularity FROM lineitem JOIN part ON l_partkey = p_partkey "
    "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE starts_with(p_name, 's') "
    "GROUP BY ALL ORDER BY popularity DESC, s_suppkey LIMIT 1",
)
def join_star_top1(t: Tables) -> DataFrame:
    named = t.part.filter(F.startswith("p_name", F.lit("s"))).select("p_partkey")
    sold = t.lineitem.join(broadcast_if_small(named), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    per_supplier = sold.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("popularity"))
    best = per_supplier.orderBy(F.col("popularity").desc(), "l_suppkey").limit(1)
    return (
        t.supplier.join(F.broadcast(best), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(broadcast_if_small(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "n_name", "popularity")
    )


@query(
    "union_positional",
    "SELECT c_custkey AS party_key, c_name AS party_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_positional(t: Tables) -> DataFrame:
    left = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"))
    return left.union(t.supplier.select("s_suppkey", "s_name"))


@query(
    "union_by_name_missing",
    "SELECT c_custkey AS party_key, c_name AS name, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
)
def union_by_name_missing(t: Tables) -> DataFrame:
    left = t.customer.select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    right = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("party_key"))
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "union_all_counts",
    "SELECT 'orders' AS source, count(*) AS row_count FROM orders UNION ALL SELECT 'events', count(*) FROM events",
)
def union_all_counts(t: Tables) -> DataFrame:
    return compare_counts({"orders": t.orders, "events": t.events})


_1996 = "o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01'"
_1997 = "o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-01'"


def _buyers(t: Tables, year: int) -> DataFrame:
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    in_year = (F.col("o_orderdate") >= low) & (F.col("o_orderdate") < high)
    return t.orders.filter(in_year).select("o_custkey", "o_orderpriority")


@query(
    "intersect_rows",
    f"SELECT o_custkey, o_orderpriority FROM orders WHERE {_1996} INTERSECT SELECT o_custkey, o_orderpriority FROM orders WHERE {_1997}",
)
def intersect_rows(t: Tables) -> DataFrame:
    return _buyers(t, 1996).intersect(_buyers(t, 1997))


@query(
    "except_rows",
    f"SELECT o_custkey, o_orderpriority FROM orders WHERE {_1996} EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE {_1997}",
)
def except_rows(t: Tables) -> DataFrame:
    return _buyers(t, 1996).subtract(_buyers(t, 1997))


@query("distinct_vals", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_vals(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()


@query(
    "drop_duplicates_keys",
    "SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1",
)
def drop_duplicates_keys(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    first = dedup_first(t.orders, ["o_custkey", "o_orderpriority"], order)
    return first.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query(
    "agg_group_multi",
    "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_price, count(*) AS n_orders FROM orders GROUP BY 1",
)
def agg_group_multi(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.round(F.avg("o_totalprice"), 4).alias("avg_price"), F.count("*").alias("n_orders")
    )


@query(
    "agg_having",
    "SELECT p_brand, round(avg(p_retailprice), 4) AS avg_price FROM part GROUP BY 1 HAVING avg(p_retailprice) > 950",
)
def agg_having(t: Tables) -> DataFrame:
    means = t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("m")).filter(F.col("m") > 950)
    return means.select("p_brand", F.round("m", 4).alias("avg_price"))


@query(
    "agg_count_rows",
    "SELECT count(*) AS n_rows, count(nullif(l_returnflag, 'R')) AS n_kept, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem",
)
def agg_count_rows(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count("*").alias("n_rows"),
        F.count(F.nullif("l_returnflag", F.lit("R"))).alias("n_kept"),
        F.count_distinct("l_suppkey").alias("n_suppliers"),
    )


@query("agg_month_count", "SELECT month(o_orderdate)::int AS month, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1")
def agg_month_count(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n")).orderBy("month")


@query(
    "agg_zone_month",
    _TRIPS + "SELECT PULocationID, strftime(tpep_pickup_datetime, '%Y-%m') AS month, "
    "round(sum(fare_amount), 2) / count(*) AS Average_Fare_Amount, count(*) AS Total_Trip FROM silver GROUP BY 1, 2",
)
def agg_zone_month(t: Tables) -> DataFrame:
    """Money has two decimals: the mean is put back to whole cents over the count, so that the
    order of the additions does not show."""
    fares = taxi.zone_month_fares(taxi.clean_trips(derive.trips(t)))
    cents = F.round(F.col("Average_Fare_Amount") * F.col("Total_Trip"), 2)
    return fares.withColumn("Average_Fare_Amount", cents / F.col("Total_Trip"))


ROUTE_TOTALS_SQL = (
    _TRIPS_ZONES + "SELECT p.Zone AS pickup_zone, p.Borough AS pickup_borough, d.Zone AS dropoff_zone, "
    "d.Borough AS dropoff_borough, count(*) AS total_trips, round(sum(fare_amount), 3) AS total_fare_amount, "
    "round(sum(airport_fee), 3) AS total_airport_fee, round(sum(tip_amount), 3) AS total_tip_amount, "
    "round(sum(total_amount), 3) AS total_amount_paid, round(sum(tolls_amount), 3) AS total_tolls_amount, "
    "round(sum(mta_tax), 3) AS total_mta_tax FROM silver JOIN zones p ON PULocationID = p.LocationID "
    "JOIN zones d ON DOLocationID = d.LocationID GROUP BY 1, 2, 3, 4"
)


@query("agg_route_totals", ROUTE_TOTALS_SQL)
def agg_route_totals(t: Tables) -> DataFrame:
    return taxi.route_totals(taxi.clean_trips(derive.trips(t)), derive.zones(t))


@query(
    "agg_share_pct",
    "SELECT l_linenumber AS VendorID, count(*) AS vendor_count, "
    "count(*) * 100.0::double / (SELECT count(*) FROM lineitem) AS vendor_percentage FROM lineitem GROUP BY 1",
)
def agg_share_pct(t: Tables) -> DataFrame:
    vendors = t.lineitem.select(F.col("l_linenumber").alias("VendorID"))
    return share_pct(vendors, "VendorID", "vendor_count", "vendor_percentage")


@query("agg_ratio_sums", _TRIPS + "SELECT round(sum(tip_amount) / sum(fare_amount), 12) AS ratio FROM silver")
def agg_ratio_sums(t: Tables) -> DataFrame:
    return taxi.tip_ratio(taxi.clean_trips(derive.trips(t))).select(F.round("ratio", 12).alias("ratio"))


@query(
    "agg_flag_pct",
    _TRIPS + "SELECT round(avg(CASE WHEN store_and_fwd_flag = 'Y' THEN 1 ELSE 0 END) * 100, 3) AS vehicle_memory_pct FROM silver",
)
def agg_flag_pct(t: Tables) -> DataFrame:
    return taxi.vehicle_memory_pct(taxi.clean_trips(derive.trips(t)))


@query(
    "filtered_totals",
    "SELECT sum(l_quantity) AS total_duration, round(sum(l_extendedprice), 2) AS total_cost "
    "FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO'",
)
def totals_of_category(t: Tables) -> DataFrame:
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("e"))
    joined = per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    sums = {"total_duration": F.col("q"), "total_cost": F.col("e")}
    totals = filtered_totals(joined, F.col("p_type") == "PROMO", sums)
    return totals.select("total_duration", F.round("total_cost", 2).alias("total_cost"))


@query(
    "agg_max_by",
    _FLIGHTS + "SELECT origin, max(delay) / 60.0::double AS max_delay, "
    "min(destination) FILTER (delay = top) AS worst_destination "
    "FROM (SELECT *, max(delay) OVER (PARTITION BY origin) AS top FROM flights) GROUP BY origin",
)
def agg_max_by(t: Tables) -> DataFrame:
    """Largest delay per origin and its destination; equal delays go to the first destination by name."""
    delay = F.col("delay").cast("int")
    worst = F.min_by("destination", F.struct(-delay, F.col("destination")))
    return derive.flights(t).groupBy("origin").agg(
        (F.max(delay) / 60).alias("max_delay"), worst.alias("worst_destination")
    )


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "agg_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS stddev, "
        f"min({c}) AS min, max({c}) AS max FROM lineitem"
        for c in _DESCRIBED
    ),
)
def agg_describe(t: Tables) -> DataFrame:
    stats = describe(t.lineitem, _DESCRIBED)
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(
    "partition_row_counts",
    "SELECT p AS partition_number, (SELECT count(*) FROM orders WHERE 1 + (o_orderkey > 2500)::int + "
    "(o_orderkey > 5000)::int + (o_orderkey > 1000000000000)::int = p) AS n_rows, 'FG' || p AS storage_group "
    "FROM (VALUES (1), (2), (3), (4)) v(p)",
)
def partition_row_counts(t: Tables) -> DataFrame:
    return partition_counts(t.orders, "o_orderkey", [2500, 5000, 10**12], ["FG1", "FG2", "FG3", "FG4"])


@query(
    "win_row_number",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus "
    "ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders",
)
def win_row_number(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rank_within(orders, ["o_orderstatus"], "o_totalprice", "o_orderkey", descending=True)


@query(
    "win_latest_per_key",
    "SELECT user_id, event_type, event_id, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def win_latest_per_key(t: Tables) -> DataFrame:
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest_per_key(t.events, ["user_id", "event_type"], order).select("user_id", "event_type", "event_id", "value")


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("sort_by_hidden_col", "SELECT p_name, p_brand FROM part WHERE p_retailprice >= 905 ORDER BY p_retailprice DESC, p_partkey")
def sort_by_hidden_col(t: Tables) -> DataFrame:
    pricey = t.part.filter(F.col("p_retailprice") >= 905)
    return pricey.select("p_name", "p_brand").orderBy(F.col("p_retailprice").desc(), F.col("p_partkey"))


@query(
    "top_k",
    "SELECT l_suppkey, count(*) AS num_pickups FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def top_k(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("num_pickups"))
    return counts.orderBy(F.desc("num_pickups"), "l_suppkey").limit(10)


@query("limit_n", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10")
def limit_n(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type").orderBy("event_id").limit(10)


@query(
    "rank_multi_criteria",
    "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size = 20 "
    "ORDER BY p_retailprice, p_brand DESC, p_partkey LIMIT 3",
)
def rank_multi_criteria(t: Tables) -> DataFrame:
    best = best_match(t.part, {"p_size": 20}, ["p_retailprice"], ["p_brand"], "p_partkey", 3)
    return best.select("p_partkey", "p_name", "p_size", "p_retailprice")


@query("repartition_by_key", "SELECT event_id, user_id, value FROM events")
def repartitioned_events(t: Tables) -> DataFrame:
    return repartition_by_key(t.events.select("event_id", "user_id", "value"), ["user_id"], salts=4)


@query(
    "cache_table",
    "SELECT event_type, count(*) AS n_events, max(value) AS top_value FROM events GROUP BY event_type",
)
def cache_table(t: Tables) -> DataFrame:
    path = workspace(t.spark, "cached")
    with with_cached_view(t.events.select("event_type", "value"), f"cached_{path[-8:]}") as cached:
        return write_table(
            cached.groupBy("event_type").agg(F.count("*").alias("n_events"), F.max("value").alias("top_value")), path
        )
