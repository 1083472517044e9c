"""Merge, update, delete, versions, change feeds and file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.layout import cluster, compact
from tidemark.operators.merge import CHANGE_TYPE, delete, insert_values, merge_into, snapshot_diff, update
from tidemark.operators.relational import dedup_first, sample_n
from tidemark.operators.versions import VersionedTable, sync_index
from tidemark.plans import derive
from tidemark.queries.registry import query
from tidemark.session import workspace
from tidemark.sources import Tables, write_table
from tidemark.streaming.flights import cdc_clauses, clean_flights, enrich_flights, latest_cdc

_FLIGHTS = f"WITH {derive.FLIGHTS_SQL}, {derive.CDC_SQL} "


@query(
    "merge_insert_only",
    "SELECT c_custkey AS party_key, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'new ' || c_name END AS name FROM customer",
)
def merge_insert_only(t: Tables) -> DataFrame:
    target = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"))
    source = t.customer.select(
        F.col("c_custkey").alias("party_key"), F.concat(F.lit("new "), "c_name").alias("name")
    )
    return merge_into(target, source, "party_key").when_not_matched_insert().to_df()


def _new_prices(t: Tables) -> DataFrame:
    """A new price per product sold, some of products that are not in the part table."""
    return t.lineitem.groupBy((F.col("l_partkey") + 50).alias("product_id")).agg(
        F.max("l_extendedprice").alias("new_price")
    )


@query(
    "merge_upsert",
    "SELECT coalesce(p_partkey, product_id) AS product_id, CASE WHEN p_partkey IS NULL THEN 'New Item' ELSE p_name END AS product_name, "
    "CASE WHEN p_partkey IS NULL THEN 'Misc' ELSE p_type END AS category, coalesce(new_price, p_retailprice) AS price "
    "FROM part FULL JOIN (SELECT l_partkey + 50 AS product_id, max(l_extendedprice) AS new_price FROM lineitem GROUP BY 1) "
    "ON p_partkey = product_id",
)
def merge_upsert(t: Tables) -> DataFrame:
    target = t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )
    plan = merge_into(target, _new_prices(t), "product_id").when_matched_update({"price": F.col("s.new_price")})
    fill = {
        "product_id": F.col("s.product_id"),
        "product_name": F.lit("New Item"),
        "category": F.lit("Misc"),
        "price": F.col("s.new_price"),
    }
    return plan.when_not_matched_insert(fill).to_df()


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_shipdate"]


@query(
    "merge_update_only",
    "WITH picked AS (SELECT * FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, "
    "md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity || '-' || "
    "strftime(l_shipdate, '%Y%m%d')) AS k FROM lineitem ORDER BY md5(k), k, l_partkey LIMIT 10000)), "
    "src AS (SELECT * FROM picked QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate ORDER BY k) = 1) "
    "SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_suppkey, "
    "CASE WHEN s.k IS NULL THEN l.l_linenumber ELSE s.l_linenumber % 5 + 1 END AS payment_type "
    "FROM lineitem l LEFT JOIN src s USING (l_orderkey, l_linenumber, l_shipdate)",
)
def merge_update_only(t: Tables) -> DataFrame:
    """A sample of the lines gets another payment type, matched on three columns."""
    lines = t.lineitem.select(*_LINE_KEY, "l_suppkey", F.col("l_linenumber").alias("payment_type"))
    key = F.md5(
        F.concat_ws(
            "-",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("string"),
            F.date_format("l_shipdate", "yyyyMMdd"),
        )
    )
    keyed = t.lineitem.select(*_LINE_KEY, key.alias("k"))
    picked = sample_n(keyed, 10_000, "k")
    source = dedup_first(picked, _LINE_KEY, [F.col("k")]).select(
        *_LINE_KEY, (F.col("l_linenumber") % 5 + 1).alias("payment_type")
    )
    plan = merge_into(lines, source, _LINE_KEY, source_is_unique=True)
    return plan.when_matched_update({"payment_type": F.col("s.payment_type")}).to_df()


_SILVER = ["flight_id", "date", "departure", "arrival", "standardized_route", "distance", "delay", "take_off_status", "seq"]


def silver_flights(t: Tables) -> DataFrame:
    return enrich_flights(clean_flights(derive.flights(t), derive.EVENT_YEAR), derive.airports(t))


@query("merge_cdc", _FLIGHTS + f"SELECT {', '.join(_SILVER)} FROM merged")
def merge_cdc(t: Tables) -> DataFrame:
    silver = silver_flights(t).select(*_SILVER)
    plan = merge_into(silver, latest_cdc(derive.cdc_events(t)), ["standardized_route", "date"], source_is_unique=True)
    return cdc_clauses(plan).to_df()


@query(
    "update_where",
    "SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN s_acctbal + 100 ELSE s_acctbal END AS s_acctbal, "
    "CASE WHEN s_acctbal < 0 THEN 0 ELSE s_nationkey END AS s_nationkey FROM supplier",
)
def update_where(t: Tables) -> DataFrame:
    changes = {"s_acctbal": F.col("s_acctbal") + 100, "s_nationkey": F.lit(0)}
    return update(t.supplier, F.col("s_acctbal") < 0, changes)


@query(
    "delete_where",
    "SELECT event_id, kind FROM (SELECT event_id, nullif(event_type, 'view') AS kind FROM events) "
    "WHERE NOT coalesce(kind = 'error', false)",
)
def delete_where(t: Tables) -> DataFrame:
    events = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return delete(events, F.col("kind") == "error")


@query(
    "insert_values",
    "SELECT n_nationkey, n_name, n_regionkey, c.n AS customers FROM (SELECT * FROM nation UNION ALL "
    "VALUES (100, 'NATION_100', 1), (101, 'NATION_101', 2)) LEFT JOIN "
    "(SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey",
)
def insert_rows(t: Tables) -> DataFrame:
    nations = insert_values(t.nation, [(100, "NATION_100", 1), (101, "NATION_101", 2)])
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return nations.join(counts, "n_nationkey", "left")


def _accounts(t: Tables) -> VersionedTable:
    """Customer accounts through six versions: load, update, delete, append, compaction, merge."""
    table = VersionedTable(t.spark, workspace(t.spark, "accounts"), key="id")
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    table.create(customers)
    table.update(F.col("balance") < 0, {"segment": F.lit("BLOCKED")})
    table.delete(F.col("segment") == "MACHINERY")
    suppliers = t.supplier.select(
        (-F.col("s_suppkey") - 1).alias("id"), F.lit("SUPPLIER").alias("segment"), F.col("s_acctbal").alias("balance")
    )
    table.append(suppliers)
    return table


def _accounts_merged(t: Tables) -> VersionedTable:
    """... then the order totals of every customer, which re-adds the deleted ones."""
    table = _accounts(t)
    table.compact()
    spent = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("top"))
    fresh = {"id": F.col("s.id"), "segment": F.lit("BACK"), "balance": F.col("s.top")}
    table.merge(
        spent,
        "id",
        lambda plan: plan.when_matched_delete(F.col("t.segment") == "BLOCKED")
        .when_matched_update({"balance": F.col("s.top")})
        .when_not_matched_insert(fresh),
    )
    return table


_ACCOUNTS = """WITH v0 AS (SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance FROM customer),
v1 AS (SELECT id, CASE WHEN balance < 0 THEN 'BLOCKED' ELSE segment END AS segment, balance FROM v0),
v2 AS (SELECT * FROM v1 WHERE segment <> 'MACHINERY'),
v3 AS (SELECT * FROM v2 UNION ALL SELECT -s_suppkey - 1, 'SUPPLIER', s_acctbal FROM supplier),
spent AS (SELECT o_custkey AS id, max(o_totalprice) AS top FROM orders GROUP BY 1),
v5 AS (SELECT coalesce(v3.id, spent.id) AS id, CASE WHEN v3.id IS NULL THEN 'BACK' ELSE segment END AS segment,
              coalesce(top, balance) AS balance
       FROM v3 FULL JOIN spent USING (id) WHERE v3.id IS NULL OR spent.id IS NULL OR segment <> 'BLOCKED') """


@query(
    "snapshot_as_of",
    _ACCOUNTS + "SELECT 0 AS version, * FROM v0 UNION ALL SELECT 1, * FROM v1 UNION ALL SELECT 2, * FROM v2 "
    "UNION ALL SELECT 3, * FROM v3 UNION ALL SELECT 5, * FROM v5",
)
def snapshot_as_of(t: Tables) -> DataFrame:
    table = _accounts_merged(t)
    out = None
    for version in (0, 1, 2, 3, 5):
        df = table.as_of(version).select(F.lit(version).alias("version"), "id", "segment", "balance")
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "table_history",
    _ACCOUNTS + """SELECT 0 AS version, 'WRITE' AS operation, true AS snapshot, (SELECT count(*) FROM v0) AS inserted,
0::bigint AS updated, 0::bigint AS deleted
UNION ALL SELECT 1, 'UPDATE', false, 0, (SELECT count(*) FROM v0 WHERE balance < 0), 0
UNION ALL SELECT 2, 'DELETE', false, 0, 0, (SELECT count(*) FROM v1 WHERE segment = 'MACHINERY')
UNION ALL SELECT 3, 'APPEND', false, (SELECT count(*) FROM supplier), 0, 0
UNION ALL SELECT 4, 'OPTIMIZE', true, 0, 0, 0
UNION ALL SELECT 5, 'MERGE', false, (SELECT count(*) FROM v5 WHERE segment = 'BACK'),
  (SELECT count(*) FROM v3 JOIN spent USING (id) WHERE segment <> 'BLOCKED'),
  (SELECT count(*) FROM v3 JOIN spent USING (id) WHERE segment = 'BLOCKED')""",
)
def table_history(t: Tables) -> DataFrame:
    log = _accounts_merged(t).history()
    return log.select("version", "operation", "snapshot", "inserted", "updated", "deleted")


@query(
    "schema_evolve_write",
    "SELECT s_suppkey AS id, s_name AS name, NULL AS notes FROM supplier UNION ALL "
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def schema_evolve_write(t: Tables) -> DataFrame:
    table = VersionedTable(t.spark, workspace(t.spark, "evolve"))
    table.create(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
    extra = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("notes")
    )
    table.append(extra, evolve=True)
    return table.as_of()


_FEED = _ACCOUNTS + """, feed AS (
SELECT id, segment, balance, 'insert' AS _change_type, 0 AS _version FROM v0
UNION ALL SELECT id, segment, balance, 'update_preimage', 1 FROM v0 WHERE balance < 0
UNION ALL SELECT id, segment, balance, 'update_postimage', 1 FROM v1 WHERE balance < 0
UNION ALL SELECT id, segment, balance, 'delete', 2 FROM v1 WHERE segment = 'MACHINERY'
UNION ALL SELECT id, segment, balance, 'insert', 3 FROM v3 WHERE segment = 'SUPPLIER') """


@query("change_feed", _FEED + "SELECT * FROM feed")
def change_feed(t: Tables) -> DataFrame:
    return _accounts(t).change_feed().drop("_commit_timestamp")


@query("change_feed_filter", _FEED + "SELECT * FROM feed WHERE _change_type IN ('update_postimage', 'insert')")
def change_feed_filter(t: Tables) -> DataFrame:
    feed = _accounts(t).change_feed()
    return feed.filter(F.col(CHANGE_TYPE).isin("update_postimage", "insert")).drop("_commit_timestamp")


@query(
    "change_feed_diff",
    "SELECT 'update_preimage' AS _change_type, c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_acctbal < 0 "
    "UNION ALL SELECT 'update_postimage', c_custkey, 0 FROM customer WHERE c_acctbal < 0 "
    "UNION ALL SELECT 'delete', c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING' "
    "UNION ALL SELECT 'insert', -s_suppkey - 1, s_acctbal FROM supplier",
)
def change_feed_diff(t: Tables) -> DataFrame:
    """The feed between two plain snapshots that kept no log."""
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    kept = t.customer.filter((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") != "BUILDING")).select(
        F.col("c_custkey").alias("id"), F.greatest("c_acctbal", F.lit(0.0)).alias("balance")
    )
    added = t.supplier.select((-F.col("s_suppkey") - 1).alias("id"), F.col("s_acctbal").alias("balance"))
    return snapshot_diff(old, kept.unionByName(added), "id")


@query(
    "compact_files",
    "SELECT 'before' AS state, true AS many_files, (SELECT count(*) FROM orders) AS n_rows UNION ALL "
    "SELECT 'after', false, (SELECT count(*) FROM orders)",
)
def compact_files(t: Tables) -> DataFrame:
    """Orders in many small files, then compacted; every row is still there."""
    scattered, compacted = workspace(t.spark, "scattered"), workspace(t.spark, "compacted")
    t.orders.write.partitionBy("o_orderpriority").option("maxRecordsPerFile", 100_000).parquet(scattered)
    report = compact(t.spark, scattered, compacted)
    rows = {"before": scattered, "after": compacted}
    counts = [
        t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(state).alias("state"), "n_rows")
        for state, path in rows.items()
    ]
    return report.join(counts[0].unionByName(counts[1]), "state").select(
        "state", (F.col("num_files") > 1).alias("many_files"), "n_rows"
    )


@query(
    "cluster_by_cols",
    "SELECT l_suppkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS total FROM lineitem "
    "WHERE l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01' GROUP BY 1",
)
def cluster_by_cols(t: Tables) -> DataFrame:
    """Lines laid out by shipping date and supplier, then one year's totals per supplier."""
    lines = t.lineitem.select("l_suppkey", "l_shipdate", "l_extendedprice")
    laid_out = cluster(lines, ["l_shipdate", "l_suppkey"], workspace(t.spark, "clustered"))
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (1997, 1998))
    found = laid_out.filter((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
    return found.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


@query(
    "incremental_sync",
    _ACCOUNTS + "SELECT id, md5(segment || ':' || round(balance)::bigint) AS fingerprint FROM v5",
)
def incremental_sync(t: Tables) -> DataFrame:
    """An index over the accounts, built at version 0 and brought up to date from the feed."""
    table = _accounts_merged(t)

    def derive_index(rows: DataFrame) -> DataFrame:
        text = F.concat_ws(":", "segment", F.round("balance").cast("bigint"))
        return rows.select("id", F.md5(text).alias("fingerprint"))

    index = write_table(derive_index(table.as_of(0)), workspace(t.spark, "index"))
    return sync_index(index, table.change_feed(1), "id", derive_index)
