"""Scans, sources, sinks and the catalog."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.queries.registry import query
from tidemark.session import broadcast_if_small, workspace
from tidemark.sources import (
    Tables,
    catalog_overview,
    compare_counts,
    ctas,
    read_binary,
    read_csv,
    read_glob,
    read_json,
    read_rescued,
    read_table,
    register_views,
    schema_overview,
    split_by_key,
    with_ingestion_ts,
    write_csv,
    write_table,
)

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]
COLUMNS = {
    "region": "r_regionkey, r_name",
    "nation": "n_nationkey, n_name, n_regionkey",
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "part": "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate",
    "events": "event_id, ts, user_id, event_type, value, props",
    "documents": "doc_id, text, lang, source, n_chars",
    "embeddings": "vec_id, embedding, label",
    "pages": "page_id, url, html",
    "benchmark": "item_id, text",
    "labels": "doc_id, quality, toxic",
    "conversations": "conv_id, turn, role, text",
}


def _union_sql(select: str) -> str:
    return " UNION ALL ".join(select.format(t=t, cols=COLUMNS[t]) for t in TABLES)


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(t: Tables) -> DataFrame:
    return read_table(t.spark, t.folder, "customer")


@query("scan_parquet_glob", "SELECT event_id, user_id, value, event_type FROM events")
def scan_parquet_glob(t: Tables) -> DataFrame:
    root = workspace(t.spark, "glob")
    t.events.select("event_id", "user_id", "value", "event_type").write.partitionBy("event_type").parquet(root)
    return read_glob(t.spark, f"{root}/event_type=*", base_path=root)


@query("scan_csv_infer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def scan_csv_infer(t: Tables) -> DataFrame:
    path = write_csv(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), workspace(t.spark, "csv"))
    # Inference takes the narrowest type that fits the values at hand.
    return read_csv(t.spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    "scan_tsv_ref",
    "SELECT s_suppkey::varchar AS code, s_name AS city, n_name AS state "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def scan_tsv_ref(t: Tables) -> DataFrame:
    nations = broadcast_if_small(t.nation)
    ref = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("IATA"), F.col("s_name").alias("City"), F.col("n_name").alias("State"), "s_acctbal"
    )
    path = write_csv(ref, workspace(t.spark, "tsv"), delimiter="\t")
    stored = read_csv(t.spark, path, delimiter="\t", infer=False)
    return stored.select(F.col("IATA").alias("code"), F.col("City").alias("city"), F.col("State").alias("state"))


@query(
    "scan_json_lines",
    "SELECT event_id, event_type AS action, strftime(ts, '%Y-%m-%d %H:%M:%S') AS update_ts, props AS payload FROM events",
)
def scan_json_lines(t: Tables) -> DataFrame:
    path = workspace(t.spark, "json")
    t.events.select(
        "event_id",
        F.col("event_type").alias("action"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("update_ts"),
        F.col("props").alias("payload"),
    ).write.json(path)
    return read_json(t.spark, path, "event_id bigint, action string, update_ts string, payload string")


@query("scan_binary_files", "SELECT page_id, length(html) AS n_chars, md5(html) AS digest FROM pages")
def scan_binary_files(t: Tables) -> DataFrame:
    """Pages written as files of a few hundred lines, read back as whole files and taken apart."""
    path = workspace(t.spark, "binary")
    line = F.concat_ws("\t", F.col("page_id").cast("string"), F.base64(F.encode("html", "UTF-8")))
    # base64() wraps lines; a page has to stay on one.
    t.pages.select(F.regexp_replace(line, "[\r\n]", "").alias("value")).write.option("maxRecordsPerFile", 256).text(path)
    lines = read_binary(t.spark, path, "*.txt").select(
        F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")
    )
    page = F.decode(F.unbase64(F.split_part("line", F.lit("\t"), F.lit(2))), "UTF-8")
    return lines.filter("line <> ''").select(
        F.split_part("line", F.lit("\t"), F.lit(1)).cast("bigint").alias("page_id"),
        F.length(page).cast("bigint").alias("n_chars"),
        F.md5(page).alias("digest"),
    )


@query(
    "create_from_rows",
    "SELECT stage, weight, goal, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events "
    "JOIN (VALUES ('view', 'browse'), ('click', 'browse'), ('signup', 'join'), ('purchase', 'buy')) "
    "AS s(event_type, stage) USING (event_type) JOIN (VALUES ('browse', 1), ('join', 5), ('buy', 9)) AS w(stage, weight) "
    "USING (stage) LEFT JOIN (VALUES ('buy', 2.5::double), ('join', NULL)) AS g(stage, goal) USING (stage) GROUP BY ALL",
)
def create_from_rows(t: Tables) -> DataFrame:
    """Small tables from literal rows: tuples with names only, tuples with a DDL schema, Rows with a StructType."""
    named = [("view", "browse"), ("click", "browse"), ("signup", "join"), ("purchase", "buy")]
    stages = t.spark.createDataFrame(named, ["event_type", "stage"])
    weights = t.spark.createDataFrame([("browse", 1), ("join", 5), ("buy", 9)], "stage string, weight int")
    fields = StructType([StructField("stage", StringType(), False), StructField("goal", DoubleType())])
    goals = t.spark.createDataFrame([Row(stage="buy", goal=2.5), Row(stage="join", goal=None)], fields)
    per_type = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    staged = per_type.join(F.broadcast(stages), "event_type")  # a few literal rows each
    return (
        staged.join(F.broadcast(weights), "stage")
        .join(F.broadcast(goals), "stage", "left")
        .groupBy("stage", "weight", "goal")
        .agg(F.sum("n").alias("n_events"), F.round(F.sum("v"), 2).alias("total_value"))
    )


@query(
    "range_source",
    "SELECT r.id, count(o_orderkey) AS n_orders FROM range((SELECT max(o_custkey) + 1 FROM orders)) r(id) "
    "LEFT JOIN orders ON o_custkey = r.id GROUP BY r.id",
)
def range_source(t: Tables) -> DataFrame:
    """Every possible customer id with its number of orders."""
    last = t.orders.agg(F.max("o_custkey")).first()[0]
    counts = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return t.spark.range(last + 1).join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n_orders"))


_BUSIEST = "SELECT {key}, COUNT(*) AS num_pickups FROM {table} GROUP BY {key} ORDER BY num_pickups DESC, {key} LIMIT 10"


@query("temp_view_sql", _BUSIEST.format(key="l_suppkey", table="lineitem"))
def temp_view_sql(t: Tables) -> DataFrame:
    register_views({"tidemark_lines": t.lineitem})
    return t.spark.sql(_BUSIEST.format(key="l_suppkey", table="tidemark_lines"))


@query(
    "catalog_overview",
    "SELECT 'tidemark_' || table_name AS table_name, 'TEMPORARY' AS table_type, true AS is_temporary, row_count FROM ("
    + _union_sql("SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}")
    + ") UNION ALL SELECT 'tidemark_managed', 'MANAGED', false, count(*) FROM supplier "
    "UNION ALL SELECT 'tidemark_external', 'EXTERNAL', false, count(*) FROM nation",
)
def catalog_of_tables(t: Tables) -> DataFrame:
    """Views, a managed and an external table as the catalog lists them, with their row counts. Stored tables have names
    of their own for each run, which the result leaves out."""
    run = uuid4().hex[:12]
    views = {f"tidemark_{name}": getattr(t, name) for name in TABLES}
    register_views(views)
    ctas(t.spark, f"tidemark_managed_{run}", t.supplier)
    ctas(t.spark, f"tidemark_external_{run}", t.nation, workspace(t.spark, "external"))
    names = [*views, f"tidemark_managed_{run}", f"tidemark_external_{run}"]
    counts = compare_counts({name: t.spark.table(name) for name in names}, label="table_name")
    listed = catalog_overview(t.spark).drop("database")
    return F.broadcast(listed).join(counts, "table_name").select(
        F.replace("table_name", F.lit(f"_{run}"), F.lit("")).alias("table_name"), "table_type", "is_temporary", "row_count"
    )


@query(
    "schema_overview",
    _union_sql("SELECT '{t}' AS table_name, '{t}({cols})' AS line, count(*) AS row_count FROM {t}"),
)
def schema_of_tables(t: Tables) -> DataFrame:
    tables = {name: getattr(t, name) for name in TABLES}
    counts = compare_counts(tables, label="table_name")
    return broadcast_if_small(schema_overview(tables)).join(counts, "table_name").select("table_name", "line", "row_count")


@query("sink_overwrite", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_overwrite(t: Tables) -> DataFrame:
    path = workspace(t.spark, "overwrite")
    write_table(t.supplier.select("s_suppkey"), path)
    return write_table(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path, "overwrite")


@query(
    "sink_append",
    "SELECT 'customer' AS party, c_name AS name, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier",
)
def sink_append(t: Tables) -> DataFrame:
    path = workspace(t.spark, "append")
    party = lambda df, kind, p: df.select(
        F.lit(kind).alias("party"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_acctbal").alias("balance")
    )
    write_table(party(t.customer, "customer", "c"), path)
    return write_table(party(t.supplier, "supplier", "s"), path, "append")


@query("sink_csv_header", "SELECT p_partkey, p_name, p_retailprice FROM part")
def sink_csv_header(t: Tables) -> DataFrame:
    path = write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), workspace(t.spark, "export"))
    return read_csv(t.spark, path, schema="p_partkey bigint, p_name string, p_retailprice double")


@query("ctas", "SELECT c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 4) AS avg_balance FROM customer GROUP BY 1")
def ctas_segments(t: Tables) -> DataFrame:
    df = t.customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("avg_balance")
    )
    path = workspace(t.spark, "ctas")
    return ctas(t.spark, f"tidemark_segments_{path[-8:]}", df, path)


@query(
    "split_by_key",
    "SELECT l_linenumber AS vendor, count(*) AS n_rows, round(sum(l_extendedprice), 2) AS total "
    "FROM lineitem WHERE l_linenumber IN (1, 2, 4, 5, 6) GROUP BY 1",
)
def split_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_extendedprice", "l_linenumber")
    parts = split_by_key(lines, "l_linenumber", (1, 2, 4, 5, 6), workspace(t.spark, "split"))
    totals = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_extendedprice"), 2).alias("total")).select(
            F.lit(vendor).alias("vendor"), "n_rows", "total"
        )
        for vendor, df in parts.items()
    ]
    out = totals[0]
    for df in totals[1:]:
        out = out.unionByName(df)
    return out


@query("add_ingestion_ts", "SELECT o_orderkey, true AS stamped, 19 AS text_length FROM orders")
def add_ingestion_ts(t: Tables) -> DataFrame:
    stamped = with_ingestion_ts(with_ingestion_ts(t.orders.select("o_orderkey")), "yyyy-MM-dd HH:mm:ss", "loaded_at")
    return stamped.select(
        "o_orderkey",
        F.col("ingestion_timestamp").isNotNull().alias("stamped"),
        F.length("loaded_at").alias("text_length"),
    )


@query(
    "rescue_schema_drift",
    "SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' "
    "THEN event_id || ',' || user_id || ',' || event_type || ',' || value || ',extra' END AS _rescued_data FROM events",
)
def rescue_schema_drift(t: Tables) -> DataFrame:
    """Error events are written with one field too many."""
    path = workspace(t.spark, "drift")
    fields = F.concat_ws(",", "event_id", "user_id", "event_type", F.col("value").cast("string"))
    extra = F.when(F.col("event_type") == "error", ",extra").otherwise("")
    t.events.select(F.concat(fields, extra).alias("value")).write.text(path)
    return read_rescued(t.spark, path, "event_id bigint, user_id bigint, event_type string, value double", header=False)


@query(
    "rescue_header_drift",
    "SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 <> 2 THEN value END AS value, "
    "CASE WHEN event_id % 3 = 1 THEN '{\"note\":\"n' || user_id || '\"}' END AS _rescued_data FROM events",
)
def rescue_header_drift(t: Tables) -> DataFrame:
    """Files with the declared header, with a reordered one and a new column in it, and without a column."""
    path = workspace(t.spark, "drift")
    events = t.events.withColumn("note", F.concat(F.lit("n"), F.col("user_id").cast("string")))
    declared = ["event_id", "user_id", "event_type", "value"]
    for i, columns in enumerate((declared, ["value", "event_type", "note", "user_id", "event_id"], declared[:3])):
        events.where(F.col("event_id") % 3 == i).select(*columns).write.mode("append").csv(path, header=True)
    return read_rescued(t.spark, path, "event_id bigint, user_id bigint, event_type string, value double")
