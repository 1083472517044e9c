"""Projections, filters, scalar expressions, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import (
    bucket_case,
    canonical_pair,
    cast_columns,
    decode_map,
    duration_minutes,
    extract_fenced,
    extract_score,
    first_keyword,
    fold_elements,
    parse_event_ts,
    range_partition,
    surrogate_key,
    text_features,
)
from tidemark.functions.columns import RATE_CODES, STATUS_EDGES, STATUS_LABELS
from tidemark.operators.documents import word_count
from tidemark.operators.relational import quality_filter, sample_n
from tidemark.plans import derive
from tidemark.queries.registry import query
from tidemark.session import broadcast_if_small
from tidemark.sources import Tables

RE2_SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_WITH_FLIGHTS = f"WITH {derive.FLIGHTS_SQL} "


@query("select_cols", "SELECT o_orderkey, o_totalprice FROM orders")
def select_cols(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice")


@query(
    "select_nested",
    "SELECT c_custkey, n_name AS city, n_regionkey AS zone FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def select_nested(t: Tables) -> DataFrame:
    nested = t.customer.join(broadcast_if_small(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.struct(F.col("n_name").alias("city"), F.col("n_regionkey").alias("zone")).alias("address")
    )
    return nested.select("c_custkey", "address.city", "address.zone")


@query("filter_cmp", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30")
def filter_cmp(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_quantity") > 30).select("l_orderkey", "l_quantity")


@query("filter_eq", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#4'")
def filter_eq(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_brand") == "Brand#4").select("p_partkey", "p_name", "p_brand")


@query(
    "filter_and",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= '1998-01-01' "
    "AND o_orderdate < '1999-01-01' AND o_totalprice > 100000 AND o_orderstatus = 'F' ORDER BY o_totalprice DESC",
)
def filter_and(t: Tables) -> DataFrame:
    in_1998 = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (
        F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    # Column names resolve without regard to case.
    kept = t.orders.filter(in_1998 & (F.col("o_totalprice") > 100000) & (F.col("O_ORDERSTATUS") == "F"))
    return kept.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.col("o_totalprice").desc())


@query("filter_quality", f"WITH {derive.TRIPS_SQL} SELECT * EXCLUDE (airport_fee) FROM trips WHERE trip_distance > 0 AND total_amount >= 0")
def filter_quality(t: Tables) -> DataFrame:
    rules = {"distance": F.col("trip_distance") > 0, "amount": F.col("total_amount") >= 0}
    return quality_filter(derive.trips(t).drop("airport_fee"), rules)[0]


@query(
    "filter_quality_report",
    f"WITH {derive.TRIPS_SQL} SELECT count(*) AS total_rows, count(*) FILTER (NOT trip_distance > 0) AS rejected_distance, "
    "count(*) FILTER (NOT total_amount >= 0) AS rejected_amount FROM trips",
)
def filter_quality_report(t: Tables) -> DataFrame:
    rules = {"distance": F.col("trip_distance") > 0, "amount": F.col("total_amount") >= 0}
    return quality_filter(derive.trips(t), rules)[1]


@query(
    "filter_not_null",
    "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'",
)
def filter_not_null(t: Tables) -> DataFrame:
    known = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"))
    return known.filter(F.col("priority").isNotNull())


@query("filter_isin", "SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')")
def filter_isin(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type").isin("purchase", "signup")).select("event_id", "event_type")


@query(
    "filter_neq_then_case",
    "SELECT p_name, p_type, CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 0.9::double ELSE p_retailprice END "
    "AS discounted_price FROM part WHERE p_type <> 'PROMO'",
)
def filter_neq_then_case(t: Tables) -> DataFrame:
    price = F.when(F.col("p_type") == "ECONOMY", F.col("p_retailprice") * 0.9).otherwise(F.col("p_retailprice"))
    return t.part.filter(F.col("p_type") != "PROMO").select("p_name", "p_type", price.alias("discounted_price"))


@query("with_derived", "SELECT p_partkey, p_retailprice * p_size AS total_value FROM part")
def with_derived(t: Tables) -> DataFrame:
    derived = t.part.select("p_partkey", "p_size", "p_retailprice").withColumn(
        "total_value", F.col("p_retailprice") * F.col("p_size")
    )
    return derived.drop("p_size", "p_retailprice")


@query("rename_col", "SELECT c_custkey, c_name AS customer_name, c_acctbal FROM customer")
def rename_col(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_acctbal").withColumnRenamed("c_name", "customer_name")


@query(
    "cast_clean",
    "SELECT o_orderkey, try_cast(o_orderpriority AS int) AS whole, try_cast(left(o_orderpriority, 1) AS int) AS digit FROM orders",
)
def cast_clean(t: Tables) -> DataFrame:
    raw = t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("whole"), F.left("o_orderpriority", F.lit(1)).alias("digit")
    )
    return cast_columns(raw, {"whole": "int", "digit": "int"})


@query("null_typed_col", "SELECT o_orderkey, NULL::double AS airport_fee FROM orders")
def null_typed_col(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").withColumn("airport_fee", F.lit(None).cast("double"))


@query("const_col", "SELECT event_id, 3 AS seq FROM events")
def const_col(t: Tables) -> DataFrame:
    return t.events.select("event_id").withColumn("seq", F.lit(3))


@query(
    "case_bucket",
    _WITH_FLIGHTS + "SELECT flight_id, CASE WHEN delay = 0 THEN 'Delay' WHEN delay < 0 THEN 'Early' WHEN delay < 10 THEN 'On Time' "
    "WHEN delay < 30 THEN 'Late' ELSE 'Delay' END AS take_off_status FROM flights",
)
def case_bucket(t: Tables) -> DataFrame:
    """A delay of zero is turned into NULL here, to see where NULL goes."""
    delay = F.nullif(F.col("delay").cast("int"), F.lit(0))
    return derive.flights(t).select("flight_id", bucket_case(delay, STATUS_EDGES, STATUS_LABELS).alias("take_off_status"))


@query(
    "case_decode",
    "SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Standard Rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' "
    "WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated Fare' ELSE 'Unknown' END AS driver_notes FROM lineitem",
)
def case_decode(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", decode_map("l_linenumber", RATE_CODES).alias("driver_notes"))


@query("upper_text", "SELECT p_partkey, upper(p_name) AS product FROM part")
def upper_text(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.upper("p_name").alias("product"))


@query("text_left_n", "SELECT doc_id, left(text, 400) AS preview FROM documents")
def text_left_n(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.left("text", F.lit(400)).alias("preview"))


@query(
    "concat_place",
    "SELECT n_nationkey, n_name || ', ' || r_name AS place, c.n AS customers FROM nation JOIN region ON n_regionkey = r_regionkey "
    "JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey",
)
def concat_place(t: Tables) -> DataFrame:
    zones = derive.zones(t)
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    return counts.join(broadcast_if_small(zones), F.col("c_nationkey") == F.col("LocationID")).select(
        F.col("LocationID").alias("n_nationkey"), F.concat_ws(", ", "Zone", "Borough").alias("place"), "customers"
    )


@query(
    "canonical_pair",
    _WITH_FLIGHTS + "SELECT flight_id, least(origin, destination) || '-' || greatest(origin, destination) AS standardized_route FROM flights",
)
def canonical_pairs(t: Tables) -> DataFrame:
    return derive.flights(t).select("flight_id", canonical_pair("origin", "destination").alias("standardized_route"))


@query("parse_partial_date", "SELECT event_id, date_trunc('minute', ts) AS event_timestamp FROM events")
def parse_partial_date(t: Tables) -> DataFrame:
    flights = derive.flights(t)
    parsed = parse_event_ts("date", derive.EVENT_YEAR).cast("timestamp_ntz")
    return flights.select(F.col("flight_id").alias("event_id"), parsed.alias("event_timestamp"))


@query(
    "duration_minutes",
    "SELECT l_orderkey, l_linenumber, round((epoch(l_shipdate)::bigint - epoch(o_orderdate)::bigint) / 60.0, 2)::double AS minutes "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def trip_minutes(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return t.lineitem.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", duration_minutes("o_orderdate", "l_shipdate").alias("minutes")
    )


@query("unit_rescale", _WITH_FLIGHTS + "SELECT flight_id, delay / 60.0::double AS delay_hours FROM flights")
def unit_rescale(t: Tables) -> DataFrame:
    return derive.flights(t).select("flight_id", (F.col("delay").cast("int") / 60).alias("delay_hours"))


@query("month_of", "SELECT o_orderkey, month(o_orderdate)::int AS month, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def month_of(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.month("o_orderdate").alias("month"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month")
    )


@query(
    "format_ts",
    "SELECT event_id, strftime(ts, '%H:%M:%S') AS time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events",
)
def format_ts(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.date_format("ts", "HH:mm:ss").alias("time"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp")
    )


@query(
    "random_sample_n",
    "SELECT o_orderkey, o_custkey % 5 + 1 AS payment_type FROM orders ORDER BY md5(o_orderkey::varchar), o_orderkey LIMIT 1000",
)
def random_sample_n(t: Tables) -> DataFrame:
    picked = sample_n(t.orders.select("o_orderkey", "o_custkey"), 1000, "o_orderkey")
    return picked.select("o_orderkey", (F.col("o_custkey") % 5 + 1).alias("payment_type"))


@query("surrogate_key", "SELECT md5(conv_id || '|' || turn) AS message_key, conv_id, turn FROM conversations")
def surrogate_keys(t: Tables) -> DataFrame:
    return t.conversations.select(surrogate_key("conv_id", "turn").alias("message_key"), "conv_id", "turn")


@query(
    "text_enrich",
    "SELECT conv_id, turn, length(text)::int AS char_count, len(list_filter(regexp_split_to_array(text, "
    f"'{RE2_SPACE}+'), lambda x: x <> ''))::int AS word_count, "
    f"ends_with(regexp_replace(text, '{RE2_SPACE}+$', ''), '?') AS is_question, "
    "upper(replace(text, 'ß', 'SS')) AS uppercase FROM conversations",
)
def text_enrich(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", *text_features("text"))


_KEYWORDS = ["mentation", "Tion", "nicht", "que", "the"]


@query(
    "keyword_detect",
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN contains(lower(text), '{k.lower()}') THEN '{k}'" for k in _KEYWORDS)
    + " ELSE 'Unknown' END AS keyword FROM documents",
)
def keyword_detect(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", first_keyword("text", _KEYWORDS).alias("keyword"))


_NUMBER = r"\d+(?:\.\d+)?"


def _score_sql(text: str, prefix: str = "") -> str:
    number = f"try_cast(regexp_extract({text}, '{prefix}({_NUMBER})', 1) AS double)"
    clamped = f"greatest(1.0::double, least(10.0::double, {number}))"
    return f"CASE WHEN {number} IS NULL THEN 5.0::double ELSE {clamped} END"


@query(
    "regex_score",
    f"SELECT doc_id, {_score_sql('text')} AS score, {_score_sql('report', 'SCORE:' + chr(92) + 's*')} AS stated "
    "FROM (SELECT *, CASE WHEN lang = 'de' THEN text ELSE text || chr(10) || 'SCORE: ' || (doc_id % 14)::varchar || '.5' "
    "END AS report FROM documents)",
)
def regex_score(t: Tables) -> DataFrame:
    rating = F.concat(F.lit("\nSCORE: "), (F.col("doc_id") % 14).cast("string"), F.lit(".5"))
    report = F.when(F.col("lang") == "de", F.col("text")).otherwise(F.concat("text", rating))
    return t.documents.select(
        "doc_id", extract_score("text").alias("score"), extract_score(report, r"SCORE:\s*").alias("stated")
    )


@query(
    "regex_fenced_block",
    "SELECT doc_id, md5(regexp_replace(CASE WHEN regexp_matches(raw, '(?s)```(?:python)?\\n(.*?)```') "
    "THEN regexp_extract(raw, '(?s)```(?:python)?\\n(.*?)```', 1) ELSE raw END, "
    f"'^{RE2_SPACE}+|{RE2_SPACE}+$', '', 'g')) AS code_digest FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN "
    "'Answer:' || chr(10) || '```python' || chr(10) || text || chr(10) || '```' || chr(10) || 'Done.' ELSE '  ' || text || '  ' END AS raw FROM documents)",
)
def regex_fenced_block(t: Tables) -> DataFrame:
    fenced = F.concat(F.lit("Answer:\n```python\n"), "text", F.lit("\n```\nDone."))
    raw = F.when(F.col("lang") == "en", fenced).otherwise(F.concat(F.lit("  "), "text", F.lit("  ")))
    return t.documents.select("doc_id", raw.alias("raw")).select(
        "doc_id", F.md5(extract_fenced("raw")).alias("code_digest")
    )


@query(
    "range_partition_number",
    "SELECT o_orderkey, 1 + (o_orderkey > 2500)::int + (o_orderkey > 5000)::int + (o_orderkey > 10000)::int AS partition_number FROM orders",
)
def range_partition_number(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", range_partition("o_orderkey", [2500, 5000, 10000]).alias("partition_number"))


@query(
    "array_size_max",
    "SELECT vec_id, len(embedding)::int AS score_count, list_max(embedding)::double AS top_score FROM embeddings",
)
def array_size_max(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id",
        F.size("embedding").alias("score_count"),
        F.array_max("embedding").cast("double").alias("top_score"),
    )


@query(
    "array_sorted",
    "SELECT p_partkey, array_to_string(list_sort(string_split(p_name || ' ' || p_type, ' ')), ',') AS sorted_words FROM part",
)
def array_sorted(t: Tables) -> DataFrame:
    words = F.split(F.concat_ws(" ", "p_name", "p_type"), " ")
    return t.part.select("p_partkey", F.array_join(F.array_sort(words), ",").alias("sorted_words"))


@query(
    "array_collect_set",
    "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS topics FROM events GROUP BY user_id",
)
def array_collect_set(t: Tables) -> DataFrame:
    """The set of a key is as small as the domain of event types, however many events it has."""
    return t.events.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("topics")
    )


_LONG_WORDS = "list_filter(string_split(p_name, ' '), lambda w: length(w) > 4)"


@query(
    "explode_outer_rows",
    f"SELECT p_partkey, unnest(CASE WHEN len({_LONG_WORDS}) = 0 THEN [NULL] ELSE {_LONG_WORDS} END) AS word FROM part",
)
def explode_outer_rows(t: Tables) -> DataFrame:
    long_words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 4)
    return t.part.select("p_partkey", F.explode_outer(long_words).alias("word"))


@query(
    "explode_then_avg",
    "SELECT label, round(avg(x), 6) AS avg_score FROM (SELECT label, unnest(embedding)::double AS x FROM embeddings) GROUP BY label",
)
def explode_then_avg(t: Tables) -> DataFrame:
    exploded = t.embeddings.select("label", F.explode_outer("embedding").alias("score"))
    return exploded.groupBy("label").agg(F.round(F.avg(F.col("score").cast("double")), 6).alias("avg_score"))


@query("json_payload_expand", "SELECT event_id, json_extract_string(props, '$.k')::int AS k FROM events")
def json_payload_expand(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.*")


def elements_json(text: str):
    """A document's lines as the JSON a layout parser returns."""
    elements = F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("content")))
    return F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document")))


@query("json_transform_fold", "SELECT doc_id, md5(chr(10) || text) AS digest, length(text) + 1 AS n_chars FROM documents")
def json_transform_fold(t: Tables) -> DataFrame:
    parsed = t.documents.select("doc_id", elements_json("text").alias("parsed"))
    folded = parsed.select("doc_id", fold_elements("parsed").alias("text"))
    return folded.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


@query(
    "word_count",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word",
)
def count_words(t: Tables) -> DataFrame:
    return word_count(t.documents, "text")
