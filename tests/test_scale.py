"""Paths that only large or skewed data takes, against the plain computation; and plan shapes."""

import numpy as np
import pytest
from conftest import SMALL, plan_of, rows
from pyspark.sql import Window, functions as F

import __spark_entry__ as contract
from tidemark.operators import threads
from tidemark.operators.layout import cluster, zorder_key
from tidemark.operators.ordered import rank_within, running_total, top_n_per_key
from tidemark.operators.relational import sample_n
from tidemark.operators.retrieval import CellIndex, vector_topk, vector_topk_batch
from tidemark.session import broadcast_if_small, workspace


@pytest.fixture
def skewed(tables):
    """A third of the orders under one key, and under it one date for most of them; some NULLs."""
    hot_date = F.lit("1996-01-01").cast("timestamp_ntz")
    return tables.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderpriority")).alias("k"),
        F.when(F.col("o_orderkey") % 7 < 4, hot_date)
        .when(F.col("o_orderkey") % 50 == 1, None)
        .otherwise(F.col("o_orderdate"))
        .alias("d"),
        (F.when(F.col("o_orderkey") % 11 > 0, F.col("o_custkey"))).alias("v"),
    )


def windowed(df, keys, order, name="rank"):
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


@pytest.mark.parametrize("partitions", [None, 1, 37])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_of_hot_keys_is_exact(skewed, descending, partitions):
    direction = F.desc if descending else F.asc
    want = windowed(skewed, ["k"], [direction("d"), F.asc("o_orderkey")])
    got = rank_within(skewed, ["k"], "d", "o_orderkey", descending, partitions=partitions)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_rank_of_text_keys_and_orders(skewed):
    """Order and tie-breaker of text; one value (the hot date) fills most of the ranges."""
    texts = skewed.select("k", F.col("d").cast("string").alias("d"), F.format_string("%09d", "o_orderkey").alias("id"))
    want = windowed(texts, ["k"], [F.asc("d"), F.asc("id")])
    assert rows(rank_within(texts, ["k"], "d", "id", partitions=29)) == rows(want)


def test_rank_of_two_hot_keys_in_disjoint_ranges(spark):
    """Each fills many ranges of its own; a third key has one row between them."""
    df = spark.range(6_001).selectExpr(
        "CASE WHEN id < 3000 THEN 'a' WHEN id = 3000 THEN 'b' ELSE 'c' END AS k",
        "CASE WHEN id < 3000 THEN id ELSE 1000000 - id END AS at", "id",
    )
    got = rank_within(df.repartition(5), ["k"], "at", "id", partitions=16)
    assert rows(got) == rows(windowed(df, ["k"], [F.asc("at"), F.asc("id")]))


def test_rank_without_keys_and_without_rows(skewed):
    got = rank_within(skewed, [], ["k", "d"], "o_orderkey", partitions=11)
    want = skewed.withColumn("rank", F.row_number().over(Window.orderBy("k", "d", "o_orderkey")).cast("long"))
    assert rows(got) == rows(want)
    assert rank_within(skewed.limit(0), ["k"], "d", "o_orderkey").collect() == []


def test_no_task_ranks_a_whole_hot_key(skewed):
    """Every window of rows is partitioned by range; offsets have a row for each range at most."""
    plan = plan_of(rank_within(skewed, ["k"], "d", "o_orderkey", partitions=16))
    assert "_tide_range" in next(line for line in plan.splitlines() if "row_number" in line)


def test_top_n_beyond_the_group_limit(skewed):
    order = [F.col("d").desc(), F.col("o_orderkey")]
    want = windowed(skewed, ["k"], order).filter("rank <= 1200").drop("rank")
    assert rows(top_n_per_key(skewed, ["k"], order, 1_200)) == rows(want)


@pytest.mark.parametrize("partitions", [None, 23])
def test_running_total_of_hot_keys_is_exact(skewed, partitions):
    frame = Window.partitionBy("k").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    got = running_total(skewed, ["k"], "o_orderkey", F.col("v"), "total", partitions)
    assert rows(got) == rows(skewed.withColumn("total", F.sum("v").over(frame)))


def test_hot_threads_have_exact_budgets(tables):
    size = F.size(F.split("text", " "))
    plain = threads.over_budget(tables.conversations, size, 100, partitions=1)
    ranges = threads.over_budget(tables.conversations, size, 100, partitions=50)
    assert rows(ranges) == rows(plain)


@pytest.mark.parametrize("partitions", [None, 13])
def test_long_threads_have_the_grain_of_short_ones(spark, partitions):
    said = lambda thread, n: spark.range(n).selectExpr(f"{thread} AS conv_id", "id * 2 AS turn", "'user' AS role", "string(id) AS text")
    both = said(1, 3).unionByName(said(2, 2_500)).repartition(4)
    got = threads.ordered_messages(both, partitions=partitions).select("conv_id", "position", "turn").collect()
    assert sorted(tuple(r) for r in got) == [(t, i + 1, 2 * i) for t, n in ((1, 3), (2, 2_500)) for i in range(n)]
    lists = {r.conv_id: [m.turn for m in r.messages] for r in threads.fold_threads(both).collect()}
    assert lists == {1: [0, 2, 4], 2: list(range(0, 5_000, 2))}


def test_sample_bound_does_not_change_the_sample(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    want = df.orderBy(F.md5(F.col("k").cast("string")), "k").limit(50)
    sampled = sample_n(df, 50, "k")
    assert "sample-" in plan_of(sampled)  # only the rows under the hash bound are sorted
    assert rows(sampled) == rows(want)


@pytest.fixture
def vectors(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(300, 8)).astype("float32")
    data[200:] = data[:100]  # copies: ties go to the lower id
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    return data, frame.repartition(5)


def brute(data, queries, k):
    scores = queries @ data.T / (np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(data, axis=1) + 1e-10)
    scores = np.round(scores, 12)
    return [sorted(range(len(data)), key=lambda i: (-s[i], i))[:k] for s in scores]


def test_top_k_of_one_query(vectors):
    data, frame = vectors
    query = data[3].astype(float)
    got = [r.vec_id for r in vector_topk(frame, query, 4).collect()]
    assert got == brute(data.astype(float), query[None, :], 4)[0]
    assert got[:2] == [3, 203]


def test_rows_without_a_vector_are_passed_over(spark, vectors):
    _, frame = vectors
    holes = frame.unionByName(spark.createDataFrame([(999, None)], frame.schema))
    assert vector_topk(holes, [1.0] * 8, 2).collect() == vector_topk(frame, [1.0] * 8, 2).collect()


def hits_of(frame, wanted, k, **options):
    spark = frame.sparkSession
    queries = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(wanted)], "query_id long, query_vector array<double>")
    got = {i: [] for i in range(len(wanted))}
    for r in vector_topk_batch(frame, queries, k, **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    return [got[i] for i in range(len(wanted))]


@pytest.mark.parametrize("limit,block", [(100, 1000), (3, 64), (3, 7)])
def test_top_k_of_many_queries(vectors, limit, block):
    data, frame = vectors
    wanted = np.random.default_rng(1).normal(size=(20, 8))
    assert hits_of(frame, wanted, 3, query_limit=limit, block_rows=block) == brute(data.astype(float), wanted, 3)


@pytest.mark.parametrize("kind", ["clusters", "copies", "zeros", "few", "uniform"])
def test_index_search_is_exact(spark, monkeypatch, kind):
    """Recall 1.0 with every tie by id: clustered data, a third of the rows equal, zero and tiny vectors, fewer than k."""
    monkeypatch.setattr(CellIndex.build.__func__, "__defaults__", (40, 16))
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6)) * 5
    data = np.concatenate([c + rng.normal(size=(30, 6)) * 0.3 for c in centres])
    wanted = np.concatenate([centres[:5] + 0.1, rng.normal(size=(10, 6)), -centres[:2], np.zeros((1, 6)), data[:3]])
    if kind == "copies":
        data[rng.permutation(len(data))[:120]] = data[7]
    elif kind == "zeros":
        data[::4], data[1::4] = 0, data[1::4] * 1e-7
    elif kind == "few":
        data = data[:4]
    elif kind == "uniform":
        data = rng.normal(size=(300, 6))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(4)
    assert hits_of(frame, wanted, 6, query_limit=2, block_rows=25) == brute(data, wanted, 6)


def test_index_search_looks_at_few_cells(spark, monkeypatch):
    """Well separated clusters: most cells are never compared with a query, and no task gets more than a block."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(64, 16)) * 10
    data = np.repeat(centres, 50, axis=0) + rng.normal(size=(3_200, 16)) * 0.05
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>").repartition(4)
    asked = []
    matched = CellIndex._matched
    monkeypatch.setattr(CellIndex, "_matched", lambda self, probes, told, *rest: asked.append((self, told)) or matched(self, probes, told, *rest))
    wanted = centres + 0.01
    assert hits_of(frame, wanted, 5, query_limit=2, block_rows=30) == brute(data, wanted, 5)
    index = asked[0][0]
    sizes = {r.cell: r.n for r in index.lists.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    compared = sum(n * sizes[cell] for _, told in asked for cell, n in told.items())
    assert compared < 0.1 * len(data) * len(wanted)
    assert all(-(-n // index.blocks[c]) <= 30 for c, n in sizes.items())


def test_index_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert hits_of(empty, np.ones((5, 3)), 2, query_limit=1) == [[]] * 5


def test_broadcast_only_below_the_limit(tables):
    small = broadcast_if_small(tables.nation)
    joined = tables.customer.join(small, F.col("c_nationkey") == F.col("n_nationkey"))
    assert "hint" in joined._jdf.queryExecution().analyzed().toString().lower()
    large = broadcast_if_small(tables.nation, limit=1)
    joined = tables.customer.join(large, F.col("c_nationkey") == F.col("n_nationkey"))
    assert "hint" not in joined._jdf.queryExecution().analyzed().toString().lower()


def test_filters_and_columns_reach_the_scan(tables):
    plan = plan_of(contract.queries()["filter_and"](tables.spark, SMALL))
    assert "PushedFilters: [" in plan and "GreaterThan(o_totalprice,100000.0)" in plan
    scan = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "o_orderpriority" not in scan


def test_latest_per_key_limits_before_the_shuffle(tables):
    latest = top_n_per_key(tables.events.select("user_id", "ts", "event_id"), ["user_id"], [F.col("ts").desc(), F.col("event_id")])
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") >= 2


def test_route_totals_sum_before_the_lookups(tables):
    plan = plan_of(contract.entry(tables.spark))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# Queries whose building runs whole pipelines are left to the twin tests.
EAGER = {"medallion_taxi", "medallion_flights"}


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if not n.startswith("stream_") and n not in EAGER))
def test_no_cross_join_anywhere(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_clustering_skips_files(spark, tables):
    path = workspace(spark, "clustered")
    stored = cluster(tables.lineitem, ["l_orderkey"], path, partitions=4)
    ranges = (
        stored.groupBy("_metadata.file_name").agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi")).orderBy("lo").collect()
    )
    assert len(ranges) == 4
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    assert stored.count() == tables.lineitem.count()


def test_interleaved_key_keeps_both_columns_close(tables):
    df = tables.lineitem.select("l_orderkey", "l_suppkey").withColumn("z", zorder_key(tables.lineitem, ["l_orderkey", "l_suppkey"]))
    whole = df.agg((F.max("l_orderkey") - F.min("l_orderkey")).alias("a"), (F.max("l_suppkey") - F.min("l_suppkey")).alias("b")).first()
    quarter = Window.orderBy("z")
    parts = df.withColumn("p", F.ntile(16).over(quarter)).groupBy("p").agg(
        (F.max("l_orderkey") - F.min("l_orderkey")).alias("a"), (F.max("l_suppkey") - F.min("l_suppkey")).alias("b")
    )
    mean = parts.agg(F.avg("a"), F.avg("b")).first()
    assert mean[0] < 0.6 * whole.a and mean[1] < 0.8 * whole.b


def per_file(df, *columns):
    aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    return df.groupBy("_metadata.file_name").agg(F.count("*").alias("n"), *aggs).collect()


def test_a_value_of_most_rows_fills_even_files(spark):
    """Nine of ten rows have one value, and are alike in all columns."""
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, CAST(id AS STRING), 'hot') AS k", "'same' AS v").repartition(4)
    files = per_file(cluster(df, ["k"], workspace(spark, "hot"), partitions=8), "k")
    assert len(files) == 8 and sum(f.n for f in files) == 20_000
    assert max(f.n for f in files) < 1.5 * 20_000 / 8
    files = per_file(cluster(df, ["k", "v"], workspace(spark, "hot"), partitions=8), "k")
    assert len(files) == 8 and max(f.n for f in files) < 1.5 * 20_000 / 8


def test_two_text_columns_skip_files(spark):
    """A filter on either column leaves most files unread, by what their statistics say."""
    df = spark.range(40_000).select(
        F.md5(F.col("id").cast("string")).alias("a"), F.concat(F.lit("k"), F.md5((F.col("id") * 7 + 1).cast("string"))).alias("b"), "id"
    )
    stored = cluster(df.repartition(6), ["a", "b"], workspace(spark, "texts"), partitions=64)
    assert stored.count() == 40_000 and stored.exceptAll(df).isEmpty()
    files = per_file(stored, "a", "b")
    for column, low, high in (("a", "3", "38"), ("b", "k9", "k98")):
        read = [f for f in files if f[f"lo_{column}"] < high and f[f"hi_{column}"] >= low]
        assert len(read) <= 24, (column, len(read), len(files))


def test_layout_of_nulls_dates_and_nothing(spark):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 > 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 400).cast("int"))).alias("d"),
        F.when(F.col("id") % 5 > 0, (F.col("id") / 7).cast("decimal(12,3)")).alias("n"),
        F.lit(None).cast("string").alias("none"),
    )
    stored = cluster(df, ["d", "n", "none"], workspace(spark, "mixed"), partitions=5)
    assert rows(stored) == rows(df)
    assert cluster(df.limit(0), ["d", "none"], workspace(spark, "empty")).collect() == []
