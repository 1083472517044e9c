import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.session import workspace, workspace_root
from tidemark.streaming import run_stream, stream_files
from tidemark.sources import catalog_overview, read_rescued, schema_overview, split_by_key, with_cached_view, write_table


def test_scratch_goes_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace_root(spark) == shared
    assert workspace(spark, "x").startswith(f"{shared}/tidemark/x-")


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        workspace_root(Session())


def test_schema_lines(tables):
    lines = [r.line for r in schema_overview({"region": tables.region, "nation": tables.nation}).collect()]
    assert lines == ["nation(n_nationkey, n_name, n_regionkey)", "region(r_regionkey, r_name)"]


def test_split_reads_one_folder_per_value(spark, tables):
    parts = split_by_key(tables.lineitem.select("l_orderkey", "l_linenumber"), "l_linenumber", (1, 9), workspace(spark, "split"))
    assert parts[1].columns == ["l_orderkey", "l_linenumber"]
    assert parts[1].count() == tables.lineitem.filter("l_linenumber = 1").count()
    assert parts[9].count() == 0
    assert "PartitionFilters: [isnotnull(l_linenumber" in parts[1]._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_cached_view_is_released(spark, tables):
    with with_cached_view(tables.nation, "cached_nation") as cached:
        assert spark.catalog.isCached("cached_nation")
        assert cached.agg(F.count("*")).first()[0] == 25
    assert not spark.catalog.tableExists("cached_nation")


def test_catalog_lists_views_and_tables(spark, tables):
    tables.region.createOrReplaceTempView("region_view")
    found = {r.table_name: r.is_temporary for r in catalog_overview(spark).collect()}
    assert found["region_view"] is True
    spark.catalog.dropTempView("region_view")


def test_rebalanced_write_keeps_every_row(spark, tables):
    lines = tables.lineitem.select("l_orderkey", "l_linenumber").repartition(8)
    plain = write_table(lines, workspace(spark, "plain"), partition_by=["l_linenumber"])
    even = write_table(lines, workspace(spark, "even"), partition_by=["l_linenumber"], rebalance=True)
    files = lambda df: df.select("_metadata.file_path").distinct().count()
    assert files(plain) == 56 and files(even) < 20
    assert even.columns == ["l_orderkey", "l_linenumber"]
    assert plain.exceptAll(even).isEmpty() and plain.count() == even.count()


def landed(spark, *files):
    path = workspace(spark, "drift")
    for lines in files:
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def either_way(spark, path, schema):
    """The rows of a batch read, which a stream over the same files must give too."""
    got = rows(read_rescued(spark, path, schema))
    assert rows(run_stream(stream_files(spark, path, schema, "csv", rescue=True, max_files=1))) == got
    return got


def test_columns_are_found_by_each_files_header(spark):
    path = landed(spark, ["id,name,n", "1,a,10"], ["N,id,name", "20,2,b", "x,3,c"], ["id,extra,name,n", "4,e,d,40", "5,,f,50", "6,g"], ["id,n", "7,70"])
    assert either_way(spark, path, "id int, name string, n int") == sorted([
        (1, "a", 10, None), (2, "b", 20, None), (3, "c", None, "x,3,c"), (4, "d", 40, '{"extra":"e"}'), (5, "f", 50, None),
        (6, None, None, '{"extra":"g","_line":"6,g"}'), (7, None, 70, None),
    ], key=str)


def test_reordered_flights_in_a_stream(spark):
    path = landed(spark, ["date,delay,distance,origin,destination", "01010900,7,200,A,B"], ["date,distance,delay", "01020900,300,-2"])
    schema = "date string, delay int, distance int, origin string, destination string"
    assert either_way(spark, path, schema) == [("01010900", 7, 200, "A", "B", None), ("01020900", -2, 300, None, None, None)]


def test_fields_survive_reordering(spark):
    """Quotes, separators, backslashes, empty and blank fields read the same whatever the order of columns."""
    values = [('say "hi", you', "C:\\x\\", 1.5), ("", " padded ", -2.0), (None, "é,日本", None), ("\\", '"', 0.0), ("a\\\"b", "'q'", 3.0)]
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "k int, a string, b string, c double").coalesce(1)
    path = workspace(spark, "quoted")
    frame.write.mode("append").csv(path, header=True)
    frame.selectExpr("c", "b", "k + 10 AS k", "a").write.mode("append").csv(path, header=True)
    got = either_way(spark, path, frame.schema)
    assert [r[1:4] for r in sorted(got) if r[0] >= 10] == [r[1:4] for r in sorted(got) if r[0] < 10]
    assert rows(spark.read.schema(frame.schema).csv(path, header=True).where("k < 10")) == sorted([r[:4] for r in got if r[0] < 10], key=str)


def test_a_task_in_the_middle_of_a_file_knows_its_header(spark):
    path = landed(spark, ["b,a,more", *(f"{2 * i},{i},m{i}" for i in range(3_000))])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        whole = read_rescued(spark, path, "a int, b int")
        assert whole.rdd.getNumPartitions() > 4
        assert rows(whole) == sorted([(i, 2 * i, f'{{"more":"m{i}"}}') for i in range(3_000)], key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_repeated_and_blank_headers(spark):
    path = landed(spark, ["\ufeffid,name,name,", "1,a,b,c"], ["", "  ", "name,id", "", "d,2"], ["id"], [""])
    assert either_way(spark, path, "id int, name string") == [(1, "a", '{"name_2":"b","":"c"}'), (2, "d", None)]
