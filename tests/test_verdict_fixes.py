"""Run numbering on wide skewed tables, several root paths, dropped executions,
event-log reading, and the end-to-end job's reset and keys."""

import json

import pytest
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracery.operators import catalog as C
from tracery.operators.ranking import number_within_groups
from tracery.plans.jobs import lineage_from_event_logs
from tracery.plans.lineage import LineagePlan
from tracery.session import bucket_count
from tracery.sources import eventlog as EL


@pytest.mark.parametrize("partitions", ["8", "50"])
def test_numbering_with_payload_and_hot_group(spark, tmp_path, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    path = str(tmp_path / "t")
    spark.range(400_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 97)).alias("g"),
        ((F.col("id") * 7919) % 1000003).alias("k"), "id", F.repeat(F.lit("x"), 20).alias("payload"),
        (F.col("id") % 7).alias("other")).write.parquet(path)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = spark.read.parquet(path)
        got = number_within_groups(df, ["g"], ["k", "id"], "rn")
        want = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")))
        joined = got.select("id", "rn", "payload").join(want.select("id", "want"), "id")
        assert got.count() == joined.count() == 400_000
        assert joined.filter("rn <> want or payload is null").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _executions(spark, rows):
    return spark.createDataFrame(rows, "execution_id long, app_name string, master string, description string, "
                                       "started_at timestamp_ntz, default_fs string, input_override string, output_override string")


NODES = ("execution_id long, node_id int, parent_id int, edge_kind string, node_class string, relation_class string, "
         "catalog_db string, catalog_table string, path string, paths array<string>, jdbc_url string, jdbc_table string")
COLUMNS = "execution_id long, node_id int, ordinal int, column_text string, data_type string"


def test_several_root_paths_and_dropped_executions(spark):
    from datetime import datetime

    when = datetime(2020, 1, 1)
    ex = _executions(spark, [(1, "a", "m", "d", when, "hdfs://p", "", ""), (2, None, "m", "d", when, "hdfs://p", "", ""),
                             (3, "a", "m", "d", None, "hdfs://p", "", "")])
    nodes = spark.createDataFrame(
        [(i, 0, None, "root", "LogicalRelation", "HadoopFsRelation", "d", "t", "/x/1", ["/x/1", "/x/2", "/x/3"], None, None)
         for i in (1, 2, 3)], NODES)
    plan = LineagePlan(ex, nodes, spark.createDataFrame([], COLUMNS))
    got = plan.job_io.collect()
    assert [r.execution_id for r in got] == [1]
    names = [u.split(",")[1] for u in got[0].input_list]
    assert names == ["d.t", "/x/1", "/x/2", "/x/3"]


def test_read_without_url_keeps_the_rest(spark):
    from datetime import datetime

    ex = _executions(spark, [(1, "a", "m", "d", datetime(2020, 1, 1), "hdfs://p", "", "")])
    nodes = spark.createDataFrame([
        (1, 0, None, "root", "InsertIntoHiveTable", None, "d", "out", None, None, None, None),
        (1, 1, 0, "child", "LogicalRelation", "JDBCRelation", None, None, None, None, None, "s.t"),
        (1, 2, 0, "child", "HiveTableRelation", None, "d", "in", None, None, None, None)], NODES)
    got = LineagePlan(ex, nodes, spark.createDataFrame([], COLUMNS)).job_io.first()
    assert "d.in" in got.input_urns and got.n_inputs == 1 and "d.out" in got.output_urns


def _event(kind, **more):
    return json.dumps({"Event": kind, **more})


def _log(app, ids, scan):
    plan = {"nodeName": scan, "simpleString": scan, "metadata": {
        "Location": "InMemoryFileIndex(2 paths)[file:/d/one, file:/d/two]", "ReadSchema": "struct<a:int,b:struct<c:int,d:string>>"}}
    return [_event(EL.EV_APP_START, **{"App Name": app, "App ID": app, "Timestamp": 1, "User": "u"}),
            _event(EL.EV_ENV, **{"Spark Properties": {"spark.master": "local"}, "Hadoop Properties": {"fs.defaultFS": "file:///"}}),
            *[_event(EL.EV_SQL_START, executionId=i, rootExecutionId=i, description="line break", time=10 + i,
                     sparkPlanInfo=plan) for i in ids]]


def _logs(root):
    """Two applications under a folder whose name occurs twice in its path, one log compressed."""
    root.mkdir(parents=True)
    for app, ids in (("logs", (0, 1)), ("b", (0,))):
        lines = "\n".join(_log(app, ids, "Scan parquet ")) + "\n"
        if app == "b":
            (root / f"{app}.zstd").write_bytes(zstandard.ZstdCompressor().compress(lines.encode()))
        else:
            (root / app).write_text(lines)
    return str(root)


def test_event_log_reader(spark, tmp_path):
    root = _logs(tmp_path / "logs" / "logs")
    t = EL.lineage_tables(spark, root)
    assert sorted((r.app_name, r.execution_id) for r in t["executions"].collect()) == [("b", 0), ("logs", 0), ("logs", 1)]
    assert t["executions"].select("app_key").distinct().count() == 2
    assert {tuple(r.paths) for r in t["plan_nodes"].collect()} == {("file:/d/one", "file:/d/two")}
    columns = EL.scan_columns(t["plan_nodes"]).filter("execution_id = 1").orderBy("ordinal").collect()
    assert [(c.column_text, c.data_type) for c in columns] == [("a", "int"), ("b", "struct<c:int,d:string>")]
    (tmp_path / "logs" / "logs" / "c.lz4").write_bytes(b"x")
    with pytest.raises(ValueError, match="codec"):
        EL.read_events(spark, root)


def test_shortened_path_list_is_reported(spark):
    meta = spark.createDataFrame([({"Location": "InMemoryFileIndex(3 paths)[file:/a, ...]"},)], "m map<string,string>")
    assert meta.select(EL._location_paths(F.col("m")).alias("p")).first().p == ["file:/a", EL.UNLISTED]


def test_job_keys_reset_and_schemas(spark, tmp_path):
    root = _logs(tmp_path / "logs" / "logs")
    first = lineage_from_event_logs(spark, root, str(tmp_path / "out1"))
    io = spark.read.parquet(first["job_io"]).collect()
    assert len(io) == 3 and all(r.n_inputs == 2 for r in io)
    aspects = spark.read.parquet(first["aspects"])
    # One flow record per application, two columns per known schema, no empty schema.
    assert aspects.filter("aspect_name = 'dataFlowInfo'").count() == 2
    assert aspects.filter("aspect_name = 'schemaMetadata' and aspect like '%\"fields\":[]%'").isEmpty()
    stale = spark.read.parquet(first["catalog"])
    flow = stale.filter("aspect_name = 'dataFlowInfo' and aspect like '%logs%'").first().urn
    more = stale.filter("aspect_name = 'dataJobInfo'").limit(1).withColumn(
        "urn", F.lit(f"urn:li:dataJob:({flow},ExecutionId_99)"))
    earlier = str(tmp_path / "earlier")
    stale.unionByName(more).write.parquet(earlier)
    second = lineage_from_event_logs(spark, root, str(tmp_path / "out2"), catalog=earlier)
    urns = {r.urn for r in spark.read.parquet(second["catalog"]).select("urn").collect()}
    assert not any("ExecutionId_99" in u for u in urns) and any("ExecutionId_1" in u for u in urns)


def test_reset_has_no_page(spark):
    rel = spark.range(1000).select(F.lit("f").alias("entity_urn"), F.concat(F.lit("j"), "id").alias("related_urn"),
                                   F.lit("IsPartOf").alias("rel_type"), F.lit("INCOMING").alias("direction"))
    assert C.flow_members(rel).count() == 1000


def test_bucket_count_grows_with_the_input(spark):
    assert bucket_count(spark, 4_000_000_000) == 1000
