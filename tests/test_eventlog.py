"""P2 end to end: lineage from this session's own Spark event log."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tracery.plans.lineage import LineagePlan
from tracery.sources import eventlog as EL
from tracery.sources.eventlog import NODE_COLS

COLS = "execution_id long, node_id int, ordinal int, column_text string, data_type string"


def test_lineage_from_real_event_log(spark, event_dir):
    work = tempfile.mkdtemp(prefix="tracery-p2-")
    src, out1, out2 = (os.path.join(work, d) for d in ("src", "out1", "out2"))
    spark.range(40).selectExpr("id", "id % 3 as k").write.mode("overwrite").parquet(src)
    spark.read.parquet(src).filter("k = 1").write.mode("overwrite").parquet(out1)
    cached = spark.read.parquet(src)
    cached.cache()
    cached.count()
    cached.filter("k = 2").write.mode("overwrite").parquet(out2)
    cached.unpersist()
    table = "tracery_p2_src"
    spark.read.parquet(src).write.mode("overwrite").option("path", os.path.join(work, "tbl")).saveAsTable(table)
    out3 = os.path.join(work, "out3")
    spark.table(table).write.mode("overwrite").parquet(out3)

    # CSV join CSV, cached, written as CSV; and a union of two reads.
    ca, cb, out4, out5 = (os.path.join(work, d) for d in ("ca", "cb", "out4", "out5"))
    spark.range(10).selectExpr("id as k", "id * 2 as x").write.mode("overwrite").option("header", "true").csv(ca)
    spark.range(10).selectExpr("id as k", "id * 3 as y").write.mode("overwrite").option("header", "true").csv(cb)
    joined = spark.read.option("header", "true").csv(ca).join(spark.read.option("header", "true").csv(cb), "k")
    joined.cache()
    joined.count()
    joined.write.mode("overwrite").option("header", "true").csv(out4)
    joined.unpersist()
    spark.read.parquet(src).unionByName(spark.read.parquet(out1)).write.mode("overwrite").parquet(out5)

    tables = EL.lineage_tables(spark, event_dir)
    app = spark.sparkContext.applicationId
    execs = tables["executions"].filter(F.col("app_id") == app)
    nodes = tables["plan_nodes"].join(execs.select("execution_id", "app_key"), ["execution_id", "app_key"], "left_semi")
    plan = LineagePlan(execs.drop("app_id", "app_key"), nodes.select(*NODE_COLS), spark.createDataFrame([], COLS))
    got = {r.output_urns: r.input_urns.split("|") for r in plan.job_io.collect() if r.output_urns}

    def file_urn(p):
        return f"urn:li:dataset:(urn:li:dataPlatform:hdfs,file:{p},PROD)"

    def urn_hive(name):
        return f"urn:li:dataset:(urn:li:dataPlatform:hive,{name},PROD)"

    # Direct scan: met by the query walk and the plan walk (reference keeps both).
    assert got[file_urn(out1)] == [file_urn(src), file_urn(src)]
    # Cached scan: the leaf of the in-memory relation's plan.
    assert got[file_urn(out2)] == [file_urn(src)]
    # Catalog table scan: its catalog name and its root path, by both walks.
    tbl = [urn_hive("default." + table), file_urn(os.path.join(work, "tbl"))]
    assert got[file_urn(out3)] == tbl + tbl
    # Cached join: the leaves of the cached plan, left then right.
    assert got[file_urn(out4)] == [file_urn(ca), file_urn(cb)]
    # Union of two file reads: each met by both walks.
    assert got[file_urn(out5)] == [file_urn(src), file_urn(out1), file_urn(src), file_urn(out1)]
    settings = EL.session_settings(tables["events"])
    assert settings.filter(F.col("key") == "spark.master").count() >= 1


def test_jdbc_read_without_logged_url(spark):
    """Spark logs no JDBC URL: the table name is read from the scan, the input
    stays unresolved, and the execution keeps its other lineage."""
    root = tempfile.mkdtemp(prefix="tracery-jdbc-")
    scans = [{"nodeName": f"Scan JDBCRelation({t}) [numPartitions=1]", "simpleString": "Scan JDBCRelation", "children": [], "metadata": {}}
             for t in ("T9", "(select 1) x")]
    plan = {"nodeName": "Execute InsertIntoHadoopFsRelationCommand", "metadata": {}, "children": [
        {"nodeName": "WholeStageCodegen (1)", "simpleString": "", "metadata": {}, "children": scans}],
        "simpleString": "Execute InsertIntoHadoopFsRelationCommand file:/out, false, Parquet, [path=file:/out], Overwrite, [id]"}
    events = [{"Event": EL.EV_APP_START, "App Name": "a", "App ID": "a", "Timestamp": 1, "User": "u"},
              {"Event": EL.EV_ENV, "Spark Properties": {"spark.master": "local"}, "Hadoop Properties": {"fs.defaultFS": "file:///"}},
              {"Event": EL.EV_SQL_START, "executionId": 0, "rootExecutionId": 0, "description": "d", "time": 5, "sparkPlanInfo": plan}]
    with open(os.path.join(root, "app"), "w") as f:
        f.write("".join(json.dumps(e) + "\n" for e in events))
    tables = EL.lineage_tables(spark, root)
    nodes = tables["plan_nodes"]
    scans = nodes.filter(F.col("node_name").startswith("Scan JDBCRelation")).select(
        "node_class", "relation_class", "jdbc_table", "jdbc_url").distinct().collect()
    assert sorted(tuple(r) for r in scans) == [("LogicalRelation", "JDBCRelation", t, None) for t in ("(select 1) x", "T9")]
    plan = LineagePlan(tables["executions"].drop("app_id", "app_key"), nodes.select(*NODE_COLS), spark.createDataFrame([], COLS))
    assert [(r.n_inputs, r.n_outputs) for r in plan.job_io.collect()] == [(0, 1)]


def test_zstd_compressed_log_reads_like_plain(spark, event_dir):
    """Spark's default event-log codec is zstd; compressed files give the same events."""
    import glob

    import zstandard

    plain_files = [f for f in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and not f.endswith(".zstd") and os.path.getsize(f) > 0]
    assert plain_files
    copy = tempfile.mkdtemp(prefix="tracery-zstd-")
    app_dir = os.path.join(copy, "eventlog_v2_app-zstd")
    os.makedirs(app_dir)
    # The session goes on writing its log: both sides use the bytes read now.
    with open(plain_files[0], "rb") as src:
        raw = src.read()
    raw = raw[:raw.rfind(b"\n") + 1]
    with open(os.path.join(app_dir, "events_1_app-zstd.zstd"), "wb") as dst:
        dst.write(zstandard.ZstdCompressor().compress(raw))
    packed = EL.read_events(spark, copy)
    n_plain = sum(1 for line in raw.split(b"\n") if line.strip() and json.loads(line)["Event"] in EL.KINDS)
    assert n_plain
    assert packed.count() == n_plain
    assert packed.filter(F.col("event").isNull()).count() == 0
    assert packed.select("app_key").distinct().collect()[0][0] == "eventlog_v2_app-zstd"


def test_lineage_job_from_event_logs(spark, event_dir):
    """The end-to-end job writes lineage tables for every logged application."""
    from tracery.plans.jobs import lineage_from_event_logs

    work = tempfile.mkdtemp(prefix="tracery-job-")
    src, out = os.path.join(work, "src"), os.path.join(work, "out")
    spark.range(20).write.mode("overwrite").parquet(src)
    spark.read.parquet(src).write.mode("overwrite").parquet(out)
    paths = lineage_from_event_logs(spark, event_dir, os.path.join(work, "lineage"))
    io = spark.read.parquet(paths["job_io"])
    mine = io.filter(F.col("output_urns").contains(f"file:{out},"))
    assert mine.count() == 1
    assert mine.first().input_urns.count(f"file:{src},") == 2
    catalog = spark.read.parquet(paths["catalog"])
    assert catalog.groupBy("urn", "aspect_name").count().filter("count > 1").count() == 0
