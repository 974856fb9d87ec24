"""Logs of running, compacted and compressed applications, nested executions,
and the stream that follows growing logs."""

import glob
import json
import os
import tempfile

import pytest
import zstandard
from pyspark.sql import functions as F

from tracery.plans.jobs import lineage_from_event_logs
from tracery.plans.lineage import LineagePlan
from tracery.session import scratch_path
from tracery.sources import eventlog as EL
from tracery.streaming.incremental import ASPECTS
from tracery.streaming.log_stream import LogStream
from tracery.streaming.versions import Versions

COLS = "execution_id struct<app_key:string,execution_id:long>, node_id int, ordinal int, column_text string, data_type string"


def scan(path):
    return {"nodeName": "Scan parquet ", "simpleString": "FileScan parquet", "children": [], "metadata": {
        "Location": f"InMemoryFileIndex(1 paths)[{path}]"}}


def wrapped(node):
    return {"nodeName": "WholeStageCodegen (1)", "simpleString": "", "metadata": {}, "children": [
        {"nodeName": "ColumnarToRow", "simpleString": "", "metadata": {}, "children": [node]}]}


def insert(path, *kids):
    return {"nodeName": "Execute InsertIntoHadoopFsRelationCommand", "metadata": {}, "children": list(kids),
            "simpleString": f"Execute InsertIntoHadoopFsRelationCommand {path}, false, Parquet, [path={path}], Overwrite, [id]"}


def command(name):
    return {"nodeName": f"Execute {name}", "simpleString": f"Execute {name}", "children": [], "metadata": {}}


def start(number, plan, root=None, told="", at=None):
    return json.dumps({"Event": EL.EV_SQL_START, "executionId": number, "rootExecutionId": number if root is None else root,
                       "description": f"d{number}", "time": 1000 + (number if at is None else at),
                       "physicalPlanDescription": told, "sparkPlanInfo": plan})


def settings(app, name=None):
    return [json.dumps({"Event": EL.EV_APP_START, "App Name": name or app, "App ID": app, "Timestamp": 1, "User": "u"}),
            json.dumps({"Event": EL.EV_ENV, "Spark Properties": {"spark.master": "local"}, "Hadoop Properties": {"fs.defaultFS": "file:///"}})]


def save_args(driver, table="T9"):
    return ("== Physical Plan ==\nExecute SaveIntoDataSourceCommand (1)\n\n\n(1) Execute SaveIntoDataSourceCommand\nOutput: []\n\n"
            "(2) SaveIntoDataSourceCommand\nArguments: org.apache.spark.sql.execution.datasources.jdbc.JdbcRelationProvider@5f, "
            f"[url=*********(redacted), dbtable={table}, driver={driver}], Append\n\n")


def put(root, *parts, data, mode="wb"):
    path = os.path.join(root, *parts)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data)


def text(lines):
    return ("\n".join(lines) + "\n").encode()


def read(spark, root):
    return sorted((r.app_key, json.loads(r.json).get("executionId")) for r in EL.read_events(spark, root).collect()
                  if r.event == EL.EV_SQL_START)


def test_running_and_compacted_logs(spark):
    root = tempfile.mkdtemp(prefix="tracery-states-")
    many = [start(i, insert(f"file:/o{i}", scan(f"file:/i{i}"))) for i in range(400)]
    whole = zstandard.ZstdCompressor().compress(text(many))
    put(root, "done.zstd", data=whole)
    put(root, "twoframes.zstd", data=whole + zstandard.ZstdCompressor().compress(text(many[:3]).replace(b'"executionId": ', b'"executionId": 9')))
    put(root, "running.zstd.inprogress", data=whole)
    put(root, "plainrun.inprogress", data=text(many[:5]) + many[5][:40].encode())
    # An unfinished frame: flushed blocks are read, the open one is not.
    packer = zstandard.ZstdCompressor().compressobj()
    data = packer.compress(text(many[:100])) + packer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
    put(root, "open.zstd.inprogress", data=data + packer.compress(text(many[100:])))
    # A compacted file stands for itself and the files before it.
    put(root, "eventlog_v2_c", "events_1_c.zstd", data=zstandard.ZstdCompressor().compress(text(many[:10])))
    put(root, "eventlog_v2_c", "events_2_c.zstd.compact", data=zstandard.ZstdCompressor().compress(text(many[8:10])))
    put(root, "eventlog_v2_c", "events_3_c.zstd", data=zstandard.ZstdCompressor().compress(text(many[10:12])))
    put(root, "eventlog_v2_c", "appstatus_c.inprogress", data=b"")
    # Rolled files of a running application carry no state in their name.
    packer = zstandard.ZstdCompressor().compressobj()
    put(root, "eventlog_v2_c", "events_4_c.zstd", data=packer.compress(text(many[20:30])) + packer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK))
    got = {}
    for app, number in read(spark, root):
        got.setdefault(app, []).append(number)
    every = list(range(400))
    assert got["done"] == every and got["running"] == every
    assert sorted(got["twoframes"]) == sorted(every + [90, 91, 92])
    assert got["plainrun"] == every[:5]
    assert 100 <= len(got["open"]) < 400 and got["open"] == every[:len(got["open"])]
    assert got["eventlog_v2_c"] == [8, 9, 10, 11, *range(20, 30)]
    unread = {os.path.basename(r.path): r.n_lines for r in EL.unread_lines(EL.read_lines(spark, root)).collect()}
    # The last lines of what is still written to.
    assert unread["plainrun.inprogress"] == 1 and set(unread) <= {"plainrun.inprogress", "open.zstd.inprogress"}
    damaged = tempfile.mkdtemp(prefix="tracery-damaged-")
    put(damaged, "finished.zstd", data=whole[:-500])
    with pytest.raises(Exception, match="finished.zstd"):
        read(spark, damaged)
    put(root, "other.lz4.inprogress", data=b"x")
    with pytest.raises(ValueError, match="other.lz4.inprogress"):
        EL.read_events(spark, root)


def test_long_compressed_log_in_many_pieces(spark):
    """More splits than one, with newline bytes at any place of the compressed data."""
    root = tempfile.mkdtemp(prefix="tracery-pieces-")
    rng = __import__("random").Random(1)
    lines = [start(i, insert(f"file:/o{rng.random()}", scan(f"file:/i{rng.random()}"))) for i in range(3000)]
    for k in range(4):
        put(root, f"app{k}.zstd{'.inprogress' * (k > 0)}", data=zstandard.ZstdCompressor(level=1 + k).compress(text(lines[k:])))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read(spark, root)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"app{k}", i) for k in range(4) for i in range(k, 3000))


TREE = [
    *settings("tree"),
    # A top execution of another kind, the CTAS below it, and the CTAS's own write with the scan.
    start(4, command("SaveAsV1TableCommand")),
    start(5, command("CreateDataSourceTableAsSelectCommand"), 4, "\n(2) CreateDataSourceTableAsSelectCommand\nArguments: `spark_catalog`.`default`.`t2`, ErrorIfExists, [id]\n"),
    start(6, insert("file:/wh/t2", wrapped(scan("file:/src"))), 4),
    start(10, command("SaveIntoDataSourceCommand"), None, save_args("com.microsoft.sqlserver.jdbc.SQLServerDriver", "dbo.T9")),
    start(11, {"nodeName": "DeserializeToObject", "simpleString": "", "metadata": {}, "children": [wrapped(scan("file:/a")), scan("file:/b")]}, 10),
    start(20, command("SaveIntoDataSourceCommand"), None, save_args("com.example.Unknown")),
    start(30, command("CreateHiveTableAsSelectCommand"), None, "\n(2) CreateHiveTableAsSelectCommand\nArguments: `spark_catalog`.`sales`.`orders`, ErrorIfExists, [id]\n"),
    start(31, insert("file:/wh/orders", scan("file:/raw")), 30),
    start(32, insert("file:/wh/orders2", scan("file:/raw2")), 30),
    start(40, insert("file:/out", scan("file:/in"))),
]


def job_rows(frame):
    return {r.job_urn.split("ExecutionId_")[1][:-1]: (r.input_urns, r.output_urns) for r in frame.collect()}


def file_urn(path):
    return f"urn:li:dataset:(urn:li:dataPlatform:hdfs,file:{path},PROD)"


def test_nested_executions_stand_under_their_command(spark):
    root = tempfile.mkdtemp(prefix="tracery-tree-")
    put(root, "eventlog_v2_tree", "events_1_tree", data=text(TREE))
    executions, nodes, _ = EL.keyed(EL.lineage_tables(spark, root))
    plan = LineagePlan(executions, nodes, spark.createDataFrame([], COLS), listener=("app_key",))
    got = job_rows(plan.job_io)
    # Data-source CTAS: no output, inputs by the plan walk. Hive CTAS: both walks.
    assert got["5"] == (file_urn("/src"), "")
    assert got["30"] == ("|".join([file_urn("/raw"), file_urn("/raw2")] * 2), "urn:li:dataset:(urn:li:dataPlatform:hive,sales.orders,PROD)")
    # JDBC save: an inner query, platform by driver.
    assert got["10"] == ("|".join([file_urn("/a"), file_urn("/b")]), "urn:li:dataset:(urn:li:dataPlatform:mssql,dbo.T9,PROD)")
    assert got["40"] == (f"{file_urn('/in')}|{file_urn('/in')}", file_urn("/out"))
    assert set(got) == {"5", "10", "30", "40"}
    assert [r.execution_id.execution_id for r in plan.failed.collect()] == [20]


def test_ctas_in_this_sessions_own_log(spark, event_dir):
    work = tempfile.mkdtemp(prefix="tracery-ctas-")
    spark.range(9).write.parquet(f"{work}/src")
    spark.read.parquet(f"{work}/src").write.option("path", f"{work}/tbl").saveAsTable("tracery_ctas_of_this_test")
    tables = EL.lineage_tables(spark, event_dir)
    executions, nodes, _ = EL.keyed(tables)
    plan = LineagePlan(executions, nodes, spark.createDataFrame([], COLS), listener=("app_key",))
    mine = [r for r in plan.job_io.collect() if f"file:{work}/src," in r.input_urns]
    assert [(r.input_urns, r.output_urns) for r in mine] == [(file_urn(f"{work}/src"), "")]


def catalog(frame):
    return sorted((r.urn, r.aspect_name, r.aspect) for r in frame.collect())


def test_followed_logs_equal_the_batch_job(spark):
    root = tempfile.mkdtemp(prefix="tracery-follow-")
    stream = LogStream(spark, root, scratch_path(spark, "follow"))
    stream.versions.vacuum = lambda keep=2: None
    name = ("eventlog_v2_tree", "events_1_tree")
    assert not stream.poll(0)
    put(root, *name, data=text(TREE[:4]) + TREE[4][:50].encode())
    assert stream.poll(1) and not stream.poll(2)
    # The running log grows in the middle of a line; a query arrives after its command.
    put(root, *name, data=TREE[4][50:].encode() + b"\n" + text(TREE[5:]), mode="ab")
    # Settings that arrive after the first start, in another file.
    late = [start(1, insert("file:/late", scan("file:/src")))]
    put(root, "eventlog_v2_late", "events_1_late", data=text(late))
    assert stream.poll(3)
    assert not [r for r in stream.result().collect() if "file:/late" in r.aspect]
    put(root, "eventlog_v2_late", "events_2_late", data=text(settings("late")))
    assert stream.poll(4)
    out = tempfile.mkdtemp(prefix="tracery-batch-")
    paths = lineage_from_event_logs(spark, root, out)
    assert catalog(stream.result()) == catalog(spark.read.parquet(paths["catalog"]))
    log = stream.result("emit_log")
    assert log.groupBy("epoch").count().filter(f"count <> {len(ASPECTS)}").isEmpty()
    assert log.filter("outcome <> 'success'").isEmpty()
    assert log.agg(F.sum("n")).first()[0] >= stream.result().count()
    # A retried poll gives the same version; an earlier one is still whole.
    earlier = stream.versions.manifest(below=4)
    before = catalog(stream.versions.read("catalog", earlier))
    now = catalog(stream.result())
    assert stream.poll(4) and catalog(stream.result()) == now
    assert catalog(stream.versions.read("catalog", earlier)) == before and before != now


def test_a_run_again_leaves_no_stale_job(spark):
    """The same application in a second log: fewer executions than before."""
    root = tempfile.mkdtemp(prefix="tracery-again-")
    stream = LogStream(spark, root, scratch_path(spark, "again"))
    put(root, "run1", data=text([*settings("a1", "app"), *[start(i, insert(f"file:/o{i}", scan("file:/s"))) for i in range(6)]]))
    assert stream.poll(0)
    put(root, "run2", data=text([*settings("a2", "app"), *[start(i, insert(f"file:/n{i}", scan("file:/s")), at=500 + i) for i in range(2)]]))
    assert stream.poll(1)
    jobs = {r.urn: r.aspect for r in stream.result().filter("aspect_name = 'dataJobInputOutput'").collect()}
    assert len(jobs) == 2 and all("file:/n" in x for x in jobs.values())
    # Both runs in one poll.
    both = LogStream(spark, root, scratch_path(spark, "both"))
    assert both.poll(0)
    assert {r.urn: r.aspect for r in both.result().filter("aspect_name = 'dataJobInputOutput'").collect()} == jobs


def test_a_poll_deals_plans_by_execution_once(spark, monkeypatch):
    """The folding and the lineage job read buckets: no plan is shuffled for their joins."""
    root = tempfile.mkdtemp(prefix="tracery-dealt-")
    put(root, "run", data=text([*settings("a"), *[start(i, insert(f"file:/o{i}", scan("file:/s"))) for i in range(4)]]))
    stream, seen = LogStream(spark, root, scratch_path(spark, "dealt")), []
    apply, folded = stream.sink.apply, EL.folded

    def shuffled(frames, *by):
        for frame in frames:
            seen.append("hashpartitioning" in frame.groupBy(*by).count()._jdf.queryExecution().executedPlan().toString())

    def joined(executions, nodes):
        shuffled((executions, nodes), "app_key", "execution_id")
        return folded(executions, nodes)

    def applied(executions, nodes, columns, *rest, **more):
        shuffled((executions, nodes, columns), "execution_id")
        apply(executions, nodes, columns, *rest, **more)

    monkeypatch.setattr(EL, "folded", joined)
    monkeypatch.setattr(stream.sink, "apply", applied)
    tables = {r.tableName for r in spark.sql("show tables").collect()}
    assert stream.poll(0) and seen == [False] * 5
    assert stream.result().filter("aspect_name = 'dataJobInputOutput'").count() == 4
    assert {r.tableName for r in spark.sql("show tables").collect()} <= tables


def test_a_reader_sees_one_version(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    rows = lambda n, v: spark.createDataFrame([(k, v) for k in range(n)], "k long, v string")
    for version, n in ((0, 8), (1, 4)):
        before = store.manifest(below=version)
        frame = rows(n, f"v{version}")
        staged = store.stage(version, "t", frame, F.col("k").cast("int"))
        if version:  # data of the new version is there, and no reader sees it
            assert {r.v for r in store.read("t").collect()} == {"v0"}
        store.commit(version, before, {"t": (frame, staged, [])})
    assert sorted((r.k, r.v) for r in store.read("t").collect()) == [(k, "v1" if k < 4 else "v0") for k in range(8)]
    assert [r.k for r in store.read("t", buckets=[5]).collect()] == [5]
    # A failed version: data without a manifest is never read, and is replaced when it is run again.
    store.stage(2, "t", rows(8, "broken"), F.col("k").cast("int"))
    assert {r.v for r in store.read("t").collect()} == {"v0", "v1"}
    before = store.manifest(below=2)
    store.commit(2, before, {"t": (rows(1, "x"), store.stage(2, "t", rows(8, "v2"), F.col("k").cast("int")), [])})
    store.vacuum(keep=1)
    assert {r.v for r in store.read("t").collect()} == {"v2"} and store.numbers() == [2]
    assert len(glob.glob(store.folder.removeprefix("file:") + "/t/*")) == 1


def test_a_failed_write_is_logged(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tracery-fail-")
    put(root, "run", data=text([*settings("a"), start(1, insert("file:/o", scan("file:/s")))]))
    stream = LogStream(spark, root, scratch_path(spark, "fail"))
    with monkeypatch.context() as m:
        m.setattr(stream.sink, "_upsert", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream.poll(0)
    assert stream.result() is None
    failed = spark.read.parquet(f"{stream.versions.folder}/failed_writes").collect()
    assert {r.aspect_name for r in failed} == set(ASPECTS) and all(r.outcome.startswith("error: division") for r in failed)
    assert stream.poll(0) and stream.result().count() == 5


def test_clock_stream_follows(spark):
    """Versions go on after a restart of the query."""
    root = tempfile.mkdtemp(prefix="tracery-clock-")
    state, checkpoint = scratch_path(spark, "clock"), scratch_path(spark, "clock-checkpoint")
    for run in (1, 2):
        put(root, f"run{run}", data=text([*settings(f"a{run}", f"app{run}"), start(1, insert(f"file:/o{run}", scan("file:/s")))]))
        stream = LogStream(spark, root, state)
        query = stream.start(checkpoint, "1 second")
        try:
            for _ in range(240):
                found = stream.result()
                if found is not None and not found.filter(F.col("aspect").contains(f"file:/o{run}")).isEmpty():
                    break
                assert query.exception() is None
                query.awaitTermination(0.5)
        finally:
            query.stop()
    assert stream.result().filter("aspect_name = 'dataJobInputOutput'").count() == 2
