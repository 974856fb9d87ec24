"""Walks, gates and records on hand-built plans (expected values by hand)."""

import datetime as dt

import pytest

from tracery.plans.lineage import LineagePlan

EX = "execution_id long, app_name string, master string, description string, started_at timestamp_ntz, " \
     "default_fs string, input_override string, output_override string"
NODES = "execution_id long, node_id int, parent_id int, edge_kind string, node_class string, " \
        "relation_class string, catalog_db string, catalog_table string, path string, jdbc_url string, " \
        "jdbc_table string"
COLS = "execution_id long, node_id int, ordinal int, column_text string, data_type string"
T0 = dt.datetime(2020, 1, 1)
FS = "hdfs://prod"


def ex(i, fs=FS, inp="", out=""):
    return (i, "app", "local[1]", f"job {i}", T0 + dt.timedelta(minutes=i), fs, inp, out)


def n(e, i, parent, edge, cls, rel=None, db=None, tbl=None, path=None, url=None, jt=None):
    return (e, i, parent, edge, cls, rel, db, tbl, path, url, jt)


def urn(platform, name):
    return f"urn:li:dataset:(urn:li:dataPlatform:{platform},{name},PROD)"


@pytest.fixture(scope="module")
def plan(spark):
    executions = [ex(i) for i in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15)] + [ex(3, fs=None), ex(14, fs=None)]
    nodes = [
        # 1: file sink; file relation seen by both walks, Hive relation, cached file scan, a join
        n(1, 0, None, "root", "InsertIntoHadoopFsRelationCommand", path="hdfs://p/out/a"),
        n(1, 1, 0, "child", "LogicalRelation", "HadoopFsRelation", path="hdfs://p/data/x.csv"),
        n(1, 2, 0, "child", "HiveTableRelation", db="d", tbl="t"),
        n(1, 3, 0, "child", "InMemoryRelation"),
        n(1, 103, 3, "cached", "FileSourceScanExec", "HadoopFsRelation", path="hdfs://p/c.csv"),
        n(1, 4, 0, "child", "Join"),
        # 2: JDBC save without dbtable
        n(2, 0, None, "root", "SaveIntoDataSourceCommand", url="jdbc:mysql://h/db"),
        # 3: no default filesystem
        n(3, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        # 4: JDBC read without dbtable under a Hive insert
        n(4, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        n(4, 1, 0, "child", "LogicalRelation", "JDBCRelation", url="jdbc:mysql://h/db"),
        # 5: untracked root
        n(5, 0, None, "root", "GlobalLimit"),
        n(5, 1, 0, "child", "LogicalRelation", "HadoopFsRelation", path="hdfs://p/z"),
        # 6: data-source CTAS: no output; catalog table under a Hive path yields its name twice
        n(6, 0, None, "root", "CreateDataSourceTableAsSelectCommand"),
        n(6, 1, 0, "child", "LogicalRelation", "HadoopFsRelation", db="w", tbl="v",
          path="hdfs://p/warehouse/hive/w.db/v"),
        # 7: JDBC save; its query is seen by the query walk only
        n(7, 0, None, "root", "SaveIntoDataSourceCommand", url="jdbc:sqlserver://;serverName=h", jt="x.dbo.y"),
        n(7, 1, 0, "inner_query", "LogicalRelation", "JDBCRelation", url="jdbc:mysql://h/db", jt="s.t"),
        n(7, 2, 0, "inner_query", "HiveTableRelation", db="d", tbl="hidden"),
        # 8: file sink output attribute without expression id
        n(8, 0, None, "root", "InsertIntoHadoopFsRelationCommand", path="hdfs://p/out/b"),
        # 9: read-only root
        n(9, 0, None, "root", "HiveTableRelation", db="r", tbl="o"),
        # 10: nested cache under a Hive insert
        n(10, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="n"),
        n(10, 1, 0, "child", "InMemoryRelation"),
        n(10, 101, 1, "cached", "InMemoryTableScanExec"),
        n(10, 201, 101, "cached", "FileSourceScanExec", "HadoopFsRelation", path="hdfs://p/nested"),
        n(10, 102, 1, "cached", "LocalTableScanExec"),
        # 11: JDBC save without url
        n(11, 0, None, "root", "SaveIntoDataSourceCommand", jt="a.b"),
        # 12: JDBC read whose url has no platform part
        n(12, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        n(12, 1, 0, "child", "LogicalRelation", "JDBCRelation", url="nocolon", jt="s.t"),
        # 13: Hive path (substring test) with fewer than two segments
        n(13, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        n(13, 1, 0, "child", "LogicalRelation", "HadoopFsRelation", path="hive"),
        # 14: no default filesystem comes first, before a node failure
        n(14, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        n(14, 1, 0, "child", "LogicalRelation", "JDBCRelation", url="jdbc:mysql://h/db"),
        # 15: two failing nodes: the query walk meets node 1 first
        n(15, 0, None, "root", "InsertIntoHiveTable", db="d", tbl="o"),
        n(15, 1, 0, "child", "LogicalRelation", "HadoopFsRelation", path="hive"),
        n(15, 2, 0, "child", "LogicalRelation", "JDBCRelation", url="jdbc:mysql://h/db"),
    ]
    cols = [
        (1, 0, 0, "a#1", None), (1, 0, 1, "b#2", None),
        (1, 1, 0, "a", "string"), (1, 1, 1, "x", "bigint"),
        (1, 2, 0, "a", "int"),
        (1, 103, 0, "c", "double"),
        (8, 0, 0, "plain", None),
    ]
    return LineagePlan(spark.createDataFrame(executions, EX), spark.createDataFrame(nodes, NODES),
                       spark.createDataFrame(cols, COLS))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_root_gate(plan):
    assert {r.execution_id for r in plan.tracked.collect()} == {1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15}


def test_failures(plan):
    assert rows(plan.failed, "execution_id", "fail_reason") == [
        (2, "jdbc save without dbtable"),
        (3, "missing default filesystem"),
        (4, "jdbc read without dbtable"),
        (8, "output column without expression id"),
        (11, "jdbc save without url"),
        (12, "jdbc url without platform"),
        (13, "hive path with fewer than two segments"),
        (14, "missing default filesystem"),
        (15, "hive path with fewer than two segments"),
    ]


def test_job_io(plan):
    got = {r.execution_id: (r.input_urns, r.output_urns) for r in plan.job_io.collect()}
    assert set(got) == {1, 6, 7, 9, 10}
    assert got[1] == ("|".join([urn("hdfs", "hdfs://p/data/x.csv"), urn("hdfs", "hdfs://p/data/x.csv"),
                                urn("hive", "d.t"), urn("hdfs", "hdfs://p/c.csv")]),
                      urn("hdfs", "hdfs://p/out/a"))
    assert got[6] == (urn("hive", "w.v") + "|" + urn("hive", "w.v"), "")
    assert got[7] == (urn("mysql", "s.t"), urn("mssql", "x.dbo.y"))
    assert got[9] == (urn("hive", "r.o"), "")
    assert got[10] == (urn("hdfs", "hdfs://p/nested"), urn("hive", "d.n"))


def test_schema_records(plan):
    assert rows(plan.column_types.filter("execution_id = 1"), "column_name", "data_type") == [
        ("a", "int"), ("c", "double"), ("x", "bigint")]
    assert rows(plan.file_dataset_columns.filter("execution_id = 1"), "dataset", "ordinal", "column_name") == [
        ("hdfs://p/c.csv", 0, "c"), ("hdfs://p/data/x.csv", 0, "a"), ("hdfs://p/data/x.csv", 1, "x"),
        ("hdfs://p/out/a", 0, "a"), ("hdfs://p/out/a", 1, "b")]
    fields = rows(plan.schema_fields.filter("dataset = 'hdfs://p/out/a'"), "field_path", "field_type", "native_type")
    assert fields == [("a", "NumberType", "Integer"), ("b", "NullType", "New Column")]


def test_first_event_and_aspects(plan):
    assert rows(plan.first_events, "app_name", "execution_id") == [("app", 1)]
    names = rows(plan.aspects.filter("execution_id = 1"), "emit_seq", "aspect_name")
    assert names == [(1, "datasetProperties"), (1, "datasetProperties"), (1, "datasetProperties"),
                     (2, "schemaMetadata"), (2, "schemaMetadata"), (2, "schemaMetadata"),
                     (3, "dataFlowInfo"), (4, "dataJobInfo"), (5, "dataJobInputOutput")]
    info = plan.aspects.filter("execution_id = 7 and aspect_name = 'dataJobInfo'").first().aspect
    assert info == ('{"name":"job 7","type":"sparkJob","customProperties":{"startedAt":'
                    '"Wed Jan 01 00:07:00 UTC 2020","appId":"7","appName":"app"}}')
