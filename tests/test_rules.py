"""N1-N10 and T1 on literal rows; expected values written by hand from the rules."""

import datetime as dt

from pyspark.sql import functions as F

from tracery.functions import rules as R


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_qualified_name(spark):
    got = one(spark, R.qualified_name("db", "t"), [("d1", "t1"), ("", "t2"), (None, "t3")], "db string, t string")
    assert got == ["d1.t1", "t2", "t3"]


def test_jdbc_platform(spark):
    urls = [("jdbc:sqlserver://;serverName=h",), ("jdbc:mysql://h:3306/db",), ("jdbc:",), ("nocolon",),
            ("jdbc::x",), (None,), ("jdbc:postgresql:",)]
    got = one(spark, R.jdbc_platform("u"), urls, "u string")
    assert got == ["mssql", "mysql", None, None, "", None, "postgresql"]


def test_hive_name_from_path(spark):
    paths = [("hdfs://c/warehouse/hive/x.db/t",), ("hdfs://c/warehouse/hive/salesdb.db/t5",),
             ("hdfs://c/archive/d3/t5",), ("hive",), ("hdfs://c/hive/db/t/",), ("a/b",)]
    got = one(spark, R.hive_name_from_path("p"), paths, "p string")
    assert got == ["x.t", "sales.t5", "d3t5", None, "t", "ab"]


def test_path_kind_and_override(spark):
    assert one(spark, R.path_is_hive("p"), [("/archive/x",), ("/data/x",)], "p string") == [True, False]
    got = one(spark, R.name_override("o", "p"), [("", "/p1"), ("/in/", "/p2"), (None, "/p3")], "o string, p string")
    assert got == ["/p1", "/in/", "/p3"]


def test_output_column_name(spark):
    got = one(spark, R.output_column_name("c"), [("c1#12",), ("a#1#2",), ("plain",)], "c string")
    assert got == ["c1", "a", "plain"]


def test_environment(spark):
    got = one(spark, R.environment("fs"), [("hdfs://stagcluster",), ("hdfs://prod",), (None,)], "fs string")
    assert got == ["DEV", "PROD", None]


def test_urns(spark):
    df = spark.createDataFrame([("app_1", "local[2]", 7)], "a string, m string, n long")
    flow = R.flow_urn("a", "m")
    row = df.select(flow.alias("f"), R.job_urn(flow, "n").alias("j"),
                    R.dataset_urn(F.lit("hdfs"), F.lit("/x"), F.lit("PROD")).alias("d")).first()
    assert row.f == "urn:li:dataFlow:(spark,app_1,local[2])"
    assert row.j == "urn:li:dataJob:(urn:li:dataFlow:(spark,app_1,local[2]),ExecutionId_7)"
    assert row.d == "urn:li:dataset:(urn:li:dataPlatform:hdfs,/x,PROD)"


def test_start_time_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    assert df.select(R.start_time_text("ts")).first()[0] == "Tue Jan 02 03:04:05 UTC 2024"


def test_type_map(spark):
    names = ["void", "date", "interval", "timestamp", "tinyint", "binary", "boolean", "int", "bigint",
             "double", "float", "smallint", "string", "decimal(12,2)", "array<int>", None]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    got = [(r[0], r[1]) for r in df.select(R.field_type("t"), R.native_type("t")).collect()]
    assert got == [
        ("NullType", "Null"), ("DateType", "Date"), ("DateType", "Calendar"), ("TimeType", "Timestamp"),
        ("BytesType", "Byte"), ("BytesType", "Binary"), ("BooleanType", "Boolean"), ("NumberType", "Integer"),
        ("NumberType", "Long"), ("NumberType", "Double"), ("NumberType", "Float"), ("NumberType", "Short"),
        ("StringType", "String"), ("NullType", "New Column"), ("NullType", "New Column"),
        ("NullType", "New Column"),
    ]


def test_entity_type(spark):
    got = one(spark, R.entity_type("u"), [("urn:li:dataJob:(x)",), ("urn:li:dataset:(y)",)], "u string")
    assert got == ["dataJob", "dataset"]
