"""Event logs derived from the fixture tables, as input of the event-log queries.

``encode_event_log`` writes logs whose plan nodes carry lineage metadata, as a
plan-capturing listener writes them; they read back exactly.
``encode_physical_log`` writes what Spark itself logs: physical node names,
plan strings, ``Location`` metadata, wrappers, redacted JDBC URLs, and the
queries of childless commands as executions of their own. This module is test
data: no product module needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracery.operators.extract import with_paths
from tracery.sources.eventlog import (EV_APP_END, EV_APP_START, EV_ENV, EV_SQL_START, KEY_APP_NAME, KEY_DEFAULT_FS, KEY_INPUT_NAME,
                                      KEY_MASTER, KEY_OUTPUT_NAME)


def app_id_of(app_name: Column) -> Column:
    """Application id used when logs are written from the fixture tables."""
    return F.concat(F.lit("local-"), F.substring(app_name, 5, 1 << 20))


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _object_with_children(head: Column, children: Column) -> Column:
    """``head`` is a JSON object text; append a ``children`` array of raw JSON."""
    return F.concat(F.regexp_replace(head, "}$", ""), F.lit(',"children":['), children, F.lit("]}"))


def captured_head() -> Column:
    """JSON text of a node with lineage metadata, without its children."""
    return F.to_json(F.struct(
        F.col("node_class").alias("nodeName"), F.col("node_class").alias("simpleString"),
        F.map_filter(F.create_map(
            F.lit("nodeId"), F.col("node_id").cast("string"), F.lit("edgeKind"), F.col("edge_kind"),
            F.lit("nodeClass"), F.col("node_class"), F.lit("relationClass"), F.col("relation_class"),
            F.lit("catalogDb"), F.col("catalog_db"), F.lit("catalogTable"), F.col("catalog_table"),
            F.lit("path"), F.col("path"), F.lit("paths"), F.to_json("paths"), F.lit("jdbcUrl"), F.col("jdbc_url"),
            F.lit("jdbcTable"), F.col("jdbc_table")), lambda k, v: v.isNotNull()).alias("metadata"),
    ))


def _dealt(frame: DataFrame, buckets: int | None) -> DataFrame:
    n = buckets or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(n, "execution_id")


def plan_json(nodes: DataFrame, buckets: int | None = None, written: list | None = None,
              head: Column | None = None) -> DataFrame:
    """``sparkPlanInfo`` text per execution, built bottom-up level by level.

    Depths come from a join loop from the roots; then each level's nodes
    embed their children's text, grouped by parent (bounded by fan-out). The
    nodes, which every level reads, are written bucketed by execution, so no
    level's text is shuffled; ``written`` gets that table, to be dropped. With
    ``head`` they are such a table already, and a node's text is made from its
    columns when its level embeds it.
    """
    from tracery.session import write_table

    keys = ["execution_id"]
    if head is None:
        nodes, head = write_table(nodes, "log_nodes", bucket_by="execution_id", buckets=buckets), F.col("head")
        if written is not None:
            written.append(nodes)
    level = nodes.filter(F.col("parent_id").isNull())
    levels = []
    while not level.isEmpty():
        levels.append(level)
        parents = level.select(*keys, F.col("node_id").alias("parent_id"))
        level = nodes.join(parents, [*keys, "parent_id"], "left_semi")
    text = None
    for level in reversed(levels):
        if text is None:
            text = level.select(*keys, "node_id", "parent_id",
                                _object_with_children(head, F.lit("")).alias("json"))
            continue
        kids = text.groupBy(*keys, "parent_id").agg(
            F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("node_id", "json"))),
                                         lambda x: x["json"])).alias("kids"))
        text = level.join(kids.withColumnRenamed("parent_id", "node_id"), [*keys, "node_id"], "left").select(
            *keys, "node_id", "parent_id",
            _object_with_children(head, F.coalesce("kids", F.lit(""))).alias("json"))
    return text.select(*keys, F.col("json").alias("plan_json"))


def _application_events(executions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Start, environment and end events of every application."""
    apps = executions.groupBy("app_name").agg(
        F.max("master").alias("master"), F.max("default_fs").alias("default_fs"),
        F.max("input_override").alias("input_override"), F.max("output_override").alias("output_override"),
        F.min("started_at").alias("t0"), F.max("started_at").alias("t1"),
    ).withColumn("app_id", app_id_of(F.col("app_name")))
    app_dir = F.concat(F.lit("eventlog_v2_"), F.col("app_id"))
    start = apps.select(app_dir.alias("app_dir"), F.to_json(F.struct(
        F.lit(EV_APP_START).alias("Event"), F.col("app_name").alias("App Name"), F.col("app_id").alias("App ID"),
        _millis(F.col("t0")).alias("Timestamp"), F.lit("spark").alias("User"))).alias("value"))
    props = F.map_filter(F.create_map(
        F.lit(KEY_MASTER), F.col("master"), F.lit(KEY_APP_NAME), F.col("app_name"),
        F.lit(KEY_INPUT_NAME), F.nullif(F.col("input_override"), F.lit("")),
        F.lit(KEY_OUTPUT_NAME), F.nullif(F.col("output_override"), F.lit(""))), lambda k, v: v.isNotNull())
    hadoop = F.map_filter(F.create_map(F.lit(KEY_DEFAULT_FS), F.col("default_fs")), lambda k, v: v.isNotNull())
    env = apps.select(app_dir.alias("app_dir"), F.to_json(F.struct(
        F.lit(EV_ENV).alias("Event"), props.alias("Spark Properties"), hadoop.alias("Hadoop Properties"))).alias("value"))
    end = apps.select(app_dir.alias("app_dir"), F.to_json(F.struct(
        F.lit(EV_APP_END).alias("Event"), _millis(F.col("t1")).alias("Timestamp"))).alias("value"))
    return start, env, end


def encode_event_log(executions: DataFrame, plan_nodes: DataFrame, buckets: int | None = None,
                     written: list | None = None) -> DataFrame:
    """Event lines (``app_dir``, ``value``) for executions and their plans, two
    tables bucketed by execution: lines are made in these buckets."""
    start, env, end = _application_events(executions)
    text = plan_json(with_paths(plan_nodes), head=captured_head())
    return start.unionByName(env).unionByName(_starts(executions, text)).unionByName(end)


def _starts(executions: DataFrame, plans: DataFrame) -> DataFrame:
    """Start events; ``root_execution_id`` and ``plan_description`` where the executions have them."""
    have = executions.columns
    root = F.col("root_execution_id") if "root_execution_id" in have else F.col("execution_id")
    told = F.col("plan_description") if "plan_description" in have else F.lit("")
    head = F.to_json(F.struct(
        F.lit(EV_SQL_START).alias("Event"), F.col("execution_id").alias("executionId"),
        root.alias("rootExecutionId"), F.col("description"),
        F.lit("").alias("details"), told.alias("physicalPlanDescription"),
        _millis(F.col("started_at")).alias("time")))
    body = F.when(F.col("plan_json").isNull(), head).otherwise(
        F.concat(F.regexp_replace(head, "}$", ""), F.lit(',"sparkPlanInfo":'), F.col("plan_json"), F.lit("}")))
    return executions.join(plans, "execution_id", "left").select(
        F.concat(F.lit("eventlog_v2_"), app_id_of(F.col("app_name"))).alias("app_dir"), body.alias("value"))


def write_event_log(lines: DataFrame, root: str) -> str:
    """One folder per application, like rolling event logs.

    A task writes the lines it has made, a file for each application among them:
    the lines of a bucket of executions, so no task holds a hot application whole,
    and no line is shuffled or made twice (ranges of lines need both). Files are
    compressed with gzip, which the text source reads.
    """
    lines.write.mode("overwrite").partitionBy("app_dir").option("compression", "gzip").text(root)
    return root




# Plan strings as Spark prints them.
_PROVIDER = "org.apache.spark.sql.execution.datasources.jdbc.JdbcRelationProvider@1"
#: Numbers of the executions that run a childless command's query.
QUERY_OF = 1_000_000_000
CHILDLESS = ("CreateHiveTableAsSelectCommand", "CreateDataSourceTableAsSelectCommand", "SaveIntoDataSourceCommand")


def _name(db: str = "catalog_db", table: str = "catalog_table") -> Column:
    return F.concat(F.lit("`spark_catalog`.`"), F.coalesce(db, F.lit("default")), F.lit("`.`"), F.col(table), F.lit("`"))


def physical_nodes(plan_nodes: DataFrame) -> DataFrame:
    """``execution_id, node_id, parent_id, head`` as Spark logs the nodes."""
    c, rel = F.col("node_class"), F.coalesce("relation_class", F.lit(""))
    table = F.concat_ws(".", F.lit("spark_catalog"), "catalog_db", "catalog_table")
    paths = F.coalesce(F.col("paths"), F.array("path"))
    location = F.concat(F.lit("InMemoryFileIndex("), F.size(paths).cast("string"), F.lit(" paths)["), F.array_join(paths, ", "), F.lit("]"))
    file = (c == "FileSourceScanExec") | ((c == "LogicalRelation") & (rel == "HadoopFsRelation"))
    jdbc = (c == "RowDataSourceScanExec") | ((c == "LogicalRelation") & (rel == "JDBCRelation"))
    name = (F.when(c.isin("InsertIntoHadoopFsRelationCommand", "InsertIntoHiveTable", *CHILDLESS), F.concat(F.lit("Execute "), c))
            .when(file, F.concat(F.lit("Scan parquet "), F.when(F.col("catalog_table").isNotNull(), table).otherwise(F.lit(""))))
            .when(jdbc, F.concat(F.lit("Scan JDBCRelation("), F.coalesce("jdbc_table", F.lit("(select 1) x")), F.lit(") [numPartitions=1]")))
            .when((c == "HiveTableRelation") | c.contains("HiveTableScanExec"), F.concat(F.lit("Scan hive "), table))
            .when(c.isin("InMemoryRelation", "InMemoryTableScanExec"), F.lit("InMemoryTableScan"))
            .when(c == "LocalTableScanExec", F.lit("LocalTableScan")).when(c == "Join", F.lit("SortMergeJoin")).otherwise(c))
    insert = F.concat(F.lit("Execute InsertIntoHadoopFsRelationCommand "), "path", F.lit(", false, Parquet, [path="), "path", F.lit("], Overwrite, "),
                      F.when(F.col("catalog_table").isNotNull(), F.concat(_name(), F.lit(", org.apache.spark.sql.execution.datasources."
                                                                                          "CatalogFileIndex@1, "))).otherwise(F.lit("")), F.lit("[id]"))
    simple = (F.when(c == "InsertIntoHadoopFsRelationCommand", insert)
              .when(c == "InsertIntoHiveTable", F.concat(F.lit("Execute InsertIntoHiveTable "), _name(), F.lit(", true, false, [id]"))).otherwise(name))
    meta = F.when(file, F.create_map(F.lit("Format"), F.lit("Parquet"), F.lit("Location"), location)).otherwise(
        F.create_map().cast("map<string,string>"))
    return with_paths(plan_nodes).select("execution_id", "node_id", "parent_id", F.to_json(F.struct(
        name.alias("nodeName"), simple.alias("simpleString"), meta.alias("metadata"))).alias("head"))


def encode_physical_log(executions: DataFrame, plan_nodes: DataFrame, buckets: int | None = None,
                        written: list | None = None) -> DataFrame:
    """Event lines (``app_dir``, ``value``) as Spark writes them for these plans."""
    nodes = with_paths(plan_nodes)
    commands = plan_nodes.filter((F.col("edge_kind") == "root") & F.col("node_class").isin(*CHILDLESS)).select(
        "execution_id", F.col("node_class").alias("command"), "catalog_db", "catalog_table", "jdbc_url", "jdbc_table")
    driver = F.when(F.col("jdbc_url").startswith("jdbc:sqlserver"), F.lit("com.microsoft.sqlserver.jdbc.SQLServerDriver")).otherwise(
        F.lit("com.mysql.cj.jdbc.Driver"))
    options = F.concat(F.lit("[url=*********(redacted)"), F.coalesce(F.concat(F.lit(", dbtable="), "jdbc_table"), F.lit("")),
                       F.lit(", driver="), driver, F.lit("]"))
    args = F.when(F.col("command") == CHILDLESS[2], F.concat(F.lit(_PROVIDER + ", "), options, F.lit(", Append"))).otherwise(
        F.concat(_name(table="catalog_table"), F.lit(", ErrorIfExists, [id]")))
    told = commands.select("execution_id", "command", F.concat(
        F.lit("== Physical Plan ==\nExecute "), "command", F.lit(" (1)\n   +- "), "command", F.lit(" (2)\n\n\n(1) Execute "), "command",
        F.lit("\nOutput: []\n\n(2) "), "command", F.lit("\nArguments: "), F.coalesce(args, F.lit("`spark_catalog`.`default`.`t`")), F.lit("\n\n")).alias("plan_description"))
    # The query of a childless command is an execution of its own, with the command as its root.
    query = executions.join(told.select("execution_id", "command"), "execution_id").select(
        *[c for c in executions.columns if c != "execution_id"], (F.col("execution_id") + QUERY_OF).alias("execution_id"),
        F.col("execution_id").alias("root_execution_id"), "command")
    read = F.to_json(F.struct(F.lit("DeserializeToObject").alias("nodeName"), F.lit("DeserializeToObject").alias("simpleString")))
    write = F.to_json(F.struct(F.lit("Execute InsertIntoHadoopFsRelationCommand").alias("nodeName"), F.lit(
        "Execute InsertIntoHadoopFsRelationCommand hdfs://prodcluster/tables/t, false, Parquet, [path=hdfs://prodcluster/tables/t], Overwrite, [id]"
    ).alias("simpleString")))
    heads = query.select("execution_id", F.lit(0).alias("node_id"), F.lit(None).cast("int").alias("parent_id"),
                         F.when(F.col("command") == CHILDLESS[2], read).otherwise(write).alias("head"))
    moved = nodes.filter("node_id > 0").join(told.select("execution_id"), "execution_id", "left_semi").withColumn(
        "execution_id", F.col("execution_id") + QUERY_OF)
    stay = nodes.join(told.select("execution_id"), "execution_id", "left_anti").unionByName(
        nodes.filter("node_id = 0").join(told.select("execution_id"), "execution_id", "left_semi"))
    every = executions.withColumn("root_execution_id", F.col("execution_id")).join(told.drop("command"), "execution_id", "left")
    every = every.unionByName(query.drop("command").withColumn("plan_description", F.lit(""))).withColumn(
        "plan_description", F.coalesce("plan_description", F.lit("")))
    # Scans stand under the wrappers of whole-stage code generation.
    # Nodes are dealt to their buckets before their long texts are made.
    logged = physical_nodes(_dealt(stay.unionByName(moved), buckets)).unionByName(_dealt(heads, buckets))
    text = plan_json(logged, buckets, written)
    start, env, end = _application_events(executions)
    return start.unionByName(env).unionByName(_starts(every, text)).unionByName(end)


#: Replayed files, one micro-batch each. A replay takes what has piled up: every
#: batch reads the plan tables and the catalog, so their number must not grow with
#: the events (a batch is a distributed job of any size).
REPLAY_FILES = 4
#: Start events per part of a replayed file, about.
ROWS_PER_PART = 250_000


def replay_files(events: DataFrame, folder: str, files: int = REPLAY_FILES, rows_per_part: int = ROWS_PER_PART) -> int:
    """Start events as JSON files in order of time; gives the files of one micro-batch.

    Spark cuts the ranges by rows, so equal times or a busy hour make no large
    file. Each range is a folder; the folders are then moved to ``folder`` one
    after another, since the file source reads files in the order of their times.
    """
    spark = events.sparkSession
    n = events.count()
    if not n:
        return 1
    parts = -(-n // (files * rows_per_part))
    files *= parts
    ranged = events.repartitionByRange(files, "started_at", "execution_id").withColumn("_range", F.spark_partition_id())
    drafts = f"{folder}-drafts"
    ranged.write.partitionBy("_range").json(drafts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(drafts).getFileSystem(conf)
    fs.mkdirs(Path(folder))
    now = jvm.System.currentTimeMillis()
    for k in range(files):
        source = Path(f"{drafts}/_range={k}")
        if fs.exists(source):
            for found in fs.listStatus(source):
                fs.setTimes(found.getPath(), now - 1000 * (files - k), -1)
            fs.rename(source, Path(f"{folder}/{k:06d}"))
    return parts
