"""Spark event logs -> lineage input tables.

An event-log folder holds one entry per application: a file (single log)
or a folder (rolling log). Every line is one JSON event. The reader keeps
the application key from the file path, parses the event name once with
``get_json_object`` and only then applies ``from_json`` to the events it
needs:

* S1 ``SQLExecutionStart`` -> executions, with the application's settings;
* S2 ``ApplicationStart`` -> app id, name, time, user;
* S3 ``ApplicationEnd`` -> time;
* S6 ``EnvironmentUpdate`` -> ``(key, value)`` session settings;
* S5 ``sparkPlanInfo`` -> ``plan_nodes`` rows, one per plan node.

Logs of running applications (``.inprogress``) and compacted ones
(``.compact``) are read like finished ones, plain or zstd-compressed; of a
running one, what its last frame holds so far. Decompression is a stream in
Python, some KB of text at a time. Files that end in ``.zstd`` come as binary
files (at most 2 GB each; Spark rolls logs at 128 MB), since the text source
would split them. Another ending after the codec's hides it from the text
source, which cuts the compressed bytes at newlines; a task puts a file's
pieces together in order, so those have no size limit. Logs in another codec
are named in an error, as are damaged logs of finished applications; lines
that are no event are counted by ``unread_lines``.

The plan tree is nested JSON: it is parsed once, with its event, and ``plan_walk``
numbers its nodes in the event's own row, each with its preorder id and nearest
kept ancestor. Nodes carrying lineage metadata
(``nodeClass`` etc., as a plan-capturing listener writes them) are taken as
is; plain physical plans are mapped by node name (best effort, see
``PHYSICAL_NAMES``).

CTAS and JDBC-save commands log no children: their query runs as a later
execution of the same root execution. ``folded`` puts such executions' plans
under their command, so the command's job has the inputs.
"""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracery.sources.plan_walk import node_rows, numbered_nodes, outer_fields, plan_type

# Event names as written by Spark.
EV_SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
EV_APP_START = "SparkListenerApplicationStart"
EV_APP_END = "SparkListenerApplicationEnd"
EV_ENV = "SparkListenerEnvironmentUpdate"

# Session settings the lineage rules read.
KEY_MASTER = "spark.master"
KEY_APP_NAME = "spark.app.name"
KEY_DEFAULT_FS = "fs.defaultFS"
KEY_INPUT_NAME = "spark.hdfs.ingestion.input.path"
KEY_OUTPUT_NAME = "spark.hdfs.ingestion.output.path"

START_SCHEMA = ("executionId long, rootExecutionId long, description string, physicalPlanDescription string, "
                f"time long, sparkPlanInfo {plan_type()}")

APP_START_SCHEMA = T.StructType([
    T.StructField("App Name", T.StringType()),
    T.StructField("App ID", T.StringType()),
    T.StructField("Timestamp", T.LongType()),
    T.StructField("User", T.StringType()),
])

ENV_SCHEMA = T.StructType([
    T.StructField("Spark Properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Hadoop Properties", T.MapType(T.StringType(), T.StringType())),
])

NODE_COLS = ("execution_id", "node_id", "parent_id", "edge_kind", "node_class", "relation_class",
             "catalog_db", "catalog_table", "path", "paths", "jdbc_url", "jdbc_table")


def _ts(ms: Column) -> Column:
    """Event milliseconds as UTC wall-clock time (timestamp without zone)."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


# File-name endings of event logs. The last two may follow a codec's.
COMPRESSED_SUFFIX = ".zstd"
OTHER_SUFFIXES = (".lz4", ".lzf", ".snappy")
STATE_SUFFIXES = (".inprogress", ".compact")
_STATE = r"(\.inprogress|\.compact)+$"
# The events the lineage job needs, and those of an application as a whole.
KINDS = (EV_SQL_START, EV_APP_START, EV_APP_END, EV_ENV)
APP_KINDS = (EV_APP_START, EV_APP_END, EV_ENV)
# Decompressed text per output batch, and compressed bytes taken at once.
LINES_BYTES, PIECE_BYTES = 4 << 20, 1 << 16


class _Frames:
    """Decompresses a file's bytes, given in order, whose last frame may be unfinished."""

    def __init__(self):
        import zstandard

        self.new = zstandard.ZstdDecompressor().decompressobj
        self.now, self.tail = self.new(), b""

    def feed(self, data: bytes) -> list[bytes]:
        """The lines that are complete with ``data``."""
        out = []
        while data:
            if self.now.eof:
                self.now = self.new()
            out.append(self.now.decompress(data))
            data = self.now.unused_data if self.now.eof else b""
        *lines, self.tail = b"".join([self.tail, *out]).split(b"\n")
        return lines

    def end(self) -> list[bytes]:
        """What is left: a last newline byte of the file was cut off with its row."""
        import zstandard

        lines = []
        if not self.now.eof:
            try:
                lines = self.feed(b"\n")
            except zstandard.ZstdError:  # it was not part of the frame
                pass
        return [*lines, self.tail] if self.tail else lines


def _decompressed(batches):
    """``path, value`` lines of zstd files from their pieces, in order, which were
    cut at newlines. ``whole`` files must end with a complete frame."""
    import pyarrow as pa

    path, frames, lines, size, last, whole = None, None, [], 0, b"", False

    def batch(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(found), pa.string()), pa.array([x.decode("utf-8", "replace") for x in found], pa.string())],
            names=["path", "value"])

    def rest():
        if whole and not frames.now.eof:
            raise ValueError(f"event log of a finished application ends within a frame: {path}")
        return batch(lines + frames.end())

    for b in batches:
        for p, ends, piece in zip(b.column("path").to_pylist(), b.column("whole").to_pylist(), b.column("piece")):
            if p != path:
                if frames is not None:
                    yield rest()
                path, frames, lines, size, last, whole = p, _Frames(), [], 0, b"", ends
            piece = memoryview(piece.as_buffer())
            for at in range(0, max(len(piece), 1), PIECE_BYTES):
                found = frames.feed(last + piece[at:at + PIECE_BYTES])
                last = b""
                lines += found
                size += sum(map(len, found))
                if size >= LINES_BYTES:
                    yield batch(lines)
                    lines, size = [], 0
            last = b"\n"
    if frames is not None:
        yield rest()


def _superseded(paths: list[str]) -> list[str]:
    """Rolled files whose events a compacted file of the same log already holds."""
    number = re.compile(r"^(.*)/events_(\d+)_[^/]*$")
    compacted: dict[str, int] = {}
    rolled = [(p, m[1], int(m[2])) for p in paths if (m := number.match(p))]
    for p, folder, n in rolled:
        if p.endswith(".compact"):
            compacted[folder] = max(n, compacted.get(folder, 0))
    return [p for p, folder, n in rolled if n < compacted.get(folder, 0) or (n == compacted.get(folder) and not p.endswith(".compact"))]


def _folders(path: str) -> int:
    """Number of path components below the file system's root. A relative
    path is taken below the driver's working folder, as Spark's local files are."""
    if not re.match(r"^([A-Za-z][A-Za-z0-9+.-]*:|/)", path):
        path = os.path.abspath(path)
    return len([p for p in re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).split("/") if p])


def read_lines(spark: SparkSession, root: str | list[str], below: str | None = None) -> DataFrame:
    """``app_key, path, value``: every line of the logs below ``root``.

    ``root`` may be a list of files of a log folder ``below``, which may all be
    written to. One listing serves plain and compressed logs. The application
    key is the path's first component below the folder, without the endings of
    a file's state and codec.
    """

    files = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root)
    paths = files.inputFiles()
    for path in paths:
        if re.sub(_STATE, "", path).endswith(OTHER_SUFFIXES):
            raise ValueError(f"event log in a codec that is not read: {path}")
    old = ["/".join(p.rsplit("/", 2)[-2:]) for p in _superseded(paths)]
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    gone = F.concat_ws("/", F.slice(F.split(path, "/"), -2, 2)).isin(old)
    packed = name.rlike(rf"\{COMPRESSED_SUFFIX}{_STATE}")
    # All filters are on file metadata, so each branch opens its own files only.
    plain = files.filter(~gone & ~packed & ~name.endswith(COMPRESSED_SUFFIX)).select(path.alias("path"), "value")
    pieces = files.filter(~gone & packed).select(
        path.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
        F.lit(False).alias("whole"), F.col("value").cast("binary").alias("piece"))
    # A compressed stream is sequential: one log is one task's, a piece at a time.
    kind = "path string, value string"
    columns = ["path", "whole", "piece"]
    found = plain.unionByName(pieces.repartition("path").sortWithinPartitions("path", "start", "at").select(*columns).mapInArrow(
        _decompressed, kind))
    if any(p.endswith(COMPRESSED_SUFFIX) for p in paths):
        # Rolled files of running applications are told by their folder's status file.
        running = {m[1] for p in paths if (m := re.search(r"([^/]+)/appstatus_[^/]*\.inprogress$", p))}
        closed = F.lit(below is None) & ~F.element_at(F.split("path", "/"), -2).isin(sorted(running))
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*" + COMPRESSED_SUFFIX)
                 .load(root).filter(~F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).isin(old)))
        found = found.unionByName(files.select("path", closed.alias("whole"), F.col("content").alias("piece")).mapInArrow(
            _decompressed, kind))
    steps = F.filter(F.split(F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/"), lambda p: p != "")
    entry = F.get(steps, F.lit(_folders(below if below is not None else root)))
    return found.select(
        F.regexp_replace(entry, r"(\.zstd|\.inprogress|\.compact)+$", "").alias("app_key"), "path", "value")


def events_of(lines: DataFrame) -> DataFrame:
    """The needed events of some lines: ``app_key, event, json``."""
    return lines.select(
        "app_key",
        F.get_json_object("value", "$.Event").alias("event"),
        F.col("value").alias("json"),
    ).filter(F.col("event").isin(*KINDS))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """The needed event lines with the application key and event name."""
    return events_of(read_lines(spark, root))


def unread_lines(lines: DataFrame) -> DataFrame:
    """``path, n_lines``: how many non-empty lines of each file are no event
    (damaged ones, or the unfinished last line of a running application)."""
    event = F.get_json_object("value", "$.Event")
    return lines.filter(event.isNull() & (F.col("value") != "")).groupBy("path").agg(F.count(F.lit(1)).alias("n_lines"))


def written_events(spark: SparkSession, root: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``read_events`` parsed once: written by kind, so each consumer reads only its
    own. Only the ``kinds`` that will be asked for are written: start events hold
    the plans, nearly the whole log."""
    from tracery.session import scratch_path

    path = scratch_path(spark, "events")
    events = read_events(spark, root).select("app_key", "json", "event").filter(F.col("event").isin(*kinds))
    events.write.partitionBy("event").parquet(path)
    return spark.read.schema(events.schema).parquet(path)


def app_starts(events: DataFrame) -> DataFrame:
    """``app_key, app_id, app_name, time, user``."""
    e = events.filter(F.col("event") == EV_APP_START).select(
        "app_key", F.from_json("json", APP_START_SCHEMA).alias("e"))
    return e.select("app_key", F.col("e.`App ID`").alias("app_id"), F.col("e.`App Name`").alias("app_name"),
                    _ts(F.col("e.Timestamp")).alias("time"), F.col("e.User").alias("user"))


def app_ends(events: DataFrame) -> DataFrame:
    """S3: ``app_key, time``."""
    ts = F.get_json_object("json", "$.Timestamp").cast("bigint")
    return events.filter(F.col("event") == EV_APP_END).select("app_key", _ts(ts).alias("time"))


def session_settings(events: DataFrame) -> DataFrame:
    """One row per Spark property, plus the default filesystem."""
    env = events.filter(F.col("event") == EV_ENV).select("app_key", F.from_json("json", ENV_SCHEMA).alias("e"))
    spark_props = env.select("app_key", F.explode("e.`Spark Properties`").alias("key", "value"))
    hadoop = env.select("app_key", F.lit(KEY_DEFAULT_FS).alias("key"),
                        F.col("e.`Hadoop Properties`").getItem(KEY_DEFAULT_FS).alias("value"))
    return spark_props.unionByName(hadoop.filter(F.col("value").isNotNull()))


def sql_starts(events: DataFrame) -> DataFrame:
    """Start events, each parsed once; ``nodes``: its plan's (``plan_walk``), null without a plan."""
    e = events.filter(F.col("event") == EV_SQL_START).select(
        "app_key", F.from_json("json", START_SCHEMA).alias("e"))
    plan = F.col("e.sparkPlanInfo")
    return e.select("app_key", F.col("e.executionId").alias("execution_id"),
                    F.col("e.rootExecutionId").alias("root_execution_id"),
                    F.col("e.description").alias("description"), _ts(F.col("e.time")).alias("started_at"),
                    F.when(plan.isNotNull(), numbered_nodes(plan)).alias("nodes"),
                    _nonempty(F.regexp_extract("e.physicalPlanDescription", COMMAND_ARGS, 1)).alias("command_args"))


#: Applications whose settings, one short row each, are sent to every task.
BROADCAST_APPS = 50_000


def applications(events: DataFrame) -> DataFrame:
    """S2 + S6: ids, names and settings of the applications. Settings are pivoted
    per application with a grouped aggregate (one row per application)."""
    settings = session_settings(events).groupBy("app_key").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(a) for k, a in (
            (KEY_MASTER, "master"), (KEY_DEFAULT_FS, "default_fs"),
            (KEY_INPUT_NAME, "input_override"), (KEY_OUTPUT_NAME, "output_override"))]
    )
    return app_starts(events).select("app_key", "app_id", "app_name").join(settings, "app_key", "full")


def sql_executions(starts: DataFrame, per_app: DataFrame) -> DataFrame:
    """S1 + S6: executions with the settings of their application. Where the
    applications are too many to be sent to every task, a hot application's
    start events are split by AQE's skew join."""
    return (
        starts.drop("nodes").join(per_app, "app_key", "left")
        .select("execution_id", "app_name", "master", "description", "started_at", "default_fs",
                F.coalesce("input_override", F.lit("")).alias("input_override"),
                F.coalesce("output_override", F.lit("")).alias("output_override"),
                "app_id", "app_key", "root_execution_id")
    )


# Physical node names -> (tracked class, relation class) for
# plans without lineage metadata (best effort; event logs hold the physical
# plan, not the optimized logical one).
FILE_SCANS = tuple(f"Scan {kind}" for kind in ("parquet", "orc", "csv", "json", "text", "avro"))
PHYSICAL_NAMES = (
    (("Execute InsertIntoHadoopFsRelationCommand",), "InsertIntoHadoopFsRelationCommand", None),
    (("Execute InsertIntoHiveTable",), "InsertIntoHiveTable", None),
    (("Execute CreateHiveTableAsSelectCommand",), "CreateHiveTableAsSelectCommand", None),
    (("Execute CreateDataSourceTableAsSelectCommand",), "CreateDataSourceTableAsSelectCommand", None),
    (("Execute SaveIntoDataSourceCommand",), "SaveIntoDataSourceCommand", None),
    (("Scan hive ",), "HiveTableRelation", None),
    (("Scan JDBCRelation",), "LogicalRelation", "JDBCRelation"),
    (FILE_SCANS, "LogicalRelation", "HadoopFsRelation"),
    (("InMemoryTableScan",), "InMemoryRelation", None),
)


# Commands that log no children; their arguments stand in the plan's description.
COMMANDS = ("CreateHiveTableAsSelectCommand", "CreateDataSourceTableAsSelectCommand", "SaveIntoDataSourceCommand")
COMMAND_ARGS = rf"\n\(\d+\) (?:{'|'.join(COMMANDS)})\s*\nArguments: ([^\n]*)"
# JDBC platform by the beginning of the driver's class; URLs are redacted in logs.
DRIVERS = (
    ("com.mysql.", "mysql"),
    ("org.mariadb.", "mariadb"),
    ("org.postgresql.", "postgresql"),
    ("com.microsoft.sqlserver.", "sqlserver"),
    ("oracle.", "oracle"),
    ("com.ibm.db2.", "db2"),
    ("org.apache.derby.", "derby"),
    ("org.h2.", "h2"),
    ("com.teradata.", "teradata"),
    ("net.snowflake.", "snowflake"),
    ("com.databricks.", "databricks"),
    ("org.apache.hive.", "hive2"),
)


# Leaves of a cached physical plan keep their exec class.
CACHED_EXEC_NAMES = (
    (("Scan JDBCRelation",), "RowDataSourceScanExec"),
    (("Scan hive ",), "HiveTableScanExec"),
    (FILE_SCANS, "FileSourceScanExec"),
    (("InMemoryTableScan",), "InMemoryTableScanExec"),
    (("LocalTableScan",), "LocalTableScanExec"),
)


def _begins(name: Column, beginnings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [name.startswith(x) for x in beginnings])


def _by_name(name: Column, rows: list[tuple]) -> Column:
    """The value of the first row whose beginnings the name has."""
    return F.coalesce(*[F.when(_begins(name, beginnings), F.lit(value).cast("string")) for beginnings, value in rows])


# Stands for root paths that the event log does not print.
UNLISTED = "(more paths, not in the event log)"


def _count(location: Column) -> Column:
    return F.regexp_extract(location, r"\((\d+) paths?\)", 1).cast("int")


def _listed(location: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(location, r"\[(.*?)\]?$", 1), r",\s*"), lambda p: (p != "") & ~p.endswith("..."))


def _told(listed: Column, count: Column) -> Column:
    return F.when(F.size(listed) < count, F.concat(listed, F.array(F.lit(UNLISTED)))).otherwise(listed)


def _location_paths(meta: Column) -> Column:
    """Root paths of a file scan: ``Location: InMemoryFileIndex(2 paths)[p, q]``.

    Spark shortens long lists; where fewer paths are printed than the count
    says, the list ends with ``UNLISTED``, so a missing path is seen.
    """
    location = meta.getItem("Location")
    told = _told(_listed(location), _count(location))
    return F.when(F.size(told) > 0, told)


def plan_nodes(starts: DataFrame) -> DataFrame:
    """One row per node of the plans (``plan_walk``) of ``sql_starts``."""
    return _node_rows(node_rows(starts.filter(F.col("nodes").isNotNull())))


def _node_rows(nodes: DataFrame) -> DataFrame:
    """Lineage columns from walked nodes: metadata first, else node names. What
    several columns need is a step before them, so that it is made once."""
    meta, name, simple = F.col("meta"), F.col("node_name"), F.col("simple")
    location = meta.getItem("Location")
    said = nodes.select("*", _count(location).alias("n_paths"), _listed(location).alias("listed"),
                        F.coalesce(meta.getItem("path"), _sink_path(simple)).alias("one"))
    located = said.withColumn("located", F.when(location.isNotNull(), _told(F.col("listed"), F.col("n_paths"))))
    found = located.withColumn("paths", F.coalesce(
        F.from_json(meta.getItem("paths"), "array<string>"), F.when(F.size("located") > 0, F.col("located")),
        F.when(F.col("one").isNotNull(), F.array("one"))))
    cls = F.when(F.col("in_cache"), F.coalesce(_by_name(name, CACHED_EXEC_NAMES), _physical_class(name))).otherwise(_physical_class(name))
    edge = F.coalesce(
        meta.getItem("edgeKind"),
        F.when(F.col("parent_id").isNull(), F.lit("root"))
        .when(F.col("in_cache"), F.lit("cached"))
        .otherwise(F.lit("child")),
    )
    jdbc_scan = F.when(name.startswith("Scan JDBCRelation("), _nonempty(F.regexp_extract(
        name, r"^Scan JDBCRelation\((.+)\)(?: \[numPartitions=\d+\])?\s*$", 1)))
    return found.select(
        "execution_id", "node_id", "parent_id",
        edge.alias("edge_kind"),
        F.coalesce(meta.getItem("nodeClass"), cls).alias("node_class"),
        F.coalesce(meta.getItem("relationClass"), _by_name(name, [(b, rel) for b, _, rel in PHYSICAL_NAMES if rel])).alias("relation_class"),
        F.coalesce(meta.getItem("catalogDb"), _catalog_part(1)).alias("catalog_db"),
        F.coalesce(meta.getItem("catalogTable"), _catalog_part(2)).alias("catalog_table"),
        F.get("paths", F.lit(0)).alias("path"),
        "paths",
        F.coalesce(meta.getItem("jdbcUrl"), _saved_url()).alias("jdbc_url"),
        F.coalesce(meta.getItem("jdbcTable"), jdbc_scan, _saved_option("dbtable")).alias("jdbc_table"),
        "app_key", "node_name", meta.getItem("ReadSchema").alias("read_schema"),
    )


def _physical_class(name: Column) -> Column:
    return F.coalesce(_by_name(name, [(b, cls) for b, cls, _ in PHYSICAL_NAMES]), F.regexp_extract(name, r"^(?:Execute )?(\w+)", 1))


def scan_columns(nodes: DataFrame) -> DataFrame:
    """Columns of file scans, from their logged ``ReadSchema``. A schema that
    Spark shortened in the log is left out, as its columns are not known."""
    known = nodes.filter(F.col("read_schema").startswith("struct<") & F.col("read_schema").endswith(">")
                         & ~F.col("read_schema").contains("...") & (F.length("read_schema") > 8))
    fields = known.select("app_key", "execution_id", "node_id", F.posexplode(outer_fields(F.col("read_schema"))).alias("ordinal", "field"))
    name = F.substring_index("field", ":", 1)
    return fields.filter(F.col("field").contains(":")).select(
        "app_key", "execution_id", "node_id", "ordinal", name.alias("column_text"),
        F.col("field").substr(F.length(name) + 2, F.length("field")).alias("data_type"))


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def _catalog_part(group: int) -> Column:
    """Catalog identifier of a scan (``Scan parquet spark_catalog.db.t``) or
    of a sink (`` `spark_catalog`.`db`.`t` `` in its plan string)."""
    scan = F.when(F.col("node_name").startswith("Scan "), F.regexp_extract(
        F.col("node_name"), r"^Scan \w+ (?:spark_catalog\.)?([^.\s]+)\.([^.\s]+)$", group))
    sink = F.when(F.col("simple").startswith("Execute "), F.regexp_extract(
        F.col("simple"), r"^Execute \w+ .*`spark_catalog`\.`([^`]+)`\.`([^`]+)`", group))
    made = F.regexp_extract(F.col("command_args"), r"^`spark_catalog`\.`([^`]+)`\.`([^`]+)`", group)
    return F.coalesce(_nonempty(scan), _nonempty(sink), _nonempty(made))


def _saved_option(name: str) -> Column:
    """An option of a save command's logged arguments ``Provider@1, [a=x, b=y], Mode``."""
    return F.when(F.col("command_args").isNotNull(), _nonempty(F.regexp_extract(
        F.col("command_args"), rf"[\[ ]{name}=(.*?)(?:, \w+=|\])", 1)))


def _saved_url() -> Column:
    """The URL of a save command if it is logged, else one that names the driver's platform."""
    url, driver = _saved_option("url"), F.lower(_saved_option("driver"))
    platform = F.coalesce(*[F.when(driver.startswith(c), F.lit(p)) for c, p in DRIVERS])
    return F.when(F.col("command_args").isNotNull(), F.coalesce(
        F.when(~url.contains("(redacted)"), url), F.concat(F.lit("jdbc:"), platform, F.lit(":(redacted)"))))


def _sink_path(simple: Column) -> Column:
    """Output path of a file insert: first argument in its plan string."""
    return F.when(simple.startswith("Execute InsertIntoHadoopFsRelationCommand "), _nonempty(F.regexp_extract(
        simple, r"^Execute InsertIntoHadoopFsRelationCommand ([^,]+),", 1)))


def folded(executions: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Executions and nodes with the query executions of childless commands
    put under their command (the tree of ``rootExecutionId``).

    Spark links every nested execution to the top one. Within one top execution
    a command of ``COMMANDS`` without logged children takes the executions after
    it, up to the next such command; their nodes follow its own, in order. A
    JDBC save's query is an inner child, which the plan walk does not enter.
    An execution that was taken has no job of its own. The third table tells
    those; it is written once, dealt like the nodes, and read by the others.
    Nodes that stay are not moved between partitions.
    """
    from tracery.session import write_table

    key, top = ["app_key", "execution_id"], ["app_key", "root_execution_id"]
    plans = nodes.groupBy(*key).agg((F.max("node_id") + 1).alias("size"), F.max(F.col("parent_id").isNotNull()).alias("nested"))
    roots = nodes.filter(F.col("parent_id").isNull() & F.col("node_class").isin(*COMMANDS)).select(
        "app_key", "execution_id", F.col("node_class").alias("command"))
    alone = roots.join(plans.filter("nested").select(*key), key, "left_anti")
    keyed = executions.filter(F.col("root_execution_id").isNotNull()).select(*top, "execution_id").join(
        alone, ["app_key", "execution_id"], "left")
    # Only top executions with such a command and more executions than it.
    several = keyed.groupBy(*top).agg(F.count("command").alias("commands"), F.count(F.lit(1)).alias("n")).filter("commands > 0 and n > 1")
    order = Window.partitionBy(*top).orderBy("execution_id")
    taken = keyed.join(several.select(*top), top, "left_semi").select(
        "app_key", "execution_id", "command",
        F.last(F.when(F.col("command").isNotNull(), F.struct(F.col("execution_id").alias("id"), "command")), True).over(order).alias("owner"))
    taken = taken.filter("command is null and owner is not null").select(
        "app_key", "execution_id", F.col("owner.id").alias("owner"), F.col("owner.command").alias("owner_command"))
    columns, n = getattr(nodes, "dealt", (None, None))
    taken = write_table(taken.repartition(n, *columns) if n else taken, "event_taken", columns, n)
    sizes = plans.select(*key, "size")
    place = Window.partitionBy("app_key", "owner").orderBy("execution_id").rowsBetween(Window.unboundedPreceding, -1)
    # The command itself is node 0 of its plan.
    moved = taken.join(sizes, ["app_key", "execution_id"]).withColumn(
        "offset", (F.coalesce(F.sum("size").over(place), F.lit(0)) + 1).cast("int"))
    inner = F.when(F.col("owner_command") == "SaveIntoDataSourceCommand", F.lit("inner_query")).otherwise(F.lit("child"))
    # A taken write command is its owner's own write: its children hang from the owner.
    writes = nodes.filter(F.col("parent_id").isNull() & (F.col("node_class").endswith("Command") | (F.col("node_class") == "InsertIntoHiveTable")))
    moved = moved.join(writes.select("app_key", "execution_id", F.col("node_id").alias("write")), ["app_key", "execution_id"], "left")
    below = nodes.join(moved.drop("size"), ["app_key", "execution_id"]).filter("write is null or node_id <> write").select(
        "app_key", F.col("owner").alias("execution_id"), (F.col("node_id") + F.col("offset")).alias("node_id"),
        F.when(F.col("parent_id") != F.coalesce("write", F.lit(-1)), F.col("parent_id") + F.col("offset")).otherwise(0).alias("parent_id"),
        F.when(F.col("edge_kind").isin("root", "child"), inner).otherwise(F.col("edge_kind")).alias("edge_kind"),
        *[c for c in nodes.columns if c not in ("app_key", "execution_id", "node_id", "parent_id", "edge_kind")])
    below = below.select(*nodes.columns)
    gone = taken.select("app_key", "execution_id")
    kept = nodes.join(gone, ["app_key", "execution_id"], "left_anti").select(*nodes.columns)
    return executions.join(gone, ["app_key", "execution_id"], "left_anti").select(*executions.columns), \
        kept.unionByName(below.repartition(n, *columns) if n else below), taken


def tables_of(events: DataFrame, buckets: int | None = None,
              by: str | list[str] = "execution_id") -> dict[str, DataFrame]:
    """Executions and plan nodes of some events, with nested executions folded.

    Both are written once: every step of a lineage job reads them, and plans
    are not parsed again for each. With ``buckets`` they are bucketed by execution
    id, for logs that do not repeat ids across applications, or by the columns
    ``by``. What only leads to them is deleted.
    """
    from tracery.session import delete_path, drop_written, scratch_path, write_table

    spark, folder = events.sparkSession, scratch_path(events.sparkSession, "event-tables")

    def cut(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    def last(frame: DataFrame, name: str, deal: bool = False) -> DataFrame:
        if not buckets:
            return cut(frame, name)
        columns = [by] if isinstance(by, str) else by
        return write_table(frame.repartition(buckets, *columns) if deal else frame, f"event_{name.replace('-', '_')}", by, buckets)

    # Start events are parsed and dealt once, a plan as one row. What follows reads
    # the buckets: no node is shuffled but those that the folding moves.
    starts = last(sql_starts(events), "starts", deal=True)
    per_app = cut(applications(events), "applications")
    few = per_app.count() <= BROADCAST_APPS
    every = last(sql_executions(starts, F.broadcast(per_app) if few else per_app), "all-executions", deal=not few)
    parsed = last(plan_nodes(starts), "all-nodes")
    executions, nodes, taken = folded(every, parsed)
    tables = {"events": events, "executions": last(executions, "executions"), "plan_nodes": last(nodes, "nodes")}
    drop_written([taken])
    if buckets:
        drop_written([starts, every, parsed])
        delete_path(spark, f"{folder}/applications")
    else:
        for name in ("starts", "applications", "all-executions", "all-nodes"):
            delete_path(spark, f"{folder}/{name}")
    return tables


def lineage_tables(spark: SparkSession, root: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Executions and plan nodes read back from an event-log folder."""
    return tables_of(written_events(spark, root), buckets)


def keyed(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Executions, nodes and scan columns of a fleet, keyed by application and
    execution, since event logs repeat execution numbers across applications;
    the logged number is the job number."""
    key = F.struct("app_key", "execution_id")
    executions = tables["executions"].select(
        key.alias("execution_id"), F.col("execution_id").alias("job_number"), "app_key",
        "app_name", "master", "description", "started_at", "default_fs", "input_override", "output_override")
    nodes = tables["plan_nodes"].withColumn("execution_id", key).select(*NODE_COLS)
    return executions, nodes, scan_columns(tables["plan_nodes"]).withColumn("execution_id", key).drop("app_key")
