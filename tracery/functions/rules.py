"""Scalar lineage rules as Spark Column expressions.

Every rule is a built-in expression, so it stays inside whole-stage codegen;
none needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for right results).
# ---------------------------------------------------------------------------

# plan classes whose nodes are examined (the root gate uses the same set).
TRACKED_CLASSES = (
    "SaveIntoDataSourceCommand",
    "CreateDataSourceTableAsSelectCommand",
    "CreateHiveTableAsSelectCommand",
    "InsertIntoHiveTable",
    "HiveTableRelation",
    "LogicalRelation",
    "InsertIntoHadoopFsRelationCommand",
    "InMemoryRelation",
)

# Tracked sink commands that have an output branch and walk their query.
QUERY_SINKS = (
    "InsertIntoHadoopFsRelationCommand",
    "SaveIntoDataSourceCommand",
    "InsertIntoHiveTable",
    "CreateHiveTableAsSelectCommand",
)

# Tracked classes that are relations met by the plan walk.
RELATION_CLASSES = ("HiveTableRelation", "LogicalRelation", "InMemoryRelation")

# Spark type name -> (catalog field type, native type name).
TYPE_MAP = (
    ("void", "NullType", "Null"),
    ("date", "DateType", "Date"),
    ("interval", "DateType", "Calendar"),
    ("timestamp", "TimeType", "Timestamp"),
    ("tinyint", "BytesType", "Byte"),
    ("binary", "BytesType", "Binary"),
    ("boolean", "BooleanType", "Boolean"),
    ("int", "NumberType", "Integer"),
    ("bigint", "NumberType", "Long"),
    ("double", "NumberType", "Double"),
    ("float", "NumberType", "Float"),
    ("smallint", "NumberType", "Short"),
    ("string", "StringType", "String"),
)
UNKNOWN_TYPE = ("NullType", "New Column")

# Default-filesystem substrings that mark a development environment.
DEV_MARKERS = ("stag",)

# JDBC sub-protocol renamed to its platform name.
PLATFORM_RENAMES = (("sqlserver", "mssql"),)

JOB_TYPE = "sparkJob"
FILE_PLATFORM = "hdfs"
HIVE_PLATFORM = "hive"

# F5 failure reasons, in the order the reference meets them within one node.
FAIL_NO_DEFAULT_FS = "missing default filesystem"
FAIL_SAVE_NO_URL = "jdbc save without url"
FAIL_SAVE_NO_TABLE = "jdbc save without dbtable"
FAIL_URL_NO_PLATFORM = "jdbc url without platform"
FAIL_OUTPUT_NO_EXPR_ID = "output column without expression id"
FAIL_READ_NO_TABLE = "jdbc read without dbtable"
FAIL_HIVE_PATH_SHORT = "hive path with fewer than two segments"

# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qualified_name(db: Column | str, table: Column | str) -> Column:
    """``db.table`` when the database is set, else ``table``."""
    return F.concat_ws(".", F.nullif(_col(db), F.lit("")), _col(table))


def jdbc_platform(url: Column | str) -> Column:
    """Second ``:``-separated part of a JDBC URL; null when missing.

    Trailing separators are dropped first, as a Java split does.
    """
    parts = F.split(F.regexp_replace(_col(url), ":+$", ""), ":")
    raw = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(2)))
    out = raw
    for src, dst in PLATFORM_RENAMES:
        out = F.when(raw == F.lit(src), F.lit(dst)).otherwise(out)
    return out


def path_is_hive(path: Column | str) -> Column:
    """Substring test, so ``/archive/`` counts as a Hive path."""
    return _col(path).contains("hive")


def hive_name_from_path(path: Column | str) -> Column:
    """segment[-2] with every ``db`` removed, joined to segment[-1].

    Null when the path has fewer than two segments (the reference fails).
    """
    segs = F.split(F.regexp_replace(_col(path), "/+$", ""), "/")
    return F.when(
        F.size(segs) >= 2,
        F.concat(F.replace(F.try_element_at(segs, F.lit(-2)), F.lit("db"), F.lit("")), F.try_element_at(segs, F.lit(-1))),
    )


def name_override(override: Column | str, path: Column | str) -> Column:
    """Configured name when not empty, else the path."""
    return F.coalesce(F.nullif(_col(override), F.lit("")), _col(path))


def output_column_name(text: Column | str) -> Column:
    """Attribute text up to the first ``#``."""
    return F.substring_index(_col(text), "#", 1)


def has_expr_id(text: Column | str) -> Column:
    return F.instr(_col(text), "#") > 0


def environment(default_fs: Column | str, markers: tuple[str, ...] = DEV_MARKERS) -> Column:
    """DEV when the default filesystem holds a marker, else PROD."""
    fs = _col(default_fs)
    is_dev = F.lit(False)
    for m in markers:
        is_dev = is_dev | fs.contains(m)
    return F.when(fs.isNull(), F.lit(None).cast("string")).when(is_dev, "DEV").otherwise("PROD")


def dataset_urn(platform: Column | str, name: Column | str, env: Column | str) -> Column:
    """N8."""
    return F.concat(
        F.lit("urn:li:dataset:(urn:li:dataPlatform:"), _col(platform), F.lit(","),
        _col(name), F.lit(","), _col(env), F.lit(")"),
    )


def flow_urn(app_name: Column | str, master: Column | str) -> Column:
    """Flow of an application."""
    return F.concat(F.lit("urn:li:dataFlow:(spark,"), _col(app_name), F.lit(","), _col(master), F.lit(")"))


def job_urn(flow: Column, job_number: Column | str) -> Column:
    """Job of one SQL execution within a flow."""
    return F.concat(
        F.lit("urn:li:dataJob:("), flow, F.lit(",ExecutionId_"), _col(job_number).cast("string"), F.lit(")")
    )


def platform_urn(platform: Column | str) -> Column:
    return F.concat(F.lit("urn:li:dataPlatform:"), _col(platform))


def start_time_text(ts: Column | str) -> Column:
    """Java ``Date.toString`` of the event time, zone pinned to UTC."""
    return F.date_format(_col(ts), "EEE MMM dd HH:mm:ss 'UTC' yyyy")


def entity_type(urn: Column | str) -> Column:
    """Entity type named in a URN."""
    return F.regexp_extract(_col(urn), r"^urn:li:(\w+):", 1)


def _type_lookup(position: int) -> Column:
    pairs = []
    for row in TYPE_MAP:
        pairs += [F.lit(row[0]), F.lit(row[position])]
    return F.create_map(*pairs)


def field_type(data_type: Column | str) -> Column:
    """Catalog field type; unknown or missing types map to NullType."""
    return F.coalesce(F.try_element_at(_type_lookup(1), _col(data_type)), F.lit(UNKNOWN_TYPE[0]))


def native_type(data_type: Column | str) -> Column:
    """Native type name; unknown or missing types give ``New Column``."""
    return F.coalesce(F.try_element_at(_type_lookup(2), _col(data_type)), F.lit(UNKNOWN_TYPE[1]))
