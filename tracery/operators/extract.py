"""Dataset extraction: sinks (O1-O6) and scans.

The reference walks each plan object in driver memory. Here a plan is a set
of ``plan_nodes`` rows keyed by ``execution_id``, and each walk is a join or
filter over those rows:

* query walk (I1, ``pass`` 0): for a sink root, every ``LogicalRelation``
  below it (``child`` and ``inner_query`` edges);
* plan walk (I2, ``pass`` 1): every tracked relation in the tree proper
  (``root`` and ``child`` edges);
* cached plans (I9-I11): leaves reached through ``cached`` edges from a
  visited in-memory relation, found by pointer doubling.

Visit order is carried as ``(pass, node_id, leaf_id, sub)``; node ids are
preorder positions, so ordering by them reproduces the walk order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracery.functions import rules as R
from tracery.operators.gates import KEY, NODE_ATTRS, PASS_SINK

FILE_SINK = "InsertIntoHadoopFsRelationCommand"
JDBC_SINK = "SaveIntoDataSourceCommand"
HIVE_SINKS = ("InsertIntoHiveTable", "CreateHiveTableAsSelectCommand")
CACHE_CLASS = "InMemoryRelation"
SCAN_LEAVES = ("FileSourceScanExec", "RowDataSourceScanExec")
HIVE_SCAN_MARK = "HiveTableScanExec"

# Rounds of pointer doubling; node ids are 32-bit, so more can only be a cycle of parent ids.
MAX_ROUNDS = 32

VISIT_COLS = (KEY, "pass", "node_id", "leaf_id", "node_class", *NODE_ATTRS,
              "env", "input_override", "col_node")


def with_paths(plan_nodes: DataFrame) -> DataFrame:
    """``paths``: all root paths of a file relation; one if only ``path`` is given."""
    if "paths" in plan_nodes.columns:
        return plan_nodes
    return plan_nodes.withColumn("paths", F.when(F.col("path").isNotNull(), F.array("path")))


def direct_visits(tracked: DataFrame, plan_nodes: DataFrame) -> DataFrame:
    """I1 + I2: relation visits of the query walk and of the plan walk.

    A ``LogicalRelation`` under a file or Hive sink is met by both walks and
    so appears twice, as in the reference.
    """
    roots = tracked.select(KEY, "root_class", "env", "input_override")
    nodes = plan_nodes.filter(
        F.col("edge_kind").isin("root", "child", "inner_query")
        & F.col("node_class").isin(*R.RELATION_CLASSES)
    ).select(KEY, "node_id", "edge_kind", "node_class", *NODE_ATTRS)
    in_query_walk = (
        F.col("root_class").isin(*R.QUERY_SINKS)
        & F.col("edge_kind").isin("child", "inner_query")
        & (F.col("node_class") == "LogicalRelation")
    )
    in_plan_walk = F.col("edge_kind").isin("root", "child")
    passes = F.filter(F.array(F.when(in_query_walk, F.lit(0)), F.when(in_plan_walk, F.lit(1))),
                      lambda p: p.isNotNull())
    return (
        nodes.join(roots, KEY, "inner")
        .select("*", F.explode(passes).alias("pass"))
        .withColumn("leaf_id", F.lit(-1))
        .withColumn("col_node", F.col("node_id"))
        .select(*VISIT_COLS)
    )


def cached_leaves(visits: DataFrame, plan_nodes: DataFrame, checkpoint: bool = True,
                  buckets: int | None = None, written: list | None = None) -> DataFrame:
    """I9 + I10: leaves of the cached plans of visited in-memory relations.

    An ``InMemoryTableScanExec`` leaf stands for another cached relation; its
    ``cached`` children are that relation's plan, so a leaf's owner is the first
    node above it that no ``cached`` edge leads to. Owners are found by pointer
    doubling over the ``cached`` subset of ``plan_nodes``: every node points at
    its parent, and each round at what its pointer's node points at, so a chain
    of n levels takes log2(n) rounds. A round is one join of that subset, bucketed
    like the inputs, and is written once. Leaves are nodes without ``cached``
    children.
    """
    cached = plan_nodes.filter(F.col("edge_kind") == "cached").select(
        KEY, "parent_id", "node_id", "node_class", *NODE_ATTRS
    )

    def cut(frame: DataFrame, name: str) -> DataFrame:
        if not checkpoint:
            return frame
        # The cached edges are a small slice of plan_nodes that every round
        # joins: written once instead of rescanning plan_nodes.
        from tracery.session import write_table

        table = write_table(frame, name, bucket_by=KEY, buckets=buckets)
        if written is not None:
            written.append(table)
        return table

    cached = cut(cached, "cached_edges")
    up = cached.select(KEY, "node_id", F.col("parent_id").alias("owner"))
    for _ in range(MAX_ROUNDS):
        over = up.select(KEY, F.col("node_id").alias("owner"), F.col("owner").alias("next"))
        jumped = cut(up.join(over, [KEY, "owner"], "left").select(
            KEY, "node_id", F.coalesce("next", "owner").alias("owner"), F.col("next").isNotNull().alias("moved")), "cached_owners")
        up = jumped.select(KEY, "node_id", "owner")
        if jumped.filter("moved").isEmpty():
            break
    else:
        raise ValueError("cached plans nest without end: parent ids form a cycle")
    owners = visits.filter((F.col("pass") == 1) & (F.col("node_class") == CACHE_CLASS)).select(
        KEY, F.col("node_id").alias("owner"), "env", "input_override"
    )
    parents = cached.select(KEY, F.col("parent_id").alias("node_id")).distinct()
    return (
        cached.drop("parent_id").join(parents, [KEY, "node_id"], "left_anti")
        .join(up, [KEY, "node_id"], "inner")
        .join(owners, [KEY, "owner"], "inner")
        .select(
            KEY, F.lit(1).alias("pass"), F.col("owner").alias("node_id"), F.col("node_id").alias("leaf_id"),
            "node_class", *NODE_ATTRS, "env", "input_override", F.col("node_id").alias("col_node"),
        )
        .select(*VISIT_COLS)
    )


def relation_items(visits: DataFrame) -> DataFrame:
    """What each visited relation or cached leaf yields.

    ``sub`` 0 is the catalog name (Hive relation, catalog table of a logical
    relation, cached Hive scan); ``sub`` 1 the base relation (first file root
    path or JDBC table), 2 and up a file relation's further root paths, in
    their order. Each item may add an input dataset, record the relation's
    schema (I12), remember file columns (A3) or fail the execution (F5).
    """
    cls = F.col("node_class")
    catalog_item = (
        ((cls == "LogicalRelation") & F.col("catalog_table").isNotNull())
        | (cls == "HiveTableRelation")
        | cls.contains(HIVE_SCAN_MARK)
    )
    base_item = cls.isin("LogicalRelation", *SCAN_LEAVES)
    subs = F.filter(F.array(F.when(catalog_item, F.lit(0)), F.when(base_item, F.lit(1))),
                    lambda s: s.isNotNull())
    items = visits.drop("path").select("*", F.explode(subs).alias("_sub"))
    roots = F.when((F.col("_sub") == 1) & (F.col("relation_class") == "HadoopFsRelation"), F.col("paths"))
    items = items.select("*", F.posexplode_outer(roots).alias("_at", "path")).withColumn(
        "sub", F.col("_sub") + F.coalesce("_at", F.lit(0)))

    sub = F.col("sub")
    path = F.col("path")
    is_file = (sub >= 1) & (F.col("relation_class") == "HadoopFsRelation")
    is_jdbc = (sub == 1) & F.coalesce(F.col("relation_class").contains("JDBCRelation"), F.lit(False))
    # Split-based rules run once per row and only where they apply.
    prepared = items.select(
        "*",
        F.coalesce(is_file & path.isNotNull(), F.lit(False)).alias("_is_file"),
        is_jdbc.alias("_is_jdbc"),
        F.when(is_file & R.path_is_hive(path), R.hive_name_from_path(path)).alias("_hive_name"),
        F.when(is_jdbc, R.jdbc_platform("jdbc_url")).alias("_jplat"),
    )
    hive_path = F.col("_is_file") & R.path_is_hive(path)
    file_path = F.col("_is_file") & ~R.path_is_hive(path)
    hive_name = F.col("_hive_name")
    jdbc_platform = F.col("_jplat")
    is_jdbc = F.col("_is_jdbc")

    platform = (
        F.when(sub == 0, F.lit(R.HIVE_PLATFORM))
        .when(file_path, F.lit(R.FILE_PLATFORM))
        .when(hive_path, F.lit(R.HIVE_PLATFORM))
        .when(is_jdbc, jdbc_platform)
    )
    name = (
        F.when(sub == 0, R.qualified_name("catalog_db", "catalog_table"))
        .when(file_path, R.name_override("input_override", path))
        .when(hive_path, hive_name)
        .when(is_jdbc, F.col("jdbc_table"))
    )
    fail = (
        F.when(hive_path & hive_name.isNull(), F.lit(R.FAIL_HIVE_PATH_SHORT))
        .when(is_jdbc & F.col("jdbc_table").isNull(), F.lit(R.FAIL_READ_NO_TABLE))
        # A read whose URL was not recorded stays unresolved; the rest of the plan counts.
        .when(is_jdbc & F.col("jdbc_url").isNotNull() & jdbc_platform.isNull(), F.lit(R.FAIL_URL_NO_PLATFORM))
    )
    return prepared.select(
        KEY, "pass", "node_id", "leaf_id", "sub", "node_class", "env", "col_node",
        platform.alias("platform"), name.alias("name"), fail.alias("fail_reason"),
        ((sub == 0) | F.col("_is_file") | is_jdbc).alias("records_schema"),
        file_path.alias("file_record"),
    ).withColumn("urn", _urn_or_null())


def _urn_or_null() -> Column:
    ok = F.col("platform").isNotNull() & F.col("name").isNotNull() & F.col("fail_reason").isNull()
    return F.when(ok, R.dataset_urn("platform", "name", "env"))


def sink_outputs(tracked: DataFrame) -> DataFrame:
    """The output dataset of a root sink, and the sink's own failures.

    Data-source CTAS is tracked but has no branch: no output row (O6).
    """
    rc = F.col("root_class")
    file_sink = rc == FILE_SINK
    file_catalog = file_sink & F.col("root_catalog_table").isNotNull()
    file_path = file_sink & F.col("root_catalog_table").isNull()
    jdbc = rc == JDBC_SINK
    hive = rc.isin(*HIVE_SINKS) | file_catalog
    jdbc_platform = R.jdbc_platform("root_jdbc_url")
    platform = (
        F.when(hive, F.lit(R.HIVE_PLATFORM)).when(file_path, F.lit(R.FILE_PLATFORM)).when(jdbc, jdbc_platform)
    )
    name = (
        F.when(hive, R.qualified_name("root_catalog_db", "root_catalog_table"))
        .when(file_path, R.name_override("output_override", "root_path"))
        .when(jdbc, F.col("root_jdbc_table"))
    )
    fail = (
        F.when(jdbc & F.col("root_jdbc_url").isNull(), F.lit(R.FAIL_SAVE_NO_URL))
        .when(jdbc & F.col("root_jdbc_table").isNull(), F.lit(R.FAIL_SAVE_NO_TABLE))
        .when(jdbc & jdbc_platform.isNull(), F.lit(R.FAIL_URL_NO_PLATFORM))
    )
    return tracked.filter(rc.isin(*R.QUERY_SINKS)).select(
        KEY, F.lit(PASS_SINK).alias("pass"), F.lit(0).alias("node_id"), F.lit(-1).alias("leaf_id"),
        F.lit(0).alias("sub"), "env",
        platform.alias("platform"), name.alias("name"), fail.alias("fail_reason"),
        F.coalesce(file_path, F.lit(False)).alias("file_record"), F.lit(0).alias("col_node"),
    ).withColumn("urn", _urn_or_null())


def sink_column_failures(outputs: DataFrame, plan_columns: DataFrame) -> DataFrame:
    """O2: a file sink's output attribute without ``#`` fails the execution
    (the reference cuts the text at the first ``#``)."""
    bad = plan_columns.filter((F.col("node_id") == 0) & ~R.has_expr_id("column_text")).select(KEY).distinct()
    return outputs.filter(F.col("file_record")).join(bad, KEY, "left_semi").select(
        KEY, "pass", "node_id", "leaf_id", "sub", F.lit(R.FAIL_OUTPUT_NO_EXPR_ID).alias("fail_reason")
    )
