"""Gates and failure rules: S4, F1-F5.

All gates are joins or filters keyed on ``execution_id``; nothing is
collected. The failure rule (F5) is an aggregate over the per-node reasons
that ``extract`` computes, so one wrong node loses exactly its execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracery.functions import rules as R

KEY = "execution_id"
NODE_ATTRS = ("relation_class", "catalog_db", "catalog_table", "path", "paths", "jdbc_url", "jdbc_table")
SEQ = ("pass", "node_id", "leaf_id", "sub")

# Visit order of things met before the plan walk: the default filesystem is
# read first, then the root sink's own options.
PASS_SESSION = -2
PASS_SINK = -1


def with_job_number(executions: DataFrame) -> DataFrame:
    """The number the listener saw for an execution (job URN, ``appId``).

    Defaults to ``execution_id``; the two-run catalog scenario supplies the
    per-run number instead.
    """
    if "job_number" in executions.columns:
        return executions
    return executions.withColumn("job_number", F.col(KEY))


def plan_roots(plan_nodes: DataFrame) -> DataFrame:
    return plan_nodes.filter(F.col("edge_kind") == "root").select(
        KEY,
        F.col("node_class").alias("root_class"),
        *[F.col(c).alias(f"root_{c}") for c in NODE_ATTRS],
    )


def execution_context(executions: DataFrame, plan_nodes: DataFrame,
                      dev_markers: tuple[str, ...] = R.DEV_MARKERS) -> DataFrame:
    """Executions that are not dropped and whose plan is known,
    with the root node's attributes."""
    return (
        with_job_number(executions.filter(drop_reason().isNull()))
        .join(plan_roots(plan_nodes), KEY, "inner")
        .withColumn("env", R.environment("default_fs", dev_markers))
    )


def executions_without_plan(executions: DataFrame, plan_nodes: DataFrame) -> DataFrame:
    """Start events whose query execution is gone are skipped."""
    return (
        executions.join(plan_roots(plan_nodes).select(KEY), KEY, "left_anti")
        .select(KEY, F.lit("no query execution").alias("reason"))
    )


def drop_reason() -> Column:
    """null guards (no context, or no start event)."""
    return (
        F.when(F.col("app_name").isNull() | F.col("master").isNull(), F.lit("context is null"))
        .when(F.col("started_at").isNull(), F.lit("start event is null"))
    )


def dropped_executions(executions: DataFrame) -> DataFrame:
    """executions that the null guards stop."""
    return executions.select(KEY, drop_reason().alias("reason")).filter(F.col("reason").isNotNull())


def tracked_nodes(plan_nodes: DataFrame) -> DataFrame:
    """nodes of a tracked class."""
    return plan_nodes.filter(F.col("node_class").isin(*R.TRACKED_CLASSES)).select(KEY, "node_id", "node_class")


def tracked_context(context: DataFrame) -> DataFrame:
    """only executions whose root class is tracked are processed."""
    return context.filter(F.col("root_class").isin(*R.TRACKED_CLASSES))


def first_failures(tracked: DataFrame, sink_failures: DataFrame, item_failures: DataFrame) -> DataFrame:
    """first failure reason per execution, in the reference's order.

    Inputs carry ``execution_id, pass, node_id, leaf_id, sub, fail_reason``.
    ``min_by`` over the visit order is a plain aggregate (map-side partial
    aggregation), so no window over a large execution is needed.
    """
    session = tracked.filter(F.col("default_fs").isNull()).select(
        KEY,
        F.lit(PASS_SESSION).alias("pass"), F.lit(0).alias("node_id"),
        F.lit(-1).alias("leaf_id"), F.lit(0).alias("sub"),
        F.lit(R.FAIL_NO_DEFAULT_FS).alias("fail_reason"),
    )
    cols = [KEY, *SEQ, "fail_reason"]
    every = reduce(DataFrame.unionByName, [session.select(*cols), sink_failures.select(*cols),
                                           item_failures.select(*cols)])
    return every.groupBy(KEY).agg(
        F.min_by("fail_reason", F.struct(*[F.col(c) for c in SEQ])).alias("fail_reason")
    )
