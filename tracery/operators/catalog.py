"""Catalog maintenance: upsert (E7), flow members (D1), delete (D2),
pipeline reset (D3), soft-delete recovery (D4) and re-runs (D5).

The catalog is a table of aspects keyed by ``(urn, aspect_name)``. An upsert
keeps the last write per key; writes are ordered by
``(started_at, execution_id, emit_seq)``. Every "latest per key" step is a
``max_by`` aggregate, so a URN written by many executions (a shared output
name) is combined map-side rather than ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.functions import rules as R
from tracery.operators.gates import KEY
from tracery.operators.ranking import number_within_groups
from tracery.sources.fixtures import RUN_SPLIT

CATALOG_KEY = ("urn", "aspect_name")
WRITE_ORDER = ("started_at", KEY, "emit_seq")
PAYLOAD = ("entity_type", "aspect")


def number_runs(executions: DataFrame) -> DataFrame:
    """Fixture ``runs``: run 1 before the split date, run 2 after; the job
    number restarts at 0 in every (application, run)."""
    runs = executions.select(
        KEY, "app_name", "master", "started_at",
        F.when(F.col("started_at") < F.lit(RUN_SPLIT).cast("timestamp_ntz"), F.lit(1)).otherwise(F.lit(2)).alias("run_no"),
    )
    return number_within_groups(runs, ["app_name", "run_no"], ["started_at", KEY], "run_execution_id", start=0).select(
        KEY, "app_name", "master", "started_at", "run_no", "run_execution_id"
    )


def latest_per_key(writes: DataFrame) -> DataFrame:
    """Last write per ``(urn, aspect_name)`` wins; no delete."""
    order = F.struct(*[F.col(c) for c in WRITE_ORDER])
    return writes.groupBy(*CATALOG_KEY).agg(
        F.max_by(F.struct(*[F.col(c) for c in (*WRITE_ORDER, *PAYLOAD)]), order).alias("w")
    ).select(*CATALOG_KEY, *[F.col(f"w.{c}").alias(c) for c in (*WRITE_ORDER, *PAYLOAD)])


def flow_members(relationships: DataFrame) -> DataFrame:
    """Every entity that is part of a flow (INCOMING ``IsPartOf``)."""
    return relationships.filter((F.col("rel_type") == "IsPartOf") & (F.col("direction") == "INCOMING")).select(
        F.col("entity_urn").alias("flow_urn"), F.col("related_urn").alias("member_urn")
    )


def catalog_members(catalog: DataFrame) -> DataFrame:
    """D1 on a catalog table: the jobs of each flow, by their URNs."""
    flow = F.regexp_extract("urn", r"^urn:li:dataJob:\((.*),ExecutionId_\d+\)$", 1)
    return catalog.filter("entity_type = 'dataJob'").select(
        flow.alias("flow_urn"), F.col("urn").alias("member_urn")).filter("flow_urn <> ''").distinct()


def pipeline_reset(firsts: DataFrame, alive: DataFrame, members: DataFrame) -> DataFrame:
    """D3: at a listener's first emitting event, delete its flow's members."""
    resets = alive.join(firsts.select(KEY), KEY, "left_semi").select(
        "app_name", R.flow_urn("app_name", "master").alias("flow_urn")
    )
    return resets.join(members, "flow_urn", "inner").select("app_name", F.col("member_urn").alias("deleted_urn"))


def delete_entities(catalog: DataFrame, deleted: DataFrame) -> DataFrame:
    """Remove every aspect of the deleted URNs."""
    return catalog.join(deleted.select(F.col("deleted_urn").alias("urn")).distinct(), "urn", "left_anti")


def current_status(flow_status: DataFrame) -> DataFrame:
    """Latest ``Status`` per flow; ``removed = false`` recovers it."""
    return flow_status.groupBy("urn").agg(F.max_by("removed", "seq").alias("removed"))
