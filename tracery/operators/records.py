"""Lineage records: URN lists, schema maps, and catalog aspects.

Per-execution lists (A1, A2) are built with ``collect_list`` over structs that
carry the visit order and then sorted, since the order ``collect_list`` sees
is not defined. Their size is bounded by one execution's plan. Last-write-wins
maps (A3, A4) are ``max_by`` aggregates, which Spark combines map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.functions import rules as R
from tracery.operators.gates import KEY, SEQ

EMIT_DATASET_PROPERTIES = 1
EMIT_SCHEMA_METADATA = 2
EMIT_FLOW_INFO = 3
EMIT_JOB_INFO = 4
EMIT_JOB_IO = 5

def _seq() -> F.Column:
    return F.struct(*[F.col(c) for c in SEQ])


def survivors(tracked: DataFrame, failed: DataFrame) -> DataFrame:
    """Executions that pass the root gate and fail nowhere."""
    return tracked.join(failed.select(KEY), KEY, "left_anti")


def surviving(frame: DataFrame, alive: DataFrame) -> DataFrame:
    return frame.join(alive.select(KEY), KEY, "left_semi")


def ordered_urns(frame: DataFrame, name: str) -> DataFrame:
    """A1/A2: URNs per execution in visit order, duplicates kept."""
    return frame.groupBy(KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in SEQ], F.col("urn")))),
                    lambda x: x["urn"]).alias(name)
    )


def job_io(alive: DataFrame, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """E4 + E10: one lineage record per surviving execution; empty lists kept."""
    empty = F.array().cast("array<string>")
    ins = ordered_urns(inputs, "inputs")
    outs = ordered_urns(outputs.filter(F.col("urn").isNotNull()), "outputs")
    flow = R.flow_urn("app_name", "master")
    return (
        alive.select(KEY, "app_name", "master", "job_number", F.col("started_at").alias("event_time"))
        .join(ins, KEY, "left")
        .join(outs, KEY, "left")
        .select(
            KEY, "event_time",
            R.job_urn(flow, "job_number").alias("job_urn"),
            flow.alias("flow_urn"),
            F.coalesce("inputs", empty).alias("input_list"),
            F.coalesce("outputs", empty).alias("output_list"),
        )
        .select(
            KEY, "job_urn", "flow_urn",
            F.concat_ws("|", "input_list").alias("input_urns"),
            F.concat_ws("|", "output_list").alias("output_urns"),
            F.size("input_list").alias("n_inputs"),
            F.size("output_list").alias("n_outputs"),
            "input_list", "output_list", "event_time",
        )
    )


def renumber_job_io(io: DataFrame, alive: DataFrame) -> DataFrame:
    """``job_io`` of the same executions under other job numbers."""
    flow = R.flow_urn("app_name", "master")
    lists = io.select(KEY, "input_urns", "output_urns", "n_inputs", "n_outputs", "input_list", "output_list")
    return alive.select(KEY, "app_name", "master", "job_number", F.col("started_at").alias("event_time")) \
        .join(lists, KEY, "inner").select(
            KEY, R.job_urn(flow, "job_number").alias("job_urn"), flow.alias("flow_urn"),
            "input_urns", "output_urns", "n_inputs", "n_outputs", "input_list", "output_list", "event_time",
        )


def job_info(alive: DataFrame) -> DataFrame:
    """Job name, type and custom properties (``appId`` holds the execution number)."""
    return alive.select(
        KEY,
        R.job_urn(R.flow_urn("app_name", "master"), "job_number").alias("job_urn"),
        F.col("description").alias("name"),
        F.lit(R.JOB_TYPE).alias("type"),
        R.start_time_text("started_at").alias("started_at"),
        F.col("job_number").cast("string").alias("app_id"),
        "app_name",
        F.col("started_at").alias("event_time"),
    )


def job_urns(executions: DataFrame) -> DataFrame:
    """N9 on every execution."""
    flow = R.flow_urn("app_name", "master")
    num = F.col("job_number") if "job_number" in executions.columns else F.col(KEY)
    return executions.select(KEY, flow.alias("flow_urn"), R.job_urn(flow, num).alias("job_urn"))


def input_column_types(items: DataFrame, alive: DataFrame, plan_columns: DataFrame) -> DataFrame:
    """Column name -> type for one execution, last write wins."""
    records = surviving(items.filter("records_schema"), alive).select(KEY, *SEQ, "col_node")
    cols = plan_columns.select(
        KEY, F.col("node_id").alias("col_node"), "ordinal", F.col("column_text").alias("column_name"), "data_type"
    )
    return (
        records.join(cols, [KEY, "col_node"], "inner")
        .groupBy(KEY, "column_name")
        .agg(F.max_by("data_type", F.struct(*[F.col(c) for c in SEQ], F.col("ordinal"))).alias("data_type"))
    )


def file_datasets(items: DataFrame, outputs: DataFrame, alive: DataFrame, buckets: int | None = None) -> DataFrame:
    """A3: per file dataset name, the columns of the last write.

    The file sink writes first (root), then file inputs in visit order. An
    input override maps many files to one name; the winner is a ``max_by``.
    """
    cols = [KEY, "env", F.col("name").alias("dataset"), *SEQ, "col_node"]
    outs = outputs.filter(F.col("file_record") & F.col("name").isNotNull()).select(
        *cols, F.lit(True).alias("is_output"))
    ins = items.filter("file_record").select(*cols, F.lit(False).alias("is_output"))
    # A union loses its inputs' partitioning: shuffle the (small) record set
    # once by execution, into the inputs' buckets, which also serves the
    # per-dataset grouping and the joins on execution that follow.
    records = surviving(outs, alive).unionByName(surviving(ins, alive))
    records = records.repartition(buckets, KEY) if buckets else records.repartition(KEY)
    return records.groupBy(KEY, "dataset").agg(
        F.max("env").alias("env"),
        F.max_by(F.struct("col_node", "is_output"), _seq()).alias("winner"),
    ).select(KEY, "dataset", "env", "winner.col_node", "winner.is_output")


def file_dataset_columns(datasets: DataFrame, plan_columns: DataFrame) -> DataFrame:
    cols = plan_columns.select(KEY, F.col("node_id").alias("col_node"), "ordinal", "column_text")
    name = F.when(F.col("is_output"), R.output_column_name("column_text")).otherwise(F.col("column_text"))
    return datasets.join(cols, [KEY, "col_node"], "inner").select(
        KEY, "dataset", "env", "ordinal", name.alias("column_name")
    )


def schema_fields(dataset_columns: DataFrame, column_types: DataFrame) -> DataFrame:
    """J1 + T1: each file column typed from the execution's input schema map."""
    return dataset_columns.join(column_types, [KEY, "column_name"], "left").select(
        KEY, "dataset", "env", "ordinal",
        F.col("column_name").alias("field_path"),
        R.field_type("data_type").alias("field_type"),
        R.native_type("data_type").alias("native_type"),
    )


def schema_metadata(datasets: DataFrame, fields: DataFrame) -> DataFrame:
    """One schema record per file dataset, fields in column order."""
    grouped = fields.groupBy(KEY, "dataset").agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "field_path", "native_type", "field_type"))).alias("f")
    )
    return datasets.join(grouped, [KEY, "dataset"], "left").select(
        KEY, "dataset", "env",
        R.dataset_urn(F.lit(R.FILE_PLATFORM), "dataset", "env").alias("urn"),
        F.concat(F.col("dataset"), F.lit("_schema")).alias("schema_name"),
        F.lit(1).alias("version"),
        F.lit("").alias("hash"),
        R.platform_urn(F.lit(R.FILE_PLATFORM)).alias("platform"),
        F.transform(
            F.coalesce("f", F.array().cast("array<struct<ordinal:int,field_path:string,native_type:string,field_type:string>>")),
            lambda x: F.struct(x["field_path"].alias("fieldPath"), x["native_type"].alias("nativeDataType"),
                               x["field_type"].alias("type")),
        ).alias("fields"),
    ).withColumn("n_fields", F.size("fields"))


def first_events(alive: DataFrame, partition: tuple[str, ...] = ("app_name",)) -> DataFrame:
    """D3: first surviving execution of each listener (application, or
    application and run). ``min`` over a struct is a partial aggregate, so a
    hot application costs no single large task."""
    return alive.groupBy(*partition).agg(F.min(F.struct("started_at", KEY)).alias("first")).select(
        *partition, F.col(f"first.{KEY}").alias(KEY)
    )


def aspects(alive: DataFrame, metadata: DataFrame, io: DataFrame, info: DataFrame,
            firsts: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every record a surviving execution emits, in emit order.

    ``aspect`` is the JSON payload; ``emit_seq`` orders records of one
    execution (file datasets first, then flow, job info, job IO). Each branch
    takes the event time, and the executions' columns to ``carry``, from an
    input partitioned by execution, so the union needs no exchange of its own.
    """
    when = alive.select(KEY, "started_at", "app_name", "master", *carry)
    if carry:
        info, io = (x.join(alive.select(KEY, *carry), KEY, "inner") for x in (info, io))
    meta = metadata.join(when.select(KEY, "started_at", *carry), KEY, "inner")
    props = meta.select(
        KEY, *carry, "started_at", F.lit(EMIT_DATASET_PROPERTIES).alias("emit_seq"), "urn",
        F.lit("datasetProperties").alias("aspect_name"),
        F.to_json(F.struct(F.col("dataset").alias("name"))).alias("aspect"),
    )
    schema = meta.select(
        KEY, *carry, "started_at", F.lit(EMIT_SCHEMA_METADATA).alias("emit_seq"), "urn",
        F.lit("schemaMetadata").alias("aspect_name"),
        F.to_json(F.struct(
            F.col("schema_name").alias("schemaName"), "platform", "version", "hash", "fields",
        )).alias("aspect"),
    )
    flow = when.join(firsts.select(KEY), KEY, "left_semi").select(
        KEY, *carry, "started_at", F.lit(EMIT_FLOW_INFO).alias("emit_seq"), R.flow_urn("app_name", "master").alias("urn"),
        F.lit("dataFlowInfo").alias("aspect_name"),
        F.to_json(F.struct(F.col("app_name").alias("name"))).alias("aspect"),
    )
    jinfo = info.select(
        KEY, *carry, F.col("event_time").alias("started_at"), F.lit(EMIT_JOB_INFO).alias("emit_seq"),
        F.col("job_urn").alias("urn"), F.lit("dataJobInfo").alias("aspect_name"),
        F.to_json(F.struct(
            "name", "type",
            F.struct(F.col("started_at").alias("startedAt"), F.col("app_id").alias("appId"),
                     F.col("app_name").alias("appName")).alias("customProperties"),
        )).alias("aspect"),
    )
    jio = io.select(
        KEY, *carry, F.col("event_time").alias("started_at"), F.lit(EMIT_JOB_IO).alias("emit_seq"),
        F.col("job_urn").alias("urn"), F.lit("dataJobInputOutput").alias("aspect_name"),
        F.to_json(F.struct(F.col("input_list").alias("inputDatasets"),
                           F.col("output_list").alias("outputDatasets"))).alias("aspect"),
    )
    every = reduce(DataFrame.unionByName, [props, schema, flow, jinfo, jio])
    return every.select(
        KEY, "started_at", "emit_seq", R.entity_type("urn").alias("entity_type"), "urn", "aspect_name", "aspect", *carry
    )


def emit_summary(aspect_rows: DataFrame) -> DataFrame:
    """Records written per aspect."""
    return aspect_rows.groupBy("aspect_name", "entity_type").agg(F.count(F.lit(1)).alias("n"))
