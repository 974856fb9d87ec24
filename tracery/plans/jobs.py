"""End-to-end job: Spark event logs in, lineage tables out.

    python -m tracery.plans.jobs --events <event-log folder> --out <folder> [--catalog <folder>]
    python -m tracery.plans.jobs --events <event-log folder> --out <folder> --follow "30 seconds"

With ``--follow`` the logs of running applications are followed, and ``out``
holds the versions of the catalog (``streaming/log_stream.py``). Otherwise the
job writes ``job_io`` (lineage per execution), ``aspects`` (catalog records),
``catalog`` (last write per URN and aspect), ``failed_executions`` and
``unread_lines`` (lines of the logs that are no event, per file) as parquet. Executions are keyed by ``(application, execution id)``, since event
logs of a fleet repeat execution ids across applications; the listener's
number is the job number. With ``--catalog``, an earlier run's catalog is
carried on: at an application's first event the jobs of its flow are removed
(pipeline reset), then this run's records are written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracery.operators import catalog as C
from tracery.plans.lineage import LineagePlan
from tracery.session import apply_runtime_conf, ensure_checkpoint_dir
from tracery.sources import eventlog as EL

def lineage_from_event_logs(spark: SparkSession, events_root: str, out_root: str,
                            plan_columns: DataFrame | None = None,
                            catalog: str | None = None) -> dict[str, str]:
    """Run the lineage job over every application in ``events_root``.

    ``plan_columns`` (keyed by ``app_key, execution_id``) defaults to the
    columns of the logged scans; a dataset without known columns gets no
    schema record, so a schema that the catalog has is not overwritten.
    """
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    tables = EL.lineage_tables(spark, events_root)
    executions, nodes, columns = EL.keyed(tables)
    if plan_columns is not None:
        columns = plan_columns.withColumn("execution_id", F.struct("app_key", "execution_id")).drop("app_key")
    plan = LineagePlan(executions, nodes, columns, listener=("app_key",), empty_schemas=False)
    out = out_root.rstrip("/")
    writes = plan.aspects
    if catalog is not None:
        earlier = spark.read.parquet(catalog)
        resets = C.pipeline_reset(plan.first_events, plan.alive, C.catalog_members(earlier))
        writes = C.delete_entities(earlier, resets).select(*writes.columns).unionByName(writes)
    outputs = {
        "job_io": plan.job_io.drop("input_list", "output_list", "event_time"),
        "aspects": plan.aspects,
        "catalog": C.latest_per_key(writes),
        "failed_executions": plan.failed,
        "unread_lines": EL.unread_lines(EL.read_lines(spark, events_root)),
    }
    paths = {}
    for name, frame in outputs.items():
        paths[name] = f"{out}/{name}"
        frame.write.mode("overwrite").parquet(paths[name])
    return paths


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Lineage tables from Spark event logs")
    parser.add_argument("--events", required=True, help="event-log folder (one entry per application)")
    parser.add_argument("--out", required=True, help="output folder for the lineage tables")
    parser.add_argument("--catalog", help="catalog folder of an earlier run, in another output folder")
    parser.add_argument("--follow", metavar="INTERVAL", help="follow running applications' logs, polling at this interval")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tracery-lineage").getOrCreate()
    if args.follow:
        from tracery.streaming.log_stream import LogStream

        out = args.out.rstrip("/")
        LogStream(spark, args.events, f"{out}/catalog").start(f"{out}/checkpoint", args.follow).awaitTermination()
        return
    for name, path in lineage_from_event_logs(spark, args.events, args.out, catalog=args.catalog).items():
        print(name, path)


if __name__ == "__main__":
    main()
