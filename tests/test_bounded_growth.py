"""Work, memory and disk of the lineage queries grow with the input and no faster."""

import datetime as dt
import glob

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tracery.plans import registry as Q
from tracery.session import apply_runtime_conf, bucket_count, scratch_path
from tracery.sources import eventlog as EL
from tracery.sources.fixture_logs import REPLAY_FILES, encode_event_log, replay_files, write_event_log
from tracery.sources.fixtures import BASE_ROWS_PER_BUCKET, Fixtures
from tracery.sources.plan_walk import walk
from tracery.streaming import incremental
from tracery.streaming.versions import FILES, Versions


def test_replay_has_a_fixed_number_of_batches_in_order_of_time(spark):
    rows = [(dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i * 7 % 200), i) for i in range(200)]
    events = spark.createDataFrame(rows, "started_at timestamp_ntz, execution_id long")
    folder = scratch_path(spark, "replay")
    files = replay_files(events, folder, rows_per_part=10)
    assert files == 200 // (REPLAY_FILES * 10)  # of one batch
    found = sorted(glob.glob(f"{folder.removeprefix('file:')}/*/*.json"))
    assert REPLAY_FILES <= len(found) <= REPLAY_FILES * files
    read = [r for f in found for r in sorted((x.started_at, x.execution_id) for x in spark.read.schema(events.schema).json(f).collect())]
    assert read == sorted(rows)
    assert replay_files(events.limit(0), scratch_path(spark, "replay")) == 1


def test_columns_are_not_dealt_by_their_type(spark):
    plan = Fixtures(spark, SF_SMALL).derived("plan_columns")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_bucket_is_written_by_few_tasks(spark):
    fx = Q._prepare(spark, SF_SMALL)
    for frame in (fx.executions, fx.plan_nodes, fx.plan_columns):
        assert len(frame.inputFiles()) <= 4 * fx.buckets  # four parts of a union at most


def test_a_bucket_holds_what_a_task_sorts_without_spilling(spark):
    # About 2 KB of a task's memory a base row; four tasks share 3,600 MB.
    for rows in (45_000_000, 270_000_000):
        assert rows / bucket_count(spark, rows, BASE_ROWS_PER_BUCKET) * 2_100 < 900e6


def test_shuffles_have_as_many_partitions_as_the_data_has_buckets(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_runtime_conf(spark, int(was) + 7)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == int(was) + 7
        apply_runtime_conf(spark, 1)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == int(was) + 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_streams_shuffle_into_as_many_partitions_as_the_data_has_buckets(spark, monkeypatch):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []

    def started(session, *_, **__):
        seen.append(int(session.conf.get("spark.sql.shuffle.partitions")))
        raise InterruptedError

    monkeypatch.setattr(Fixtures, "buckets", property(lambda self: int(was) + 5))
    monkeypatch.setattr(Fixtures, "__getitem__", lambda self, name: spark.createDataFrame(
        [], "execution_id long, app_name string, run_no int, run_execution_id long"))
    monkeypatch.setattr(incremental, "run_stream", started)
    try:
        for query in (incremental.stream_catalog_upsert, incremental.stream_catalog_current, incremental.stream_emit_log,
                      incremental.stream_first_events):
            spark.conf.set("spark.sql.shuffle.partitions", was)
            with pytest.raises(InterruptedError):
                query(spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert seen == [int(was) + 5] * 4


def test_application_events_need_no_plan_walk_and_logs_are_compressed(spark, monkeypatch):
    for key in [k for k in Q._PLANS if k[1] == SF_SMALL and "event" in k[2]]:
        monkeypatch.delitem(Q._PLANS, key)

    def walked(*_):
        raise AssertionError("plans were walked")

    monkeypatch.setattr(EL, "tables_of", walked)
    monkeypatch.setattr(EL, "lineage_tables", walked)
    assert Q.app_ends(spark, SF_SMALL).count() == Q.app_starts(spark, SF_SMALL).count() > 0
    assert Q.session_settings(spark, SF_SMALL).count() > 0
    files = spark.read.text(Fixtures(spark, SF_SMALL).event_log()).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)


def test_only_the_kinds_asked_for_are_written(spark):
    root = Fixtures(spark, SF_SMALL).event_log()
    every, some = EL.read_events(spark, root), EL.written_events(spark, root, EL.APP_KINDS)
    assert some.inputFiles() and not any(EL.EV_SQL_START in f for f in some.inputFiles())
    assert every.filter(F.col("event") == EL.EV_SQL_START).count() > 0
    want = every.filter(F.col("event").isin(*EL.APP_KINDS))
    assert sorted(map(tuple, some.select(*want.columns).collect())) == sorted(map(tuple, want.select("app_key", "event", "json").collect()))


def test_a_line_of_a_log_is_made_once_and_not_shuffled(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [(f"eventlog_v2_app{i % 3}", f'{{"Event":"e{i}"}}') for i in range(60)]
    lines = spark.createDataFrame(rows, "app_dir string, value string").repartition(4).mapInArrow(count, "app_dir string, value string")
    root = write_event_log(lines, scratch_path(spark, "lines"))
    assert made.value == 60
    back = spark.read.schema("value string, app_dir string").text(root)
    assert sorted((r.app_dir, r.value) for r in back.collect()) == sorted(rows)


def test_plans_of_a_log_are_made_in_the_buckets_of_their_nodes(spark):
    fx = Q._prepare(spark, SF_SMALL)
    steps = []
    plan = encode_event_log(fx.executions, fx.plan_nodes, fx.buckets, steps)._jdf.queryExecution().executedPlan().toString()
    assert not steps and "SortMergeJoin" in plan
    # Only the applications' own events are grouped anew.
    assert all("hashpartitioning(app_name" in line for line in plan.splitlines() if " Exchange " in line)


def test_records_of_runs_are_not_bucketed_by_urn(spark):
    writes = Q.two_runs(spark, SF_SMALL).writes
    table = writes.written_as[0]
    told = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
    assert "Num Buckets" not in told and "run_no" in writes.columns


def test_folding_reads_the_buckets_and_shuffles_no_node_for_its_joins(spark, monkeypatch):
    fx = Q._prepare(spark, SF_SMALL)
    events = EL.written_events(spark, fx.event_log("physical"))
    seen, folded = [], EL.folded

    def kept(executions, nodes):
        for frame in (executions, nodes):
            plan = frame.groupBy("app_key", "execution_id").count()._jdf.queryExecution().executedPlan().toString()
            seen.append("hashpartitioning" in plan)
        return folded(executions, nodes)

    monkeypatch.setattr(EL, "folded", kept)
    tables = EL.tables_of(events, fx.buckets)
    assert seen == [False, False]
    plain = EL.tables_of(events)
    for name in ("executions", "plan_nodes"):
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, plain[name].select(*tables[name].columns).collect()))


def test_a_plan_is_parsed_once_and_numbered_in_its_row(spark, monkeypatch):
    starts = spark.createDataFrame([("a", 1, '{"nodeName":"x","children":[{"nodeName":"y"}]}', None)],
                                   "app_key string, execution_id long, plan_json string, command_args string")
    assert "Exchange" not in walk(starts)._jdf.queryExecution().executedPlan().toString()
    fx, seen = Q._prepare(spark, SF_SMALL), []
    events = EL.written_events(spark, fx.event_log())

    def started(some, made=EL.sql_starts):
        seen.append(some)
        return made(some)

    monkeypatch.setattr(EL, "sql_starts", started)
    plan = EL.plan_nodes(EL.sql_starts(events))._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "variant" not in plan
    seen.clear()
    EL.tables_of(events, fx.buckets)
    assert len(seen) == 1


def test_nodes_that_stay_are_not_dealt_again_after_folding(spark, monkeypatch):
    fx, seen, folded = Q._prepare(spark, SF_SMALL), [], EL.folded

    def kept(executions, nodes):
        out = folded(executions, nodes)
        plan = out[1]._jdf.queryExecution().executedPlan().toString()
        seen.append([line for line in plan.split("Union")[1].splitlines() if "Exchange" in line])
        return out

    monkeypatch.setattr(EL, "folded", kept)
    EL.tables_of(EL.written_events(spark, fx.event_log("physical")), fx.buckets)
    # The nodes of executions that were taken go to their owner's bucket; the anti join's side has no exchange.
    assert len(seen) == 1
    spread = [line for line in seen[0] if "REPARTITION_BY_NUM" in line]
    assert len(spread) == 1


def test_files_of_a_version_grow_with_its_buckets_and_not_with_the_tasks(spark):
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    store = Versions(spark, scratch_path(spark, "versions"))
    rows = spark.range(0, 4000, 1, 40).selectExpr("id", "cast(id as string) as v")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert store.stage(0, "t", rows, (F.col("id") % 20).cast("int")) == list(range(20))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    files = glob.glob(f"{store.folder.removeprefix('file:')}/t/{0:012d}/bucket=*/*.parquet")
    assert 20 <= len(files) <= 20 * FILES < 20 * 40
    store.commit(0, store.manifest(), {"t": (rows, list(range(20)), [])})
    assert sorted((r.id, r.v) for r in store.read("t").collect()) == [(i, str(i)) for i in range(4000)]
