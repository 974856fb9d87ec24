"""The streaming sink survives a retried micro-batch (idempotent upsert)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tracery.operators import gates as G
from tracery.session import bucket_count, scratch_path
from tracery.sources.fixtures import Fixtures
from tracery.streaming.incremental import LineageStream


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_retried_epoch_gives_same_catalog(spark):
    fx = Fixtures(spark, SF_SMALL)
    events = G.with_job_number(fx.executions)
    early = events.filter(F.col("started_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    late = events.filter(F.col("started_at") >= F.lit("1998-01-01").cast("timestamp_ntz"))

    once = LineageStream(spark, fx.plan_nodes, fx.plan_columns, ("app_name",), scratch_path(spark, "once"))
    once.process(early, 0)
    once.process(late, 1)

    retried = LineageStream(spark, fx.plan_nodes, fx.plan_columns, ("app_name",), scratch_path(spark, "retry"))
    retried.process(early, 0)
    retried.process(late, 1)
    retried.process(late, 1)  # the same epoch again, as after a failure

    assert bag(retried.result("catalog")) == bag(once.result("catalog"))
    assert bag(retried.result("seen")) == bag(once.result("seen"))
    # first events of the second epoch only cover applications not seen in the first
    seen = retried.result("seen")
    assert seen.groupBy("app_name").count().filter("count > 1").count() == 0


def test_bucket_count_bounds(spark):
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = min(cap, spark.sparkContext.defaultParallelism)
    assert bucket_count(spark, 0) == floor
    assert bucket_count(spark, 10**12) == 250_000  # about 4M rows each, without a cap
