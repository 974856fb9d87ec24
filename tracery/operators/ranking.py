"""Skew-safe ranking within groups.

A group (one application, one flow) may hold a third of all rows, so a plain
``row_number()`` over ``partitionBy(group)`` would put that third in one task.
Both helpers here spread a group over many tasks and stay exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracery.session import write_table

def _cols(names) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def number_within_groups(df: DataFrame, groups: list[str], order: list[str], out: str,
                         start: int = 1) -> DataFrame:
    """``row_number() over (partition by groups order by order) + start - 1``.

    The order columns must make a total order within a group. Rows are range
    partitioned on ``groups + order`` (the range bounds cut a hot group across
    tasks), sorted within partitions, and written once together with their
    partition number and a running id. Range bounds are sampled anew by every
    job that plans the exchange, so everything after reads the written table:
    a per-(partition, group) summary, at most ``partitions + groups`` rows,
    gives each group's offset in earlier partitions and is joined back on
    both. A lost task reads the same written rows again.
    """
    keys = [*groups, *order]
    tagged = write_table(
        df.repartitionByRange(*_cols(keys))
        .sortWithinPartitions(*_cols(keys))
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()),
        "numbered")
    stats = tagged.groupBy("_pid", *groups).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return (
        tagged.alias("t")
        .join(offsets.alias("o"), _null_safe(["_pid", *groups]), "inner")
        .select("t.*", "_first", "_before")
        .withColumn(out, (F.col("_mid") - F.col("_first") + F.col("_before") + F.lit(start)).cast("bigint"))
        .drop("_pid", "_mid", "_first", "_before")
    )


def _null_safe(names) -> Column:
    """Equality on all names; a null group equals itself."""
    return reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in names])


def top_k_within_groups(df: DataFrame, groups: list[str], order: list[str], k: int, out: str,
                        salt_buckets: int = 64) -> DataFrame:
    """Rows ranked ``1..k`` per group by ``order`` (exact), with ``out`` = rank.

    Phase 1 ranks within ``(group, salt)`` sub-groups and keeps each
    sub-group's first ``k``; the group's true first ``k`` are among them.
    Phase 2 ranks those at most ``salt_buckets * k`` candidates per group.
    """
    salt = F.pmod(F.xxhash64(*_cols(order)), F.lit(salt_buckets))
    local = Window.partitionBy(*groups, "_salt").orderBy(*_cols(order))
    cand = (
        df.withColumn("_salt", salt)
        .withColumn("_local", F.row_number().over(local))
        .filter(F.col("_local") <= k)
    )
    final = Window.partitionBy(*groups).orderBy(*_cols(order))
    return (
        cand.withColumn(out, F.row_number().over(final).cast("bigint"))
        .filter(F.col(out) <= k)
        .drop("_salt", "_local")
    )
