"""Skew-safe ranking equals a plain window, with one group holding a third of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracery.operators.catalog import latest_per_key
from tracery.operators.ranking import number_within_groups, top_k_within_groups


def skewed(spark, n=3000):
    # group "hot" holds a third of all rows; the rest spread over 50 groups
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 1000003).alias("k"),
        F.col("id"),
    )


def brute(df, k=None):
    w = Window.partitionBy("g").orderBy("k", "id")
    out = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    return out if k is None else out.filter(F.col("rn") <= k)


def bag(df):
    return sorted(tuple(r) for r in df.select("g", "k", "id", "rn").collect())


def test_number_within_groups(spark):
    df = skewed(spark)
    assert bag(number_within_groups(df, ["g"], ["k", "id"], "rn")) == bag(brute(df))


def test_top_k_within_groups(spark):
    df = skewed(spark)
    for k in (1, 7, 200):
        assert bag(top_k_within_groups(df, ["g"], ["k", "id"], k, "rn", salt_buckets=8)) == bag(brute(df, k))


def test_latest_per_key_hot_urn(spark):
    rows = [("urn:hot", "a", i, i, 1, "dataset", f"v{i}") for i in range(300)] + \
           [("urn:x", "a", 5, 2, 1, "dataset", "x1"), ("urn:x", "a", 5, 2, 2, "dataset", "x2")]
    df = spark.createDataFrame(rows, "urn string, aspect_name string, started_at long, execution_id long, "
                                     "emit_seq int, entity_type string, aspect string")
    got = {r.urn: r.aspect for r in latest_per_key(df).collect()}
    assert got == {"urn:hot": "v299", "urn:x": "x2"}
