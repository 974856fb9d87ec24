"""Owners of cached leaves by pointer doubling."""

import pytest
from pyspark.sql import functions as F

from tracery.operators import extract as X

NODES = ("execution_id long, node_id int, parent_id int, edge_kind string, node_class string, relation_class string, "
         "catalog_db string, catalog_table string, path string, paths array<string>, jdbc_url string, jdbc_table string")


def node(ex, node_id, parent, edge, cls):
    return (ex, node_id, parent, edge, cls, None, None, None, None, None, None, None)


def visits_of(spark, nodes):
    return nodes.filter(F.col("node_class") == "InMemoryRelation").select(
        "execution_id", F.lit(1).alias("pass"), "node_id", "node_class", F.lit("PROD").alias("env"), F.lit("").alias("input_override"))


def test_deep_chain_takes_few_rounds(spark):
    rows = []
    for ex, depth in ((1, 200), (2, 1), (3, 7)):
        rows += [node(ex, 0, None, "root", "InMemoryRelation"), node(ex, 1, 0, "child", "Join")]
        rows += [node(ex, 10 + k, 0 if k == 0 else 9 + k, "cached", "InMemoryTableScanExec") for k in range(depth)]
        rows += [node(ex, 5000, 9 + depth, "cached", "FileSourceScanExec"), node(ex, 5001, 9 + depth, "cached", "RowDataSourceScanExec")]
    # A cached plan whose owner is not an in-memory relation of the tree.
    rows += [node(4, 0, None, "root", "Join"), node(4, 5, 0, "cached", "FileSourceScanExec")]
    nodes = spark.createDataFrame(rows, NODES)
    written = []
    got = X.cached_leaves(visits_of(spark, nodes), nodes, written=written)
    assert sorted((r.execution_id, r.node_id, r.leaf_id) for r in got.collect()) == [
        (ex, 0, leaf) for ex in (1, 2, 3) for leaf in (5000, 5001)]
    assert len(written) - 1 <= 10  # the edges, and one table a round


def test_cycle_of_parents_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_ROUNDS", 4)
    rows = [node(1, 0, None, "root", "InMemoryRelation"), node(1, 5, 6, "cached", "InMemoryTableScanExec"),
            node(1, 6, 5, "cached", "InMemoryTableScanExec")]
    nodes = spark.createDataFrame(rows, NODES)
    with pytest.raises(ValueError, match="cycle"):
        X.cached_leaves(visits_of(spark, nodes), nodes)
