"""Every query with an oracle: Spark result == DuckDB result on sf0.001."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from tracery.plans.registry import QUERIES

STREAMING = {"stream_catalog_upsert", "stream_first_events"}
NAMES = sorted(set(QUERIES) - STREAMING)


def norm(v):
    if v is None:
        return "∅"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["execution_id", "job_urn", "flow_urn", "input_urns", "output_urns", "n_inputs", "n_outputs"]
    assert df.count() > 0
