"""ST1/ST2: the streamed catalog equals the batch upsert; first events agree."""

from conftest import SF_SMALL
from tracery.plans import registry as Q


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_catalog_equals_batch(spark):
    assert bag(Q.stream_catalog_upsert(spark, SF_SMALL)) == bag(Q.catalog_upsert(spark, SF_SMALL))


def test_stream_first_events_equals_batch(spark):
    assert bag(Q.stream_first_events(spark, SF_SMALL)) == bag(Q.first_events(spark, SF_SMALL))
