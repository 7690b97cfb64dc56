"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E
from surgecast.plans import catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "event_count_on_service_extra_traffic_scale" in df.columns


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 40


def test_every_query_lists_operators():
    for name, q in catalog.registry().items():
        assert q.ops, name
