"""The driver contract: entry on sf0.001, every query name has a builder, oracle keys are a subset."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["dest_txns_in_prev_24h", "band_floor", "transactions", "fraud", "fraud_rate_pct"]


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 120
