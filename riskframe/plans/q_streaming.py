"""Registered streaming source/sink query."""

from __future__ import annotations

import uuid

from riskframe.oracles.base import TXN, with_ctes
from riskframe.plans.catalog import register
from riskframe.plans.q_sources import _RAW_SQL, _raw_dbl
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.contract import raw_from_canonical
from riskframe.sources.fixtures import events_transactions
from riskframe.streaming.ingest import ingest, ingested


@register("stream_ingest", with_ctes(f"SELECT {_RAW_SQL} FROM transactions", TXN))
def q_stream_ingest(spark, sf):
    """The fixture as raw CSV files -> streaming contract read -> canonical Parquet sink (availableNow)."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskframe-stream-{uuid.uuid4().hex}"
    raw_from_canonical(events_transactions(spark, sf)).write.option("header", True).csv(f"{base}/raw")
    q = ingest(spark, f"{base}/raw", f"{base}/sink", f"{base}/ckpt")
    q.awaitTermination()
    return _raw_dbl(raw_from_canonical(ingested(spark, f"{base}/sink")))
