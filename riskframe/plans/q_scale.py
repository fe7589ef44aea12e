"""Headline queries on the lineitem scale fixture (daily steps, 456,861 rows at sf0.1)."""

from __future__ import annotations

from riskframe.operators import analysis as an
from riskframe.operators import cost as co
from riskframe.operators import features as fe
from riskframe.operators import ranking as rk
from riskframe.oracles.base import FEATURES, LINEITEM_TXN, SCORED, with_ctes
from riskframe.oracles.cost_sql import FIXED, sweep_ctes
from riskframe.plans.catalog import register
from riskframe.plans.q_audit import ranking_sql
from riskframe.sources.fixtures import lineitem_transactions, scorecard


def L(spark, sf):
    """Scale fixture with constant balances/flag columns absent: the feature layer needs none of them."""
    return lineitem_transactions(spark, sf)


@register("features_lineitem", with_ctes("SELECT * FROM features", LINEITEM_TXN, FEATURES))
def q_features_lineitem(spark, sf):
    return fe.build_features(L(spark, sf))


_VEL = ("CASE WHEN dest_txn_prev_24h = 0 THEN '0' WHEN dest_txn_prev_24h = 1 THEN '1' WHEN dest_txn_prev_24h < 5 "
        "THEN '2-4' WHEN dest_txn_prev_24h < 10 THEN '5-9' ELSE '10+' END")


@register("q6_velocity_bands_lineitem", with_ctes(f"""
SELECT dest_txns_in_prev_24h, band_floor, transactions, fraud,
  CAST(100 AS DOUBLE) * CAST(fraud AS DOUBLE) / NULLIF(CAST(transactions AS DOUBLE), 0) AS fraud_rate_pct FROM (
  SELECT {_VEL} AS dest_txns_in_prev_24h, MIN(dest_txn_prev_24h) AS band_floor, COUNT(*) AS transactions,
         CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM features GROUP BY 1)""", LINEITEM_TXN, FEATURES))
def q_velocity_bands_lineitem(spark, sf):
    return an.velocity_bands(fe.dest_history(L(spark, sf).select(*fe.NARROW), fan_in=False))


@register("threshold_sweep_lineitem", with_ctes("SELECT * FROM sweep", LINEITEM_TXN, SCORED, FIXED, *sweep_ctes("scored")))
def q_threshold_sweep_lineitem(spark, sf):
    return co.threshold_sweep(scorecard(L(spark, sf)))


@register("pr_auc_lineitem", with_ctes(
    "SELECT pr_auc, roc_auc FROM rm", LINEITEM_TXN, SCORED,
    ranking_sql("SELECT 1 AS grp, score AS value, is_fraud AS y FROM scored", None)))
def q_pr_auc_lineitem(spark, sf):
    return rk.ranking_metrics(scorecard(L(spark, sf))).select("pr_auc", "roc_auc")
