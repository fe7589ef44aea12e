"""Registered analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import analysis as an
from riskframe.operators import features as fe
from riskframe.oracles.base import FEATURES, LINEITEM_TXN, TXN, pct, q, with_ctes
from riskframe.plans.catalog import register
from riskframe.sources.fixtures import events_transactions, lineitem_transactions

T = events_transactions


def FT(spark, sf):
    return fe.build_features(T(spark, sf))


def _fsql(body: str) -> str:
    return with_ctes(body, TXN, FEATURES)


_COV_UNION = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM features" for c in fe.MODEL_COLUMNS)


@register("feature_coverage", _fsql(f"""
SELECT feature, {pct('COUNT(v)', 'COUNT(*)')} AS defined_pct,
  {pct('COUNT(*) FILTER (WHERE COALESCE(v, 0.0) <> 0)', 'COUNT(*)')} AS nonzero_pct,
  round(AVG(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median
FROM ({_COV_UNION}) s GROUP BY feature"""))
def q_feature_coverage(spark, sf):
    return an.feature_coverage(FT(spark, sf))


@register("leakage_self_check", _fsql("""
SELECT CAST(COUNT(*) AS BIGINT) AS frames_that_include_the_current_row FROM (
  SELECT ROW_NUMBER() OVER (PARTITION BY name_dest ORDER BY step, txn_id) AS seq, dest_prior_txn_count FROM features) t
WHERE seq = 1 AND dest_prior_txn_count <> 0"""))
def q_leakage_self_check(spark, sf):
    return an.leakage_self_check(FT(spark, sf))


def _avg_int(c):
    return f"CAST(SUM({c}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)"


@register("q1_class_separation", _fsql(f"""
SELECT CASE WHEN is_fraud = 1 THEN 'fraudulent' ELSE 'legitimate' END AS class, COUNT(*) AS transactions,
  {_avg_int('dest_prior_txn_count')} AS avg_dest_prior_txns, {_avg_int('dest_prior_unique_senders')} AS avg_dest_fan_in,
  {_avg_int('dest_txn_prev_24h')} AS avg_dest_velocity_24h, {_avg_int('dest_txn_prev_168h')} AS avg_dest_velocity_168h,
  {_avg_int('pair_prior_txn_count')} AS avg_pair_history,
  CAST(100 AS DOUBLE) * ({_avg_int('pair_is_new')}) AS pct_new_relationship,
  CAST(100 AS DOUBLE) * ({_avg_int('dest_is_new')}) AS pct_new_destination,
  CAST(100 AS DOUBLE) * ({_avg_int('dest_is_merchant')}) AS pct_to_merchant,
  round(AVG(amount_to_type_prior_avg), 6) AS avg_amount_vs_type_avg, {q('amount', 0.5)} AS median_amount
FROM features GROUP BY 1"""))
def q_class_separation(spark, sf):
    return an.class_separation(FT(spark, sf))


_BY_TYPE = f"""
SELECT txn_type, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct,
  CAST(SUM(amount) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS fraud_value,
  {pct('SUM(amount) FILTER (WHERE is_fraud = 1)', 'SUM(amount)')} AS fraud_share_of_value_pct
FROM transactions GROUP BY txn_type"""


@register("q2_fraud_by_type", with_ctes(_BY_TYPE, TXN))
def q_fraud_by_type(spark, sf):
    return an.fraud_by_type(T(spark, sf))


@register("q2_hourly_risk_types", with_ctes(f"""
SELECT CAST((step - 1) % 24 AS INTEGER) AS hour_of_day, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud,
  {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct FROM transactions WHERE txn_type IN ('TRANSFER', 'CASH_OUT') GROUP BY 1""", TXN))
def q_hourly_risk_types(spark, sf):
    from riskframe.functions.derive import risk_type
    from riskframe.operators.audit import hourly_profile
    return hourly_profile(T(spark, sf), where=risk_type())


_Q3 = f"""
SELECT amount_band, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct,
  CAST(SUM(amount) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS fraud_value,
  CAST(1000 AS DOUBLE) * CAST(SUM(amount) FILTER (WHERE is_fraud = 1) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS fraud_value_per_1000_txns
FROM (SELECT CASE WHEN amount < 1000 THEN '1. under 1k' WHEN amount < 10000 THEN '2. 1k-10k'
                  WHEN amount < 50000 THEN '3. 10k-50k' WHEN amount < 200000 THEN '4. 50k-200k'
                  WHEN amount < 1000000 THEN '5. 200k-1M' ELSE '6. 1M+' END AS amount_band, is_fraud, amount
      FROM transactions) b GROUP BY amount_band"""


@register("q3_amount_bands", with_ctes(_Q3, LINEITEM_TXN))
def q_amount_bands(spark, sf):
    """B6 on the lineitem scale fixture (amounts reach every band there)."""
    return an.amount_bands(lineitem_transactions(spark, sf))


def _band_sql(case: str, floor_col: str, label: str) -> str:
    return _fsql(f"""
SELECT {label}, band_floor, transactions, fraud, {pct('fraud', 'transactions')} AS fraud_rate_pct FROM (
  SELECT {case} AS {label}, MIN({floor_col}) AS band_floor, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud
  FROM features GROUP BY 1)""")


_FAN_CASE = ("CASE WHEN dest_prior_unique_senders = 0 THEN '0 senders (first ever)' WHEN dest_prior_unique_senders < 5 "
             "THEN '1-4 senders' WHEN dest_prior_unique_senders < 20 THEN '5-19 senders' WHEN dest_prior_unique_senders < 50 "
             "THEN '20-49 senders' ELSE '50+ senders' END")
_VEL_CASE = ("CASE WHEN dest_txn_prev_24h = 0 THEN '0' WHEN dest_txn_prev_24h = 1 THEN '1' WHEN dest_txn_prev_24h < 5 "
             "THEN '2-4' WHEN dest_txn_prev_24h < 10 THEN '5-9' ELSE '10+' END")


@register("q4_fan_in_bands", _band_sql(_FAN_CASE, "dest_prior_unique_senders", "fan_in_band"))
def q_fan_in_bands(spark, sf):
    return an.fan_in_bands(fe.dest_history(T(spark, sf).select(*fe.NARROW)))


@register("q5_relationship", _fsql(f"""
SELECT CASE WHEN pair_is_new = 1 THEN 'first transaction to this counterparty' ELSE 'existing relationship' END AS relationship,
  COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct
FROM features GROUP BY 1"""))
def q_relationship(spark, sf):
    return an.relationship(fe.pair_history(T(spark, sf).select(*fe.NARROW)))


@register("q6_velocity_bands", _band_sql(_VEL_CASE, "dest_txn_prev_24h", "dest_txns_in_prev_24h"))
def q_velocity_bands(spark, sf):
    """B9, the flagship: events -> transactions -> RANGE velocity -> bands."""
    return an.velocity_bands(fe.dest_history(T(spark, sf).select(*fe.NARROW), fan_in=False))


@register("q7_daily_trend", with_ctes(f"""
SELECT CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS sim_day, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud,
  {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct, CAST(SUM(amount) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS fraud_value
FROM transactions GROUP BY 1""", TXN))
def q_daily_trend(spark, sf):
    return an.daily_trend(T(spark, sf))


SPLIT_SQL = """
split_c AS (SELECT step, SUM(COUNT(*)) OVER (ORDER BY step) AS cum, SUM(COUNT(*)) OVER () AS tot
            FROM transactions GROUP BY step),
bounds AS (SELECT MAX(step) FILTER (WHERE cum * 5 <= tot * 3) AS train_end_step,
                  MAX(step) FILTER (WHERE cum * 5 <= tot * 4) AS validation_end_step, MAX(step) AS test_end_step
           FROM split_c)"""


@register("q8_split_boundaries", with_ctes("SELECT * FROM bounds", TXN, SPLIT_SQL))
def q_split_boundaries(spark, sf):
    return an.split_boundaries(T(spark, sf))


_MED_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", is_fraud, CAST({c} AS DOUBLE) AS v FROM features" for c in an.NOTEBOOK_MEDIAN_COLUMNS)


@register("class_medians", _fsql(f"""
SELECT "column", is_fraud, round(quantile_cont(v, 0.5), 9) AS median FROM ({_MED_UNION}) s
WHERE v IS NOT NULL GROUP BY "column", is_fraud"""))
def q_class_medians(spark, sf):
    return an.class_medians(FT(spark, sf))


@register("q9_rule_queue", _fsql("""
SELECT txn_id, step, txn_type, CAST(amount AS DOUBLE) AS amount, dest_prior_txn_count, dest_prior_unique_senders,
  dest_txn_prev_24h, pair_is_new, is_fraud
FROM features WHERE txn_type IN ('TRANSFER', 'CASH_OUT') AND pair_is_new = 1 ORDER BY amount DESC, txn_id LIMIT 50"""))
def q_rule_queue(spark, sf):
    return an.rule_queue(FT(spark, sf))


@register("risk_type_filter", with_ctes(
    "SELECT txn_id, CAST(amount AS DOUBLE) AS amount, is_fraud FROM transactions WHERE txn_type IN ('TRANSFER','CASH_OUT')", TXN))
def q_risk_type_filter(spark, sf):
    """P16 as a pushed-down filter."""
    from riskframe.functions.derive import risk_type
    return T(spark, sf).where(risk_type()).select("txn_id", F.col("amount").cast("double").alias("amount"), "is_fraud")
