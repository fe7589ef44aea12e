"""Registered ranking queries (M6-M10, T2) on the deterministic scorecard."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import ranking as rk
from riskframe.operators.model import split_steps
from riskframe.oracles.base import SCORED, TXN, with_ctes
from riskframe.plans.catalog import register
from riskframe.plans.q_analysis import SPLIT_SQL
from riskframe.plans.q_audit import confusion_ratios_sql, ranking_sql
from riskframe.sources.fixtures import events_transactions, scorecard


def S(spark, sf):
    return scorecard(events_transactions(spark, sf))


_RANK = ranking_sql("SELECT 1 AS grp, score AS value, is_fraud AS y FROM scored", None)


@register("pr_auc", with_ctes("SELECT pr_auc, pr_auc_no_skill_baseline, pr_auc_lift_over_no_skill FROM rm", TXN, SCORED, _RANK))
def q_pr_auc(spark, sf):
    return rk.ranking_metrics(S(spark, sf)).select("pr_auc", "pr_auc_no_skill_baseline", "pr_auc_lift_over_no_skill")


@register("roc_auc", with_ctes("SELECT roc_auc FROM rm", TXN, SCORED, _RANK))
def q_roc_auc(spark, sf):
    return rk.ranking_metrics(S(spark, sf)).select("roc_auc")


_CONF = ("SELECT CAST(COUNT(*) FILTER (WHERE score >= 0.5 AND is_fraud = 1) AS BIGINT) AS TP, "
         "CAST(COUNT(*) FILTER (WHERE score >= 0.5 AND is_fraud = 0) AS BIGINT) AS FP, "
         "CAST(COUNT(*) FILTER (WHERE NOT score >= 0.5 AND is_fraud = 1) AS BIGINT) AS FN, "
         "CAST(COUNT(*) FILTER (WHERE NOT score >= 0.5 AND is_fraud = 0) AS BIGINT) AS TN FROM scored")


@register("binary_metrics", with_ctes(confusion_ratios_sql(_CONF), TXN, SCORED))
def q_binary_metrics(spark, sf):
    return rk.binary_metrics(S(spark, sf), 0.5)


_TWO_MODELS = """
models AS (
  SELECT 'scorecard_a' AS model, score, is_fraud, step FROM scored
  UNION ALL
  SELECT 'scorecard_b', CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + CAST(50 AS DOUBLE))
     * CASE WHEN txn_type IN ('TRANSFER','CASH_OUT') THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END, is_fraud, step
  FROM transactions),
val AS (SELECT m.* FROM models m, bounds WHERE m.step > bounds.train_end_step AND m.step <= bounds.validation_end_step)"""

_CMP_CONF = ("SELECT model, CAST(COUNT(*) FILTER (WHERE score >= 0.5 AND is_fraud = 1) AS BIGINT) AS TP, "
             "CAST(COUNT(*) FILTER (WHERE score >= 0.5 AND is_fraud = 0) AS BIGINT) AS FP, "
             "CAST(COUNT(*) FILTER (WHERE NOT score >= 0.5 AND is_fraud = 1) AS BIGINT) AS FN, "
             "CAST(COUNT(*) FILTER (WHERE NOT score >= 0.5 AND is_fraud = 0) AS BIGINT) AS TN FROM val GROUP BY model")
_CMP_COLS = ["TP", "FP", "FN", "TN", "accuracy", "precision", "recall", "fraud_capture_rate", "f1",
             "false_positive_rate", "alert_volume", "alert_rate"]


@register("compare_models", with_ctes(f"""
SELECT rm.model, roc_auc, pr_auc, pr_auc_no_skill_baseline, pr_auc_lift_over_no_skill,
  {", ".join(f"b.{c} AS at_0_5_{c}" for c in _CMP_COLS)},
  ROW_NUMBER() OVER (ORDER BY pr_auc DESC NULLS LAST, rm.model) AS selection_rank
FROM rm JOIN ({confusion_ratios_sql(_CMP_CONF)}) b ON rm.model = b.model""",
    TXN, SCORED, SPLIT_SQL, _TWO_MODELS, ranking_sql("SELECT model, score AS value, is_fraud AS y FROM val", "model")))
def q_compare_models(spark, sf):
    """M9 on the validation split with two fixed scorecards (the selection rule is the same)."""
    t = events_transactions(spark, sf)
    tr, ve, _ = split_steps(t)
    val = t.where((F.col("step") > tr) & (F.col("step") <= ve))
    a = scorecard(val).select(F.lit("scorecard_a").alias("model"), "score", "is_fraud")
    b = scorecard(val, pivot=50.0, low_weight=0.5).select(F.lit("scorecard_b").alias("model"), "score", "is_fraud")
    return rk.compare_models(a.unionByName(b))


@register("top_k_capture", with_ctes("""
SELECT f AS review_fraction, reviewed AS transactions_reviewed, captured AS fraud_captured,
  CAST(captured AS DOUBLE) / CAST(greatest(P, 1) AS DOUBLE) AS fraud_capture_rate,
  CAST(captured AS DOUBLE) / CAST(reviewed AS DOUBLE) AS precision_in_queue
FROM (SELECT f, reviewed, ANY_VALUE(P) AS P, CAST(SUM(is_fraud) FILTER (WHERE rn <= reviewed) AS BIGINT) AS captured
      FROM (SELECT is_fraud, ROW_NUMBER() OVER (ORDER BY score DESC, txn_id) AS rn, SUM(is_fraud) OVER () AS P,
                   COUNT(*) OVER () AS n FROM scored) r,
           (SELECT unnest([0.001, 0.005, 0.01, 0.02, 0.05]::DOUBLE[]) AS f) fr,
           LATERAL (SELECT greatest(CAST(floor(f * CAST(n AS DOUBLE)) AS BIGINT), 1) AS reviewed) x
      GROUP BY f, reviewed)""", TXN, SCORED))
def q_top_k_capture(spark, sf):
    return rk.top_k_capture(S(spark, sf))


_THIN = """(L <= 500 OR i IN (SELECT CAST(floor(CAST(j AS DOUBLE) * ((CAST(L AS DOUBLE) - 1) / CAST(499 AS DOUBLE))) AS BIGINT)
  FROM range(500) t(j)))"""


@register("curve_points", with_ctes(f"""
SELECT 'roc' AS curve, i AS point_index, threshold, x, y FROM roc WHERE {_THIN}
UNION ALL SELECT 'pr', i, threshold, x, y FROM pr WHERE {_THIN}""", TXN, SCORED, """pts AS (
  SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS cp, SUM(n) OVER (ORDER BY score DESC) AS cn, SUM(pos) OVER () AS p,
    SUM(n) OVER () AS t, ROW_NUMBER() OVER (ORDER BY score) - 1 AS up, COUNT(*) OVER () AS d,
    LEAD(pos) OVER (ORDER BY score DESC) AS pos2, LEAD(n) OVER (ORDER BY score DESC) AS n2, ROW_NUMBER() OVER (ORDER BY score DESC) AS dn
  FROM (SELECT score, SUM(is_fraud) AS pos, COUNT(*) AS n FROM scored GROUP BY 1))""", """roc AS (
  SELECT *, COUNT(*) OVER () AS L FROM (
    SELECT ROW_NUMBER() OVER (ORDER BY score DESC) AS i, score AS threshold,
      CASE WHEN t > p THEN CAST(cn - cp AS DOUBLE) / CAST(t - p AS DOUBLE) END AS x,
      CASE WHEN p > 0 THEN CAST(cp AS DOUBLE) / CAST(p AS DOUBLE) END AS y
    FROM pts WHERE dn = 1 OR pos2 IS NULL OR pos2 <> pos OR n2 <> n
    UNION ALL SELECT 0, NULL, 0.0, 0.0))""", """pr AS (
  SELECT *, COUNT(*) OVER () AS L FROM (
    SELECT up AS i, score AS threshold, CASE WHEN p > 0 THEN CAST(cp AS DOUBLE) / CAST(p AS DOUBLE) END AS x,
      CAST(cp AS DOUBLE) / CAST(cn AS DOUBLE) AS y FROM pts
    UNION ALL SELECT MAX(d), NULL, 0.0, 1.0 FROM pts))"""))
def q_curve_points(spark, sf):
    return rk.curve_points(S(spark, sf))


@register("compare_models_one_class", with_ctes("""
SELECT model, roc_auc, pr_auc, pr_auc_no_skill_baseline, pr_auc_lift_over_no_skill FROM rm""",
    TXN, SCORED, """val AS (SELECT 'all_negative' AS model, score, 0 AS is_fraud FROM scored
      UNION ALL SELECT 'all_positive', score, 1 FROM scored UNION ALL SELECT 'mixed', score, is_fraud FROM scored)""",
    ranking_sql("SELECT model, score AS value, is_fraud AS y FROM val", "model")))
def q_compare_models_one_class(spark, sf):
    """M6, M7 with groups that hold one class only: their metrics are NULL."""
    s = S(spark, sf)
    sets = [s.select(F.lit(m).alias("model"), "score", F.lit(y).alias("is_fraud") if y is not None else F.col("is_fraud"))
            for m, y in (("all_negative", 0), ("all_positive", 1), ("mixed", None))]
    return rk.ranking_metrics(sets[0].unionByName(sets[1]).unionByName(sets[2]), group_cols=["model"])
