"""Registered cost-model queries (C1-C8, J5, J6, U3) on the deterministic scorecard."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.config import DEFAULT
from riskframe.operators import cost as co
from riskframe.operators.model import split_steps
from riskframe.oracles.base import SCORED, TXN, with_ctes
from riskframe.oracles.cost_sql import FIXED, metrics_cte, summary_sql, sweep_ctes, counts_cte, grid_ctes
from riskframe.plans.catalog import register
from riskframe.plans.q_analysis import SPLIT_SQL
from riskframe.sources.fixtures import events_transactions, scorecard


def S(spark, sf):
    return scorecard(events_transactions(spark, sf))


_GRID = with_ctes("SELECT threshold, grid_source FROM grid", TXN, SCORED, FIXED, grid_ctes("scored", ""))


@register("threshold_grid", _GRID)
def q_threshold_grid(spark, sf):
    return co.threshold_grid(S(spark, sf))


@register("grid_union", _GRID)
def q_grid_union(spark, sf):
    """Fixed grid UNION quantiles after an anti join on the 4-dp rounded value."""
    return co.threshold_grid(S(spark, sf))


_SWEEP = with_ctes("SELECT * FROM sweep", TXN, SCORED, FIXED, *sweep_ctes("scored"))


@register("threshold_sweep", _SWEEP)
def q_threshold_sweep(spark, sf):
    return co.threshold_sweep(S(spark, sf))


@register("score_vs_threshold", with_ctes("SELECT threshold, TP, FP FROM cnt", TXN, SCORED, FIXED,
                                          grid_ctes("scored", ""), counts_cte("scored", "")))
def q_score_vs_threshold(spark, sf):
    """The theta relation score >= t for every t, as bucketed counts (no theta join)."""
    s = S(spark, sf)
    return co.sweep_counts(s, co.threshold_grid(s)).select("threshold", "TP", "FP")


@register("optimal_threshold", with_ctes(summary_sql("sweep", "SELECT * FROM sweep ORDER BY total_cost, threshold LIMIT 1"),
                                         TXN, SCORED, FIXED, *sweep_ctes("scored")))
def q_optimal_threshold(spark, sf):
    return co.optimal_threshold(co.threshold_sweep(S(spark, sf)))


_VAL_TEST = """
val AS (SELECT s.* FROM scored s, bounds WHERE s.step > bounds.train_end_step AND s.step <= bounds.validation_end_step),
tst AS (SELECT s.* FROM scored s, bounds WHERE s.step > bounds.validation_end_step)"""
_CHOSEN = "SELECT threshold FROM v_sweep ORDER BY total_cost, threshold LIMIT 1"


@register("summarise_at", with_ctes(
    summary_sql("t_sweep", f"SELECT * FROM t_sweep ORDER BY abs(threshold - ({_CHOSEN})), threshold LIMIT 1"),
    TXN, SCORED, SPLIT_SQL, _VAL_TEST, FIXED, *sweep_ctes("val", "v_"), *sweep_ctes("tst", "t_", extra=_CHOSEN)))
def q_summarise_at(spark, sf):
    """C4: threshold chosen on validation, reported on test (chosen value added to the test grid, D12)."""
    s = S(spark, sf)
    tr, ve, _ = split_steps(s)
    val = s.where((F.col("step") > tr) & (F.col("step") <= ve))
    tst = s.where(F.col("step") > ve)
    chosen = co.threshold_sweep(val).orderBy("total_cost", "threshold").limit(1).select("threshold")
    t = float(chosen.first()["threshold"])  # one control value
    return co.summarise_at(co.threshold_sweep(tst, extra_thresholds=[t]), t)


_BAND_VALUES = ", ".join(f"({i}, '{b}', '{a}', '{co.band_rationale()[b]}')" for i, (b, a) in enumerate(co.BAND_ACTIONS))


def _band_sql() -> str:
    block = "SELECT threshold FROM b_sweep ORDER BY total_cost, threshold LIMIT 1"
    verify = "SELECT threshold FROM r_sweep ORDER BY total_cost, threshold LIMIT 1"
    return with_ctes(f"""
SELECT band_order, band, CASE band WHEN 'LOW' THEN 0.0 WHEN 'MEDIUM' THEN v ELSE h END AS lower_bound,
  CASE band WHEN 'LOW' THEN v WHEN 'MEDIUM' THEN h ELSE NULL END AS upper_bound, action, rationale,
  v AS medium_risk_threshold_verify, h AS high_risk_threshold_block
FROM (SELECT ({block}) AS h, least(({verify}), ({block})) AS v) t,
     (VALUES {_BAND_VALUES}) a(band_order, band, action, rationale)""",
        TXN, SCORED, FIXED, grid_ctes("scored", ""), counts_cte("scored", ""),
        metrics_cte("", DEFAULT.cost_fn, DEFAULT.cost_fp, "b_sweep"),
        metrics_cte("", DEFAULT.cost_fn, DEFAULT.cost_verify, "r_sweep"))


@register("risk_bands", _band_sql())
def q_risk_bands(spark, sf):
    return co.risk_bands(S(spark, sf))


_SCEN = ("scen AS (SELECT CAST(a AS DOUBLE) AS cost_false_negative, CAST(b AS DOUBLE) AS cost_false_positive "
         "FROM unnest([100, 250, 500, 750, 1000]) x(a), unnest([5, 10, 25, 50, 100]) y(b))")
_SENS = """
sens AS (SELECT cost_false_negative, cost_false_positive, cost_false_negative / cost_false_positive AS cost_ratio_fn_over_fp,
   threshold AS optimal_threshold, sc AS total_cost, TP, FP, FN, TN, fraud_capture_rate, precision, false_positive_rate,
   legitimate_transactions_blocked, fraud_missed, alert_rate
 FROM (SELECT s.*, scen.*, CAST(FN AS DOUBLE) * cost_false_negative + CAST(FP AS DOUBLE) * cost_false_positive AS sc,
         ROW_NUMBER() OVER (PARTITION BY cost_false_negative, cost_false_positive
                            ORDER BY CAST(FN AS DOUBLE) * cost_false_negative + CAST(FP AS DOUBLE) * cost_false_positive, threshold) AS r
       FROM sweep s CROSS JOIN scen) WHERE r = 1)"""
_SENS_CTES = (TXN, SCORED, FIXED, *sweep_ctes("scored", "", 1.0, 1.0), _SCEN, _SENS)


@register("sensitivity_grid", with_ctes("SELECT * FROM sens", *_SENS_CTES))
def q_sensitivity_grid(spark, sf):
    return co.sensitivity_grid(S(spark, sf))


@register("scenario_cross", with_ctes(
    "SELECT threshold, cost_false_negative, cost_false_positive, "
    "CAST(FN AS DOUBLE) * cost_false_negative + CAST(FP AS DOUBLE) * cost_false_positive AS scenario_cost "
    "FROM sweep CROSS JOIN scen", TXN, SCORED, FIXED, *sweep_ctes("scored", "", 1.0, 1.0), _SCEN))
def q_scenario_cross(spark, sf):
    """Every scenario against every sweep row (25 x <=180 rows, broadcast cross join)."""
    s = S(spark, sf)
    base = co.with_sweep_metrics(co.sweep_counts(s, co.threshold_grid(s)), 1.0, 1.0)
    sc = spark.createDataFrame([(float(a), float(b)) for a in DEFAULT.sensitivity_fn_costs for b in DEFAULT.sensitivity_fp_costs],
                               "cost_false_negative double, cost_false_positive double")
    x = base.crossJoin(F.broadcast(sc))
    return x.select("threshold", "cost_false_negative", "cost_false_positive",
                    (F.col("FN").cast("double") * F.col("cost_false_negative")
                     + F.col("FP").cast("double") * F.col("cost_false_positive")).alias("scenario_cost"))


@register("threshold_matrix", with_ctes(
    "SELECT cost_false_negative, " + ", ".join(
        f"MAX(optimal_threshold) FILTER (WHERE cost_false_positive = {c}) AS fp_{int(c)}" for c in DEFAULT.sensitivity_fp_costs)
    + " FROM sens GROUP BY cost_false_negative", *_SENS_CTES))
def q_threshold_matrix(spark, sf):
    return co.threshold_matrix(co.sensitivity_grid(S(spark, sf)))


@register("sensitivity_summary", with_ctes("""
SELECT COUNT(*) AS scenarios_tested, MIN(optimal_threshold) AS threshold_min, MAX(optimal_threshold) AS threshold_max,
  MAX(optimal_threshold) - MIN(optimal_threshold) AS threshold_spread, median(optimal_threshold) AS threshold_median,
  MIN(fraud_capture_rate) AS fraud_capture_rate_min, MAX(fraud_capture_rate) AS fraud_capture_rate_max,
  MIN(legitimate_transactions_blocked) AS legitimate_blocked_min, MAX(legitimate_transactions_blocked) AS legitimate_blocked_max,
  CASE WHEN (SELECT arg_max(m, r) FROM br) < (SELECT arg_min(m, r) FROM br) THEN 'falls' ELSE 'rises' END AS direction_with_rising_fn_fp_ratio
FROM sens""", *_SENS_CTES, "br AS (SELECT cost_ratio_fn_over_fp AS r, AVG(optimal_threshold) AS m FROM sens GROUP BY 1)"))
def q_sensitivity_summary(spark, sf):
    return co.sensitivity_summary(co.sensitivity_grid(S(spark, sf)))
