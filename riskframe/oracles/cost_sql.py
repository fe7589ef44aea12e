"""DuckDB oracle builders for the sweep family (plain cross join of grid x scores)."""

from __future__ import annotations

from riskframe.config import DEFAULT
from riskframe.operators.cost import quantile_levels


def _dbl_list(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::DOUBLE[]"


FIXED = f"fixed AS (SELECT unnest({_dbl_list(DEFAULT.fixed_thresholds())}) AS threshold)"


def grid_ctes(src: str, p: str, extra: str | None = None) -> str:
    """CTEs `{p}grid(threshold, grid_source)` over scores of view `src`; `extra` = SQL for a 1-row threshold."""
    levels = _dbl_list(quantile_levels())
    out = f"""
{p}qt AS (SELECT DISTINCT greatest(least(round(v, 9), CAST(0.999999 AS DOUBLE)), CAST(1e-6 AS DOUBLE)) AS threshold
          FROM (SELECT unnest(quantile_cont(score, {levels})) AS v FROM {src})),
{p}grid0 AS (SELECT threshold, 'fixed' AS grid_source FROM fixed
          UNION ALL SELECT threshold, 'quantile' FROM {p}qt WHERE round(threshold, 4) NOT IN (SELECT threshold FROM fixed))"""
    if extra:
        out += f""",
{p}grid AS (SELECT * FROM {p}grid0 UNION ALL
          SELECT threshold, 'chosen' FROM ({extra}) e WHERE threshold NOT IN (SELECT threshold FROM {p}grid0))"""
    else:
        out += f", {p}grid AS (SELECT * FROM {p}grid0)"
    return out


def counts_cte(src: str, p: str) -> str:
    return f"""
{p}cnt AS (SELECT g.threshold, g.grid_source,
   CAST(COUNT(*) FILTER (WHERE s.score >= g.threshold AND s.is_fraud = 1) AS BIGINT) AS TP,
   CAST(COUNT(*) FILTER (WHERE NOT (s.score >= g.threshold) AND s.is_fraud = 0) AS BIGINT) AS TN,
   CAST(COUNT(*) FILTER (WHERE s.score >= g.threshold AND s.is_fraud = 0) AS BIGINT) AS FP,
   CAST(COUNT(*) FILTER (WHERE NOT (s.score >= g.threshold) AND s.is_fraud = 1) AS BIGINT) AS FN,
   CAST(COUNT(*) AS BIGINT) AS n_rows
 FROM {p}grid g CROSS JOIN {src} s GROUP BY g.threshold, g.grid_source)"""


def metrics_cte(p: str, cost_fn: float, cost_fp: float, name: str | None = None) -> str:
    def safe(a, b):
        return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"
    prec, rec = safe("TP", "TP + FP"), safe("TP", "TP + FN")
    cm = f"CAST(FN AS DOUBLE) * CAST({float(cost_fn)!r} AS DOUBLE)"
    cf = f"CAST(FP AS DOUBLE) * CAST({float(cost_fp)!r} AS DOUBLE)"
    return f"""
{name or p + 'sweep'} AS (SELECT threshold, grid_source, TP, TN, FP, FN, {prec} AS precision, {rec} AS recall,
   {rec} AS fraud_capture_rate, {safe('FP', 'FP + TN')} AS false_positive_rate,
   CASE WHEN {prec} + {rec} > 0 THEN CAST(2 AS DOUBLE) * {prec} * {rec} / ({prec} + {rec}) ELSE 0.0 END AS f1,
   FP AS legitimate_transactions_blocked, FN AS fraud_missed, TP + FP AS alert_volume,
   CAST(TP + FP AS DOUBLE) / CAST(n_rows AS DOUBLE) AS alert_rate, {cm} AS cost_missed_fraud,
   {cf} AS cost_customer_friction, {cm} + {cf} AS total_cost FROM {p}cnt)"""


def sweep_ctes(src: str, p: str = "", cost_fn: float = DEFAULT.cost_fn, cost_fp: float = DEFAULT.cost_fp,
               extra: str | None = None) -> list[str]:
    """All CTEs for `{p}sweep` (requires FIXED among the CTEs)."""
    return [grid_ctes(src, p, extra), counts_cte(src, p), metrics_cte(p, cost_fn, cost_fp)]


def summary_sql(sweep: str, best: str, cost_fn: float = DEFAULT.cost_fn, cost_fp: float = DEFAULT.cost_fp) -> str:
    """C3/C4 summary from a 1-row `best` relation (a sweep row) and the sweep's 0.50 row."""
    return f"""
SELECT b.threshold AS optimal_threshold, b.total_cost AS total_cost_at_optimum, b.cost_missed_fraud,
  b.cost_customer_friction, b.TP, b.FP, b.FN, b.TN, b.precision, b.recall, b.fraud_capture_rate,
  b.false_positive_rate, b.legitimate_transactions_blocked, b.alert_volume, b.alert_rate,
  h.total_cost AS cost_at_threshold_0_50, h.total_cost - b.total_cost AS cost_reduction_vs_0_50,
  CASE WHEN h.total_cost <> 0 THEN CAST(100 AS DOUBLE) * (h.total_cost - b.total_cost) / h.total_cost ELSE 0.0 END
    AS cost_reduction_vs_0_50_pct,
  CAST(b.TP + b.FN AS DOUBLE) * CAST({float(cost_fn)!r} AS DOUBLE) AS cost_if_no_intervention,
  CAST(b.TN + b.FP AS DOUBLE) * CAST({float(cost_fp)!r} AS DOUBLE) AS cost_if_block_everything
FROM ({best}) b,
     (SELECT total_cost FROM {sweep} ORDER BY abs(threshold - CAST(0.5 AS DOUBLE)), threshold LIMIT 1) h"""
