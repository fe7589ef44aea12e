"""Registered dashboard / figure queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.config import DEFAULT
from riskframe.models import compiled as cm
from riskframe.models import frozen
from riskframe.operators import dashboard as db
from riskframe.operators import features as fe
from riskframe.oracles.base import FEATURES, LINEITEM_TXN, TXN, cnt, pct, with_ctes
from riskframe.oracles.cost_sql import FIXED, counts_cte, grid_ctes, metrics_cte, summary_sql, sweep_ctes
from riskframe.plans.catalog import register
from riskframe.session import cached
from riskframe.plans.q_analysis import SPLIT_SQL
from riskframe.plans.q_audit import ranking_sql
from riskframe.sources.fixtures import events_transactions, lineitem_transactions, scorecard

_SCORE = ("CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + CAST(250 AS DOUBLE)) * CASE WHEN txn_type IN "
          "('TRANSFER','CASH_OUT') THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END")
_BEST = "SELECT threshold FROM {t} ORDER BY total_cost, threshold LIMIT 1"


def decide_ctes(base: str, score: str = _SCORE) -> list[str]:
    """SQL twin of operators.dashboard.decide over relation `base`."""
    return [
        f"sc AS (SELECT b.*, {score} AS score FROM {base} b)", SPLIT_SQL,
        "val AS (SELECT s.* FROM sc s, bounds WHERE s.step > bounds.train_end_step AND s.step <= bounds.validation_end_step)",
        "tst AS (SELECT s.* FROM sc s, bounds WHERE s.step > bounds.validation_end_step)",
        FIXED, grid_ctes("val", "v_"), counts_cte("val", "v_"),
        metrics_cte("v_", DEFAULT.cost_fn, DEFAULT.cost_fp, "v_block"),
        metrics_cte("v_", DEFAULT.cost_fn, DEFAULT.cost_verify, "v_verify"),
        f"dec AS (SELECT ({_BEST.format(t='v_block')}) AS h, least(({_BEST.format(t='v_verify')}), ({_BEST.format(t='v_block')})) AS v)",
        """st AS (SELECT tst.*, score AS fraud_probability, CASE WHEN score >= h THEN 1 ELSE 0 END AS predicted_flag,
             CASE WHEN score >= h THEN 'HIGH' WHEN score >= v THEN 'MEDIUM' ELSE 'LOW' END AS risk_band FROM tst, dec)""",
        """scd AS (SELECT st.*, CASE WHEN predicted_flag = 1 AND is_fraud = 1 THEN 'true_positive'
               WHEN predicted_flag = 1 AND is_fraud = 0 THEN 'false_positive'
               WHEN predicted_flag = 0 AND is_fraud = 1 THEN 'false_negative' ELSE 'true_negative' END AS outcome_class,
             CASE WHEN amount IS NULL OR amount < 0 THEN NULL WHEN amount < 1000 THEN '0-1k' WHEN amount < 10000 THEN '1k-10k'
               WHEN amount < 50000 THEN '10k-50k' WHEN amount < 200000 THEN '50k-200k' WHEN amount < 1000000 THEN '200k-1M'
               ELSE '1M+' END AS amount_band FROM st)""",
    ]


def _ev_sql(body: str, *more: str) -> str:
    return with_ctes(body, TXN, FEATURES, *decide_ctes("features"), *more)


def _li_sql(body: str, *more: str) -> str:
    return with_ctes(body, LINEITEM_TXN, *decide_ctes("transactions"), *more)


def _ev(spark, sf):
    t = events_transactions(spark, sf)
    return db.decide(scorecard(fe.build_features(t)), thin=scorecard(t))


def _ev_txn(spark, sf):
    return db.decide(scorecard(events_transactions(spark, sf)))


def _li(spark, sf):
    return db.decide(cached(scorecard(lineitem_transactions(spark, sf))))


_D1_COLS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "amount" else c for c in db.CONTEXT_COLUMNS)


@register("scored_table", _ev_sql(f"SELECT {_D1_COLS} FROM scd"))
def q_scored_table(spark, sf):
    return db.scored_table(_ev(spark, sf))


_T_SWEEP = sweep_ctes("tst", "t_", extra="SELECT h AS threshold FROM dec")


_KPI = f"""
SELECT k.total_transactions, k.total_fraud_transactions, {pct('k.total_fraud_transactions', 'k.total_transactions')} AS fraud_rate_pct,
  k.total_transaction_value, k.fraudulent_transaction_value, o.optimal_threshold AS selected_threshold,
  CAST(100 AS DOUBLE) * o.fraud_capture_rate AS fraud_capture_rate_pct,
  CAST(100 AS DOUBLE) * o.false_positive_rate AS false_positive_rate_pct, CAST(100 AS DOUBLE) * o.precision AS precision_pct,
  k.alerts_raised, o.FP AS legitimate_transactions_blocked, o.FN AS fraud_missed,
  o.total_cost_at_optimum AS simulated_total_cost, o.cost_missed_fraud AS simulated_cost_missed_fraud,
  o.cost_customer_friction AS simulated_cost_customer_friction, o.cost_at_threshold_0_50 AS simulated_cost_at_threshold_0_50,
  rm.roc_auc AS model_roc_auc, rm.pr_auc AS model_pr_auc, CAST(500 AS DOUBLE) AS cost_assumption_false_negative,
  CAST(25 AS DOUBLE) AS cost_assumption_false_positive, 'SIMULATED / ESTIMATED UNDER ASSUMPTIONS' AS cost_basis
FROM (SELECT COUNT(*) AS total_transactions, CAST(SUM(is_fraud) AS BIGINT) AS total_fraud_transactions,
        CAST(SUM(amount) AS DOUBLE) AS total_transaction_value,
        CAST(SUM(amount) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS fraudulent_transaction_value,
        CAST(SUM(predicted_flag) AS BIGINT) AS alerts_raised FROM scd) k,
     ({summary_sql('t_sweep', 'SELECT * FROM t_sweep ORDER BY abs(threshold - (SELECT h FROM dec)), threshold LIMIT 1')}) o, rm"""
_KPI_CTES = (*_T_SWEEP, ranking_sql("SELECT 1 AS grp, score AS value, is_fraud AS y FROM tst", None))


@register("kpi_summary", _ev_sql(_KPI, *_KPI_CTES))
def q_kpi_summary(spark, sf):
    return db.kpi_summary(_ev(spark, sf))


def _frozen(spark, sf):
    """The decision context of the frozen logistic regression: thresholds and bands from its validation scores."""
    rows = fe.build_features(events_transactions(spark, sf)).withColumn("score", F.round(cm.score(frozen.logreg()), 9))
    return db.decide(cached(rows))


def _frozen_sql(body: str, *more: str) -> str:
    return with_ctes(body, TXN, FEATURES, *decide_ctes("features", f"round({cm.score_sql(frozen.logreg())}, 9)"), *more)


@register("frozen_kpi_summary", _frozen_sql(_KPI, *_KPI_CTES))
def q_frozen_kpi_summary(spark, sf):
    """D2 on a model's scores instead of the scorecard's."""
    return db.kpi_summary(_frozen(spark, sf))


@register("frozen_scored_table", _frozen_sql(f"SELECT {_D1_COLS} FROM scd"))
def q_frozen_scored_table(spark, sf):
    """D1 on a model's scores instead of the scorecard's."""
    return db.scored_table(_frozen(spark, sf))


@register("threshold_cost_curve", _ev_sql("SELECT * FROM t_sweep", *_T_SWEEP))
def q_threshold_cost_curve(spark, sf):
    return db.threshold_cost_curve(_ev_txn(spark, sf))


_SENS_T = [grid_ctes("tst", "u_"), counts_cte("tst", "u_"), metrics_cte("u_", 1.0, 1.0, "u_sweep"),
           "scen AS (SELECT CAST(a AS DOUBLE) AS cost_false_negative, CAST(b AS DOUBLE) AS cost_false_positive "
           "FROM unnest([100, 250, 500, 750, 1000]) x(a), unnest([5, 10, 25, 50, 100]) y(b))"]


@register("cost_sensitivity", _ev_sql("""
SELECT cost_false_negative, cost_false_positive, cost_false_negative / cost_false_positive AS cost_ratio_fn_over_fp,
  threshold AS optimal_threshold, sc AS total_cost, TP, FP, FN, TN, fraud_capture_rate, precision, false_positive_rate,
  legitimate_transactions_blocked, fraud_missed, alert_rate
FROM (SELECT s.*, scen.*, CAST(FN AS DOUBLE) * cost_false_negative + CAST(FP AS DOUBLE) * cost_false_positive AS sc,
        ROW_NUMBER() OVER (PARTITION BY cost_false_negative, cost_false_positive
          ORDER BY CAST(FN AS DOUBLE) * cost_false_negative + CAST(FP AS DOUBLE) * cost_false_positive, threshold) AS r
      FROM u_sweep s CROSS JOIN scen) WHERE r = 1""", *_SENS_T))
def q_cost_sensitivity(spark, sf):
    return db.cost_sensitivity(_ev_txn(spark, sf))


@register("fraud_by_type", _ev_sql(f"""
SELECT txn_type, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, CAST(SUM(amount) AS DOUBLE) AS total_amount,
  CAST(COALESCE(SUM(amount) FILTER (WHERE is_fraud = 1), 0) AS DOUBLE) AS fraud_amount, CAST(SUM(predicted_flag) AS BIGINT) AS alerts,
  {cnt("outcome_class = 'false_positive'")} AS false_positives, {cnt("outcome_class = 'true_positive'")} AS true_positives,
  {cnt("outcome_class = 'false_negative'")} AS false_negatives, {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct,
  {pct("COUNT(*) FILTER (WHERE outcome_class = 'false_positive')", 'COUNT(*) - SUM(is_fraud)')} AS false_positive_rate_pct
FROM scd GROUP BY txn_type"""))
def q_fraud_by_type(spark, sf):
    return db.fraud_by_type(_ev_txn(spark, sf).scored_test)


@register("fraud_over_time", _ev_sql(f"""
SELECT step, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, CAST(SUM(predicted_flag) AS BIGINT) AS alerts,
  CAST(SUM(amount) AS DOUBLE) AS total_amount, {cnt("outcome_class = 'true_positive'")} AS true_positive,
  {cnt("outcome_class = 'false_positive'")} AS false_positive, {cnt("outcome_class = 'false_negative'")} AS false_negative,
  {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct FROM scd GROUP BY step"""))
def q_fraud_over_time(spark, sf):
    return db.fraud_over_time(_ev_txn(spark, sf).scored_test)


@register("outcomes_by_step_join", _ev_sql(f"""
SELECT step, COUNT(*) AS transactions, {cnt("outcome_class = 'true_positive'")} AS true_positive,
  {cnt("outcome_class = 'false_positive'")} AS false_positive, {cnt("outcome_class = 'false_negative'")} AS false_negative
FROM scd GROUP BY step"""))
def q_outcomes_by_step_join(spark, sf):
    return db.outcomes_by_step_join(_ev_txn(spark, sf).scored_test)


@register("false_positive_profile", _li_sql(f"""
SELECT txn_type, amount_band, COUNT(*) AS legitimate_transactions, {cnt("outcome_class = 'false_positive'")} AS false_positives,
  CAST(SUM(amount) AS DOUBLE) AS legitimate_value,
  {pct("COUNT(*) FILTER (WHERE outcome_class = 'false_positive')", 'COUNT(*)')} AS false_positive_rate_pct,
  CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS DOUBLE) * CAST(25 AS DOUBLE) AS simulated_friction_cost
FROM scd WHERE is_fraud = 0 GROUP BY txn_type, amount_band"""))
def q_false_positive_profile(spark, sf):
    return db.false_positive_profile(_li(spark, sf).scored_test)


_BANDDEF = f"""
SELECT a.band_order, a.band, CASE a.band WHEN 'LOW' THEN 0.0 WHEN 'MEDIUM' THEN v ELSE h END AS lower_bound,
  CASE a.band WHEN 'LOW' THEN v WHEN 'MEDIUM' THEN h ELSE NULL END AS upper_bound, a.action,
  CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions_in_band, CAST(COALESCE(c.f, 0) AS BIGINT) AS fraud_in_band,
  {pct('COALESCE(c.f, 0)', 'COALESCE(c.n, 0)')} AS fraud_rate_in_band_pct
FROM (VALUES (0, 'LOW', 'allow without friction'), (1, 'MEDIUM', 'step-up verification / manual review'),
             (2, 'HIGH', 'block / hard decline')) a(band_order, band, action)
CROSS JOIN dec
LEFT JOIN (SELECT risk_band, COUNT(*) AS n, SUM(is_fraud) AS f FROM scd GROUP BY risk_band) c ON c.risk_band = a.band"""


@register("risk_band_definition", _ev_sql(_BANDDEF))
def q_risk_band_definition(spark, sf):
    return db.risk_band_definition(_ev_txn(spark, sf))


@register("band_lookup", _ev_sql(_BANDDEF))
def q_band_lookup(spark, sf):
    """Band definitions left-joined with per-band counts."""
    return db.risk_band_definition(_ev_txn(spark, sf))


@register("friction_summary", _ev_sql(f"""
WITH bt AS (SELECT txn_type, COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS fps, COUNT(*) AS n
            FROM scd WHERE is_fraud = 0 GROUP BY txn_type),
w AS (SELECT * FROM bt ORDER BY fps DESC, txn_type LIMIT 1)
SELECT t.total_false_positives, {pct('t.total_false_positives', 't.n')} AS false_positive_rate_pct,
  CAST(t.total_false_positives AS DOUBLE) * CAST(25 AS DOUBLE) AS friction_cost, w.txn_type AS worst_type,
  CAST(w.fps AS BIGINT) AS worst_type_false_positives, {pct('w.fps', 'w.n')} AS worst_type_false_positive_rate_pct
FROM (SELECT {cnt("outcome_class = 'false_positive'")} AS total_false_positives, COUNT(*) AS n FROM scd WHERE is_fraud = 0) t, w"""))
def q_friction_summary(spark, sf):
    return db.friction_summary(_ev_txn(spark, sf).scored_test)


@register("dash_measures", _ev_sql("""
SELECT CAST(SUM(is_fraud) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS fraud_rate,
  CAST(COUNT(*) FILTER (WHERE outcome_class = 'true_positive') AS DOUBLE)
    / NULLIF(CAST(COUNT(*) FILTER (WHERE predicted_flag = 1) AS DOUBLE), 0) AS alert_precision,
  CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_negative') AS DOUBLE) * CAST(500 AS DOUBLE)
    + CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS DOUBLE) * CAST(25 AS DOUBLE) AS simulated_total_cost
FROM scd"""))
def q_dash_measures(spark, sf):
    return db.dash_measures(_ev_txn(spark, sf).scored_test)


@register("amount_band_by_class", _li_sql("SELECT amount_band, is_fraud, COUNT(*) AS transactions FROM scd GROUP BY ALL"))
def q_amount_band_by_class(spark, sf):
    return db.amount_band_by_class(_li(spark, sf).scored_test)


@register("queue_composition", _ev_sql("""
SELECT 'queue_by_risk_band' AS view, risk_band AS key, COUNT(*) AS n FROM scd WHERE risk_band IN ('HIGH', 'MEDIUM') GROUP BY risk_band
UNION ALL SELECT 'alerts_by_type', txn_type, COUNT(*) FROM scd WHERE predicted_flag = 1 GROUP BY txn_type
UNION ALL SELECT 'alerts_in_queue', 'all', COUNT(*) FILTER (WHERE predicted_flag = 1) FROM scd"""))
def q_queue_composition(spark, sf):
    return db.queue_composition(_ev_txn(spark, sf).scored_test)


_HEAT = ", ".join(
    f"{pct(chr(39).join(['COUNT(*) FILTER (WHERE outcome_class = ', 'false_positive', ' AND amount_band = ', b, ')']), chr(39).join(['NULLIF(COUNT(*) FILTER (WHERE amount_band = ', b, '), 0)']))} AS {db.band_column(b)}"
    for b in DEFAULT.amount_band_labels)


@register("friction_heat", _li_sql(f"SELECT txn_type, {_HEAT} FROM scd WHERE is_fraud = 0 GROUP BY txn_type"))
def q_friction_heat(spark, sf):
    return db.friction_heat(_li(spark, sf).scored_test)


@register("blocked_value", _ev_sql(
    "SELECT CAST(COALESCE(SUM(amount) FILTER (WHERE outcome_class = 'false_positive'), 0) AS DOUBLE) AS blocked_legitimate_value FROM scd"))
def q_blocked_value(spark, sf):
    return db.blocked_value(_ev_txn(spark, sf).scored_test)


def _bin_sql(k: int) -> str:
    return f"CAST(least(COALESCE(floor((x - lo) / NULLIF((hi - lo) / CAST({k} AS DOUBLE), 0)), 0), {k - 1}) AS INTEGER)"


def _hist_sql(name: str, k: int, where: str, density: bool) -> str:
    width = f"((hi - lo) / CAST({k} AS DOUBLE))"
    return f"""SELECT '{name}' AS histogram, CAST(r.bin AS INTEGER) AS bin, lo + CAST(r.bin AS DOUBLE) * {width} AS bin_lo,
  CAST(COUNT(x.x) AS BIGINT) AS n,
  {f"CAST(COUNT(x.x) AS DOUBLE) / (CAST(ANY_VALUE(t.n) AS DOUBLE) * {width})" if density else "CAST(NULL AS DOUBLE)"} AS density,
  {"round(ANY_VALUE(t.med), 9)" if density else "CAST(NULL AS DOUBLE)"} AS median
FROM range({k}) r(bin) CROSS JOIN mm CROSS JOIN (SELECT COUNT(*) AS n, quantile_cont(x, 0.5) AS med FROM x WHERE {where}) t
LEFT JOIN (SELECT x, {_bin_sql(k)} AS b FROM x, mm WHERE {where}) x ON x.b = r.bin
WHERE t.n > 0 GROUP BY r.bin, lo, hi"""


@register("hist_log_amount", with_ctes(f"""
WITH x AS (SELECT round(log10(CAST(amount AS DOUBLE)), 9) AS x, is_fraud FROM transactions WHERE amount > 0),
mm AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM x)
{_hist_sql("all", 60, "true", False)} UNION ALL {_hist_sql("legitimate", 59, "is_fraud = 0", True)}
UNION ALL {_hist_sql("fraudulent", 59, "is_fraud = 1", True)}""", TXN))
def q_hist_log_amount(spark, sf):
    return db.hist_log_amount(events_transactions(spark, sf))


def _f2(key, side):
    return f"""SELECT '{side}' AS side, CAST(b.c AS BIGINT) AS txns_clipped, CAST(COUNT(p.n) AS BIGINT) AS accounts,
  ANY_VALUE(o.single_use_pct) AS single_use_pct
FROM range(1, 21) b(c) LEFT JOIN (SELECT COUNT(*) AS n FROM transactions GROUP BY {key}) p ON least(p.n, 20) = b.c,
     (SELECT {pct('COUNT(*) FILTER (WHERE n = 1)', 'COUNT(*)')} AS single_use_pct FROM (SELECT COUNT(*) AS n FROM transactions GROUP BY {key})) o
GROUP BY 1, 2"""


@register("hist_account_txns", with_ctes(_f2("name_orig", "origin") + " UNION ALL " + _f2("name_dest", "destination"), TXN))
def q_hist_account_txns(spark, sf):
    return db.hist_account_txns(events_transactions(spark, sf))


@register("fp_by_type_and_band", _li_sql("""
SELECT 'type' AS dimension, txn_type AS key, CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS BIGINT) AS false_positives,
  CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS fp_rate,
  COUNT(*) AS legitimate_transactions FROM scd WHERE is_fraud = 0 GROUP BY txn_type
UNION ALL
SELECT 'amount_band', amount_band, CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS BIGINT),
  CAST(COUNT(*) FILTER (WHERE outcome_class = 'false_positive') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), COUNT(*)
FROM scd WHERE is_fraud = 0 GROUP BY amount_band"""))
def q_fp_by_type_and_band(spark, sf):
    return db.fp_by_type_and_band(_li(spark, sf).scored_test)


@register("band_distribution", _ev_sql(f"""
SELECT a.band_order, a.risk_band, CAST(COALESCE(c.n, 0) AS BIGINT) AS transactions, CAST(COALESCE(c.f, 0) AS BIGINT) AS fraud,
  {pct('COALESCE(c.f, 0)', 'COALESCE(c.n, 0)')} AS fraud_rate_pct
FROM (VALUES (0, 'LOW'), (1, 'MEDIUM'), (2, 'HIGH')) a(band_order, risk_band)
LEFT JOIN (SELECT risk_band, COUNT(*) AS n, SUM(is_fraud) AS f FROM scd GROUP BY risk_band) c ON c.risk_band = a.risk_band"""))
def q_band_distribution(spark, sf):
    return db.band_distribution(_ev_txn(spark, sf))


_Q_COLS = ["txn_id", "step", "txn_type", "amount", "fraud_probability", "risk_band", "dest_txn_prev_24h",
           "dest_prior_unique_senders", "dest_prior_txn_count", "pair_is_new", "dest_is_new",
           "orig_amount_to_prior_avg", "amount_to_type_prior_avg"]


@register("analyst_queue", _ev_sql(
    "SELECT " + ", ".join("CAST(amount AS DOUBLE) AS amount" if c == "amount" else c for c in _Q_COLS)
    + " FROM scd WHERE risk_band IN ('HIGH', 'MEDIUM') ORDER BY fraud_probability DESC, txn_id"))
def q_analyst_queue(spark, sf):
    return db.analyst_queue(_ev(spark, sf).scored_test)


@register("top_scored_examples", _ev_sql(
    "SELECT txn_id, step, txn_type, CAST(amount AS DOUBLE) AS amount, fraud_probability, risk_band, is_fraud "
    "FROM scd ORDER BY fraud_probability DESC, txn_id LIMIT 10"))
def q_top_scored_examples(spark, sf):
    return db.top_scored(_ev_txn(spark, sf).scored_test).select(
        "txn_id", "step", "txn_type", F.col("amount").cast("double").alias("amount"), "fraud_probability",
        "risk_band", "is_fraud")


# the importance table of the frozen forest, as SQL and (at run time) as a table
_IMPORTANCE = "imp AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {cm.number(v)})" for c, v in cm.importance(frozen.forest()).items()) + ") i(feature, importance))"
_LEAD = "lead AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY importance DESC, feature) AS feature_rank FROM imp)"
_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT txn_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM scd" for c in frozen.forest().columns) + ")"
_MED = """med AS (SELECT l.feature, CAST(feature_rank AS INTEGER) AS feature_rank, quantile_cont(value, 0.5) AS m
          FROM long l JOIN lead ON lead.feature = l.feature WHERE feature_rank <= 5 AND value IS NOT NULL GROUP BY ALL)"""


@register("explain_examples", _ev_sql("""
SELECT t.txn_id, t.step, t.txn_type, CAST(t.amount AS DOUBLE) AS amount, t.fraud_probability, t.risk_band, t.is_fraud AS actual_label,
  med.feature_rank, l.feature, l.value, round(m, 9) AS population_median,
  CASE WHEN l.value > m THEN 'above' WHEN l.value < m THEN 'below' ELSE 'at' END AS relative_position
FROM (SELECT * FROM scd ORDER BY fraud_probability DESC, txn_id LIMIT 10) t JOIN long l ON l.txn_id = t.txn_id
JOIN med ON med.feature = l.feature WHERE l.value IS NOT NULL""", _IMPORTANCE, _LEAD, _LONG, _MED))
def q_explain_examples(spark, sf):
    """I4: the leading features come from the importance table of a forest (frozen, so that SQL can follow)."""
    return db.explain_examples(_ev(spark, sf).scored_test, cm.importance_table(spark, frozen.forest()))


@register("values_above_median", _ev_sql("""
SELECT l.txn_id, l.feature, CASE WHEN l.value > m THEN 1 ELSE 0 END AS above_median
FROM long l JOIN med ON med.feature = l.feature WHERE l.value IS NOT NULL""", _IMPORTANCE, _LEAD, _LONG, _MED))
def q_values_above_median(spark, sf):
    return db.values_above_median(_ev(spark, sf).scored_test, cm.importance_table(spark, frozen.forest()))
