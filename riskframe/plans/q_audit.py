"""Registered audit queries (A1-A22, J1, J4, U1, U2) on the events fixture."""

from __future__ import annotations

from riskframe.operators import audit as au
from riskframe.oracles.base import TXN, cnt, pct, q, with_ctes
from riskframe.plans.catalog import CATALOG, register
from riskframe.sources.fixtures import events_transactions

T = events_transactions


def _sql(body: str) -> str:
    return with_ctes(body, TXN)


_NULLS = ", ".join(cnt(f"{c} IS NULL") + f" AS null_{c}" for c in au.CANONICAL)
_TOTAL_MISSING = " + ".join(f"null_{c}" for c in au.CANONICAL)
_DUP = ", ".join(au.DUPLICATE_KEY)


@register("duplicate_rows", _sql(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_groups, CAST(COALESCE(SUM(occurrences - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {_DUP}, COUNT(*) AS occurrences FROM transactions GROUP BY ALL HAVING COUNT(*) > 1) d"""))
def q_duplicate_rows(spark, sf):
    return au.duplicate_rows(T(spark, sf))


@register("quality_counts", _sql(f"""
SELECT * EXCLUDE (issues), {_TOTAL_MISSING} AS total_missing_values, {pct('surplus_rows', 'total_rows')} AS duplicate_row_pct,
  CASE WHEN issues = '' THEN 'no obvious structural problems detected' ELSE issues END AS data_quality_issues
FROM (
  SELECT *, concat_ws('; ',
      CASE WHEN negative_amount > 0 THEN 'negative transaction amounts present' END,
      CASE WHEN zero_amount > 0 THEN format('{{:,}}', zero_amount) || ' transactions with amount = 0' END,
      CASE WHEN steps_below_1 > 0 THEN 'step values below 1' END,
      CASE WHEN surplus_rows > 0 THEN format('{{:,}}', surplus_rows) || ' exactly duplicated rows (may be genuine repeats)' END) AS issues
  FROM (SELECT COUNT(*) AS total_rows, {_NULLS}, {cnt('amount = 0')} AS zero_amount,
               {cnt('amount < 0')} AS negative_amount, {cnt('step < 1')} AS steps_below_1 FROM transactions) a,
       (SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_groups, CAST(COALESCE(SUM(occurrences - 1), 0) AS BIGINT) AS surplus_rows
        FROM (SELECT {_DUP}, COUNT(*) AS occurrences FROM transactions GROUP BY ALL HAVING COUNT(*) > 1) d) d2
) x""".replace("SELECT *, {", "SELECT *, {")))
def q_quality_counts(spark, sf):
    return au.quality_counts(T(spark, sf)).drop()


@register("class_balance", _sql(f"""
SELECT transactions, fraud, transactions - fraud AS legitimate, {pct('fraud', 'transactions')} AS fraud_rate_pct,
  CAST(transactions - fraud AS DOUBLE) / NULLIF(CAST(fraud AS DOUBLE), 0) AS legit_per_fraud,
  {pct('transactions - fraud', 'transactions')} AS always_legit_accuracy_pct
FROM (SELECT COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM transactions)"""))
def q_class_balance(spark, sf):
    return au.class_balance(T(spark, sf))


@register("profile_by_type", _sql(f"""
SELECT txn_type, transactions, {pct('transactions', 'SUM(transactions) OVER ()')} AS pct_of_volume, fraud,
  {pct('fraud', 'transactions')} AS fraud_rate_pct, {pct('fraud', 'SUM(fraud) OVER ()')} AS share_of_all_fraud_pct,
  CAST(s AS DOUBLE) AS total_amount, CAST(s AS DOUBLE) / CAST(transactions AS DOUBLE) AS mean_amount,
  median_amount, CASE WHEN fraud > 0 THEN 1 ELSE 0 END AS has_fraud
FROM (SELECT txn_type, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud, SUM(amount) AS s,
             {q('amount', 0.5)} AS median_amount FROM transactions GROUP BY txn_type)"""))
def q_profile_by_type(spark, sf):
    return au.profile_by_type(T(spark, sf))


@register("amount_stats", _sql(f"""
WITH r AS (SELECT 'all' AS class, amount FROM transactions
           UNION ALL SELECT CASE WHEN is_fraud = 1 THEN 'fraudulent' ELSE 'legitimate' END, amount FROM transactions),
fv AS (SELECT SUM(amount) AS tv, SUM(amount) FILTER (WHERE is_fraud = 1) AS fv FROM transactions)
SELECT class, COUNT(*) AS count, CAST(SUM(amount) AS DOUBLE) AS sum,
  CAST(SUM(amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean, {q('amount', 0.5)} AS median,
  round(stddev_samp(CAST(amount AS DOUBLE)), 9) AS std, CAST(MIN(amount) AS DOUBLE) AS min,
  {q('amount', 0.25)} AS q1, {q('amount', 0.75)} AS q3, {q('amount', 0.9)} AS p90, {q('amount', 0.99)} AS p99,
  CAST(MAX(amount) AS DOUBLE) AS max, COALESCE(ANY_VALUE({pct('fv.fv', 'fv.tv')}), 0.0) AS fraud_value_share_pct
FROM r, fv GROUP BY class"""))
def q_amount_stats(spark, sf):
    return au.amount_stats(T(spark, sf))


@register("step_profile", _sql(f"""
WITH s AS (SELECT step, COUNT(*) AS n FROM transactions GROUP BY step),
d AS (SELECT CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS sim_day, COUNT(*) AS n FROM transactions GROUP BY 1)
SELECT MIN(step) AS step_min, MAX(step) AS step_max, COUNT(*) AS unique_steps,
  MAX(step) - MIN(step) + 1 - COUNT(*) AS missing_steps_in_range, MAX(step) - MIN(step) + 1 AS implied_steps,
  CAST(MAX(step) - MIN(step) + 1 AS DOUBLE) / CAST(24 AS DOUBLE) AS implied_days,
  CAST(SUM(n) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS transactions_per_step_mean,
  MIN(n) AS transactions_per_step_min, MAX(n) AS transactions_per_step_max,
  (SELECT MIN(n) FROM d) AS daily_volume_min, (SELECT MAX(n) FROM d) AS daily_volume_max
FROM s"""))
def q_step_profile(spark, sf):
    return au.step_profile(T(spark, sf))


@register("calendar_gap_fill", _sql("""
WITH p AS (SELECT step, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM transactions GROUP BY step),
cal AS (SELECT CAST(unnest(range(MIN(step), MAX(step) + 1)) AS INTEGER) AS step FROM p)
SELECT cal.step, CAST(COALESCE(transactions, 0) AS BIGINT) AS transactions, CAST(COALESCE(fraud, 0) AS BIGINT) AS fraud
FROM cal LEFT JOIN p ON cal.step = p.step"""))
def q_calendar_gap_fill(spark, sf):
    return au.calendar_gap_fill(T(spark, sf))


@register("hour_calendar", _sql(f"""
SELECT CAST(h.h AS INTEGER) AS hour_of_day, CAST(COUNT(t.txn_id) AS BIGINT) AS transactions,
  CAST(COALESCE(SUM(t.is_fraud), 0) AS BIGINT) AS fraud, {pct('COALESCE(SUM(t.is_fraud), 0)', 'COUNT(t.txn_id)')} AS fraud_rate_pct
FROM range(24) h(h) LEFT JOIN transactions t ON (t.step - 1) % 24 = h.h GROUP BY 1"""))
def q_hour_calendar(spark, sf):
    return au.hour_calendar(T(spark, sf))


_HOURLY = f"""
SELECT CAST((step - 1) % 24 AS INTEGER) AS hour_of_day, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud,
  {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct FROM transactions {{where}} GROUP BY 1"""


@register("hourly_profile", _sql(_HOURLY.format(where="")))
def q_hourly_profile(spark, sf):
    return au.hourly_profile(T(spark, sf))


@register("daily_profile", _sql("""
SELECT CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS sim_day, COUNT(*) AS transactions,
  CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM transactions GROUP BY 1"""))
def q_daily_profile(spark, sf):
    return au.daily_profile(T(spark, sf))


@register("low_volume_hours", _sql("""
WITH h AS (SELECT CAST((step - 1) % 24 AS INTEGER) AS hour_of_day, COUNT(*) AS transactions,
                  SUM(is_fraud) AS fraud FROM transactions GROUP BY 1),
m AS (SELECT quantile_cont(CAST(transactions AS DOUBLE), 0.5) AS med FROM h),
l AS (SELECT h.*, CAST(transactions AS DOUBLE) < med * 0.25 AS low FROM h, m)
SELECT COALESCE(string_agg(CAST(hour_of_day AS VARCHAR), ',' ORDER BY hour_of_day) FILTER (WHERE low), '') AS low_volume_hours,
  CAST(COUNT(*) FILTER (WHERE low) AS BIGINT) AS n_low_volume_hours,
  CAST(100 AS DOUBLE) * CAST(COALESCE(SUM(fraud) FILTER (WHERE low), 0) AS DOUBLE)
    / CAST(greatest(COALESCE(SUM(transactions) FILTER (WHERE low), 0), 1) AS DOUBLE) AS fraud_rate_low_volume_hours_pct,
  CAST(100 AS DOUBLE) * CAST(COALESCE(SUM(fraud) FILTER (WHERE NOT low), 0) AS DOUBLE)
    / CAST(greatest(COALESCE(SUM(transactions) FILTER (WHERE NOT low), 0), 1) AS DOUBLE) AS fraud_rate_other_hours_pct
FROM l"""))
def q_low_volume_hours(spark, sf):
    return au.low_volume_hours(T(spark, sf))


def _rep_sql(key: str, side: str) -> str:
    return f"""
SELECT '{side}' AS side, COUNT(*) AS unique_accounts, {cnt('txns > 1')} AS repeat_accounts,
  {pct("COUNT(*) FILTER (WHERE txns > 1)", 'COUNT(*)')} AS pct_accounts_repeat,
  {pct("COALESCE(SUM(txns) FILTER (WHERE txns > 1), 0)", 'SUM(txns)')} AS pct_txns_from_repeat,
  CAST(SUM(txns) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_txns_per_account,
  {q('txns', 0.5)} AS median_txns_per_account, MAX(txns) AS max_txns_one_account,
  {cnt('txns = 1')} AS accounts_1_txn, {cnt('txns = 2')} AS accounts_2_txns,
  {cnt('txns BETWEEN 3 AND 5')} AS accounts_3_to_5_txns, {cnt('txns BETWEEN 6 AND 20')} AS accounts_6_to_20_txns,
  {cnt('txns > 20')} AS accounts_21_plus_txns
FROM (SELECT {key}, COUNT(*) AS txns FROM transactions GROUP BY {key})"""


@register("account_repetition", _sql(_rep_sql("name_orig", "origin") + " UNION ALL " + _rep_sql("name_dest", "destination")))
def q_account_repetition(spark, sf):
    return au.account_repetition(T(spark, sf))


@register("repetition_both_sides", _sql(_rep_sql("name_orig", "origin") + " UNION ALL " + _rep_sql("name_dest", "destination")))
def q_repetition_both_sides(spark, sf):
    """The same UNION ALL, exposed under its set-operation name."""
    return au.account_repetition(T(spark, sf))


@register("fan_in_stats", _sql(f"""
SELECT CAST(SUM(u) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS mean_unique_senders, MAX(u) AS max_unique_senders,
  {q('u', 0.99)} AS p99_unique_senders
FROM (SELECT name_dest, COUNT(DISTINCT name_orig) AS u FROM transactions GROUP BY name_dest)"""))
def q_fan_in_stats(spark, sf):
    return au.fan_in_stats(T(spark, sf))


@register("history_coverage", _sql(f"""
WITH r AS (SELECT is_fraud,
  ROW_NUMBER() OVER (PARTITION BY name_orig ORDER BY step, txn_id) > 1 AS ho,
  ROW_NUMBER() OVER (PARTITION BY name_dest ORDER BY step, txn_id) > 1 AS hd FROM transactions)
SELECT {pct('COUNT(*) FILTER (WHERE ho)', 'COUNT(*)')} AS rows_with_prior_origin_history_pct,
  {pct('COUNT(*) FILTER (WHERE hd)', 'COUNT(*)')} AS rows_with_prior_destination_history_pct,
  {pct('COUNT(*) FILTER (WHERE ho AND is_fraud = 1)', 'COUNT(*) FILTER (WHERE is_fraud = 1)')} AS fraud_rows_with_prior_origin_history_pct,
  {pct('COUNT(*) FILTER (WHERE hd AND is_fraud = 1)', 'COUNT(*) FILTER (WHERE is_fraud = 1)')} AS fraud_rows_with_prior_destination_history_pct
FROM r"""))
def q_history_coverage(spark, sf):
    return au.history_coverage(T(spark, sf))


@register("counterparty_kind", _sql(f"""
SELECT substr(name_dest, 1, 1) AS dest_kind, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud,
  {pct('SUM(is_fraud)', 'COUNT(*)')} AS fraud_rate_pct FROM transactions GROUP BY 1"""))
def q_counterparty_kind(spark, sf):
    return au.counterparty_kind(T(spark, sf))


@register("design_decision", _sql(f"""
SELECT p AS origin_pct_txns_from_repeat, CASE WHEN p >= 30 THEN 1 ELSE 0 END AS origin_history_usable,
  CASE WHEN p >= 30 THEN 'build both origin and destination behaviour'
       ELSE 'shift behavioural analysis to destination, pair, fan-in and velocity' END AS design_decision
FROM (SELECT {pct("COALESCE(SUM(txns) FILTER (WHERE txns > 1), 0)", 'SUM(txns)')} AS p
      FROM (SELECT name_orig, COUNT(*) AS txns FROM transactions GROUP BY name_orig))"""))
def q_design_decision(spark, sf):
    return au.design_decision(T(spark, sf))


_RESID = """
r AS (SELECT *, new_balance_orig - (old_balance_orig + CASE WHEN txn_type = 'CASH_IN' THEN amount ELSE -amount END) AS balance_error_orig,
      new_balance_dest - (old_balance_dest + amount) AS balance_error_dest FROM transactions)"""


def _leak_row(name: str, cond: str) -> str:
    f = f"COALESCE({pct(f'COUNT(*) FILTER (WHERE ({cond}) AND is_fraud = 1)', 'COUNT(*) FILTER (WHERE is_fraud = 1)')}, 0.0)"
    l_ = f"COALESCE({pct(f'COUNT(*) FILTER (WHERE ({cond}) AND is_fraud = 0)', 'COUNT(*) FILTER (WHERE is_fraud = 0)')}, 0.0)"
    return f"SELECT '{name}' AS \"check\", {f} AS fraud_pct, {l_} AS legitimate_pct, {f} - {l_} AS separation_pct_points FROM r"


_LEAK = [
    ("origin_balance_does_not_reconcile", "abs(balance_error_orig) > 0.01"),
    ("destination_balance_does_not_reconcile", "abs(balance_error_dest) > 0.01"),
    ("amount_equals_entire_origin_balance", "abs(old_balance_orig - amount) < 0.01"),
    ("origin_balance_emptied_to_zero", "abs(new_balance_orig) < 0.01"),
    ("destination_balances_both_zero", "old_balance_dest = 0 AND new_balance_dest = 0 AND amount > 0"),
]


@register("leakage_checks", with_ctes(" UNION ALL ".join(_leak_row(n, c) for n, c in _LEAK), TXN, _RESID))
def q_leakage_checks(spark, sf):
    return au.leakage_checks(T(spark, sf))


def ranking_sql(src: str, group: str | None) -> str:
    """AP and ROC-AUC over distinct scores of `src(grp, value, y)`; `group` names the group column."""
    g = group or "grp"
    return f"""
d AS (SELECT {g}, value, SUM(y) AS pos, COUNT(*) AS n FROM ({src}) s WHERE value IS NOT NULL GROUP BY {g}, value),
c AS (SELECT *, SUM(pos) OVER w AS cum_pos, SUM(n) OVER w AS cum_n, SUM(pos) OVER (PARTITION BY {g}) AS P,
             SUM(n) OVER (PARTITION BY {g}) AS NN
      FROM d WINDOW w AS (PARTITION BY {g} ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT {g}, SUM(CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * (CAST(cum_pos AS DOUBLE) / CAST(cum_n AS DOUBLE))) AS ap,
        SUM(CAST(pos AS DOUBLE) * ((CAST(NN AS DOUBLE) - CAST(P AS DOUBLE) - (CAST(cum_n AS DOUBLE) - CAST(cum_pos AS DOUBLE)))
            + CAST(0.5 AS DOUBLE) * (CAST(n AS DOUBLE) - CAST(pos AS DOUBLE)))) AS auc_num,
        ANY_VALUE(P) AS P, ANY_VALUE(NN) AS NN FROM c GROUP BY {g}),
rm AS (SELECT {g},
  CASE WHEN P > 0 AND P < NN THEN round(auc_num / (CAST(P AS DOUBLE) * (CAST(NN AS DOUBLE) - CAST(P AS DOUBLE))), 9) END AS roc_auc,
  CASE WHEN P > 0 AND P < NN THEN round(ap, 9) END AS pr_auc,
  CAST(P AS DOUBLE) / CAST(NN AS DOUBLE) AS pr_auc_no_skill_baseline,
  CASE WHEN P > 0 AND P < NN THEN round(ap / (CAST(P AS DOUBLE) / CAST(NN AS DOUBLE)), 9) END AS pr_auc_lift_over_no_skill
  FROM m)"""


_SUSPECT_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, is_fraud AS y FROM r" for c in au.SUSPECT_COLUMNS)


@register("univariate_auc", with_ctes(
    'SELECT "column", roc_auc AS roc_auc_single_feature, pr_auc AS pr_auc_single_feature FROM rm',
    TXN, _RESID, ranking_sql(_SUSPECT_UNION, '"column"')))
def q_univariate_auc(spark, sf):
    return au.univariate_auc(T(spark, sf))


_DECISIONS_VALUES = ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in au.LEAKAGE_DECISIONS)


@register("leakage_decisions", with_ctes(f"""
SELECT d."column", d.leakage_risk, d.primary_model_decision, d.reason, u.roc_auc AS roc_auc_single_feature, u.pr_auc AS pr_auc_single_feature
FROM (VALUES {_DECISIONS_VALUES}) d("column", leakage_risk, primary_model_decision, reason)
LEFT JOIN rm u ON u."column" = d."column" """, TXN, _RESID, ranking_sql(_SUSPECT_UNION, '"column"')))
def q_leakage_decisions(spark, sf):
    return au.leakage_decisions(T(spark, sf))


@register("flag_rule_audit", _sql(f"""
SELECT {cnt('is_flagged_fraud = 1')} AS flagged_count, {pct("COUNT(*) FILTER (WHERE is_flagged_fraud = 1)", 'COUNT(*)')} AS flagged_pct,
  {cnt('is_flagged_fraud = 1 AND is_fraud = 1')} AS flagged_and_fraud,
  {cnt('is_flagged_fraud = 1 AND is_fraud = 0')} AS flagged_and_legitimate,
  {cnt('is_flagged_fraud = 0 AND is_fraud = 1')} AS fraud_not_flagged,
  CAST(100 AS DOUBLE) * CAST(COUNT(*) FILTER (WHERE is_flagged_fraud = 1 AND is_fraud = 1) AS DOUBLE)
    / CAST(greatest(COUNT(*) FILTER (WHERE is_fraud = 1), 1) AS DOUBLE) AS share_of_fraud_flagged_pct,
  COALESCE(string_agg(DISTINCT txn_type, ',' ORDER BY txn_type) FILTER (WHERE is_flagged_fraud = 1), '') AS types_flagged,
  CAST(MIN(amount) FILTER (WHERE is_flagged_fraud = 1) AS DOUBLE) AS min_flagged_amount
FROM transactions"""))
def q_flag_rule_audit(spark, sf):
    return au.flag_rule_audit(T(spark, sf))


_P99 = "cutoff AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.99) AS p99 FROM transactions)"


@register("cutoff_cross_join", with_ctes("""
SELECT txn_id, is_fraud, CASE WHEN CAST(amount AS DOUBLE) >= p99 THEN 1 ELSE 0 END AS rule_amount
FROM transactions CROSS JOIN cutoff""", TXN, _P99))
def q_cutoff_cross_join(spark, sf):
    return au.cutoff_cross_join(T(spark, sf))


def confusion_ratios_sql(src: str) -> str:
    def safe(a, b):
        return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"
    prec, rec = safe("TP", "TP + FP"), safe("TP", "TP + FN")
    return f"""SELECT *, {safe('TP + TN', 'TP + FP + FN + TN')} AS accuracy, {prec} AS precision, {rec} AS recall,
  {rec} AS fraud_capture_rate,
  CASE WHEN {prec} + {rec} > 0 THEN CAST(2 AS DOUBLE) * {prec} * {rec} / ({prec} + {rec}) ELSE 0.0 END AS f1,
  {safe('FP', 'FP + TN')} AS false_positive_rate, TP + FP AS alert_volume,
  {safe('TP + FP', 'TP + FP + FN + TN')} AS alert_rate FROM ({src}) cm"""


def _rule(name, pred):
    return (f"SELECT '{name}' AS rule, {cnt(f'({pred}) AND is_fraud = 1')} AS TP, {cnt(f'({pred}) AND is_fraud = 0')} AS FP, "
            f"{cnt(f'NOT ({pred}) AND is_fraud = 1')} AS FN, {cnt(f'NOT ({pred}) AND is_fraud = 0')} AS TN "
            f"FROM transactions CROSS JOIN cutoff")


_RULES_SQL = " UNION ALL ".join([
    _rule(au.RULES[0], "false"), _rule(au.RULES[1], "true"), _rule(au.RULES[2], "is_flagged_fraud = 1"),
    _rule(au.RULES[3], "txn_type IN ('TRANSFER','CASH_OUT')"), _rule(au.RULES[4], "CAST(amount AS DOUBLE) >= p99")])


@register("rule_baselines", with_ctes(confusion_ratios_sql(_RULES_SQL), TXN, _P99))
def q_rule_baselines(spark, sf):
    return au.rule_baselines(T(spark, sf))


@register("rules_union", with_ctes(confusion_ratios_sql(_RULES_SQL), TXN, _P99))
def q_rules_union(spark, sf):
    """The stacked rule confusions (one scan + stack)."""
    return au.rule_baselines(T(spark, sf))


@register("amount_ranking", with_ctes(
    "SELECT roc_auc, pr_auc, pr_auc_no_skill_baseline, pr_auc_lift_over_no_skill, round(p99, 9) AS p99_amount_cutoff "
    "FROM rm, cutoff", TXN, _P99,
    ranking_sql("SELECT 1 AS grp, CAST(amount AS DOUBLE) AS value, is_fraud AS y FROM transactions", None)))
def q_amount_ranking(spark, sf):
    return au.amount_ranking(T(spark, sf))


# fixed values: the canonical schema, in order
_STRUCTURE = [("txn_id", "bigint"), ("step", "int"), ("txn_type", "string"), ("amount", "decimal(18,2)"), ("name_orig", "string"),
              ("name_dest", "string"), *((f"{a}_balance_{b}", "decimal(18,2)") for b in ("orig", "dest") for a in ("old", "new")),
              ("is_fraud", "int"), ("is_flagged_fraud", "int")]
_STRUCTURE_SQL = (
    'SELECT s.position, s."column", s.dtype, n_rows, ' + f"{len(_STRUCTURE)} AS n_columns FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_STRUCTURE))
    + ') s(position, "column", dtype), (SELECT COUNT(*) AS n_rows FROM transactions)')


@register("structure", _sql(_STRUCTURE_SQL))
def q_structure(spark, sf):
    return au.structure(T(spark, sf))


# section -> (query, numbers, texts); the item column is named in operators.audit
_SECTIONS = {
    "structure": ("structure", "position n_rows n_columns", "dtype"),
    "data_quality": ("quality_counts", " ".join(["total_rows", *(f"null_{c}" for c, _ in _STRUCTURE)])
                     + " zero_amount negative_amount steps_below_1 duplicate_groups surplus_rows total_missing_values"
                     " duplicate_row_pct", "data_quality_issues"),
    "step_and_time": ("step_profile", "step_min step_max unique_steps missing_steps_in_range implied_steps implied_days"
                      " transactions_per_step_mean transactions_per_step_min transactions_per_step_max daily_volume_min"
                      " daily_volume_max", ""),
    "transaction_type": ("profile_by_type", "transactions pct_of_volume fraud fraud_rate_pct share_of_all_fraud_pct total_amount"
                         " mean_amount median_amount has_fraud", ""),
    "amount": ("amount_stats", "count sum mean median std min q1 q3 p90 p99 max fraud_value_share_pct", ""),
    "target": ("class_balance", "transactions fraud legitimate fraud_rate_pct legit_per_fraud always_legit_accuracy_pct", ""),
    "flagged": ("flag_rule_audit", "flagged_count flagged_pct flagged_and_fraud flagged_and_legitimate fraud_not_flagged"
                " share_of_fraud_flagged_pct min_flagged_amount", "types_flagged"),
    "account_repetition": ("account_repetition", "unique_accounts repeat_accounts pct_accounts_repeat pct_txns_from_repeat"
                           " mean_txns_per_account median_txns_per_account max_txns_one_account accounts_1_txn accounts_2_txns"
                           " accounts_3_to_5_txns accounts_6_to_20_txns accounts_21_plus_txns", ""),
    "leakage_audit": ("leakage_checks", "fraud_pct legitimate_pct separation_pct_points", ""),
    "honest_baselines": ("rule_baselines", "TP FP FN TN accuracy precision recall fraud_capture_rate f1 false_positive_rate"
                         " alert_volume alert_rate", ""),
}


def _section_sql(section: str) -> str:
    """The cells of a section's own SQL: numbers in value, strings in text."""
    query, numbers, texts = _SECTIONS[section]
    item = f's."{au.SECTION_ITEM[section]}"' if section in au.SECTION_ITEM else "''"
    cells = [f"{{'metric': '{c}', 'value': CAST(s.\"{c}\" AS DOUBLE), 'text': CAST(NULL AS VARCHAR)}}" for c in numbers.split()]
    cells += [f"{{'metric': '{c}', 'value': CAST(NULL AS DOUBLE), 'text': s.\"{c}\"}}" for c in texts.split()]
    return (f"SELECT section, item, cell.metric AS metric, cell.value AS value, cell.text AS text FROM (SELECT '{section}' AS section, "
            f"{item} AS item, unnest([{', '.join(cells)}]) AS cell FROM ({CATALOG[query][1]}) s)")


@register("full_audit", " UNION ALL ".join(map(_section_sql, _SECTIONS)))
def q_full_audit(spark, sf):
    """The cells of every section; a failing section shows its error."""
    return au.audit_report(au.full_audit(T(spark, sf)))


@register("share_over_total", _sql(f"""
SELECT txn_type, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud,
  CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total_transactions, CAST(SUM(SUM(is_fraud)) OVER () AS BIGINT) AS total_fraud,
  {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_volume, {pct('SUM(is_fraud)', 'SUM(SUM(is_fraud)) OVER ()')} AS share_of_all_fraud_pct
FROM transactions GROUP BY txn_type"""))
def q_share_over_total(spark, sf):
    return au.share_over_total(T(spark, sf))
