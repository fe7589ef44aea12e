"""Shared DuckDB CTEs: canonical transactions, feature table, scorecard."""

TXN = """
transactions AS (
  WITH base AS (
    SELECT event_id AS txn_id,
      CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) AS INTEGER) + 1 AS step,
      CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'TRANSFER'
           WHEN 'view' THEN 'CASH_OUT' WHEN 'signup' THEN 'CASH_IN' ELSE 'DEBIT' END AS txn_type,
      CAST(value AS DECIMAL(18,2)) AS amount,
      concat('C', CAST(user_id AS VARCHAR)) AS name_orig,
      concat(CASE WHEN event_type = 'purchase' THEN 'M' ELSE 'C' END,
             regexp_replace(props, '[^0-9]', '', 'g')) AS name_dest
    FROM events),
  b AS (SELECT *, CASE WHEN txn_type IN ('TRANSFER','CASH_OUT')
                        AND (amount >= 150 OR txn_id % 53 = 0) THEN 1 ELSE 0 END AS is_fraud FROM base)
  SELECT txn_id, step, txn_type, amount, name_orig, name_dest,
    CAST(CASE WHEN is_fraud = 1 THEN amount ELSE amount * (1 + txn_id % 5) END AS DECIMAL(18,2)) AS old_balance_orig,
    CAST(CASE WHEN is_fraud = 1 THEN 0 WHEN txn_type = 'CASH_IN' THEN amount * (2 + txn_id % 5)
              ELSE amount * (txn_id % 5) END AS DECIMAL(18,2)) AS new_balance_orig,
    CAST(CASE WHEN is_fraud = 1 THEN 0 ELSE 100 + txn_id % 1000 END AS DECIMAL(18,2)) AS old_balance_dest,
    CAST(CASE WHEN is_fraud = 1 THEN 0 ELSE 100 + txn_id % 1000 + amount END AS DECIMAL(18,2)) AS new_balance_dest,
    is_fraud,
    CASE WHEN txn_type = 'TRANSFER' AND amount > 200 AND is_fraud = 1 THEN 1 ELSE 0 END AS is_flagged_fraud
  FROM b)"""

LINEITEM_TXN = """
transactions AS (
  WITH l AS (SELECT l_orderkey, l_linenumber, MIN(l_shipdate) AS shipdate, MIN(l_suppkey) AS suppkey,
                    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, MAX(l_returnflag) AS rf
             FROM lineitem GROUP BY l_orderkey, l_linenumber)
  SELECT l_orderkey * 10 + l_linenumber AS txn_id,
    CAST(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', shipdate) AS INTEGER) + 1 AS step,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'CASH_OUT'
         WHEN '3' THEN 'PAYMENT' WHEN '4' THEN 'CASH_IN' ELSE 'DEBIT' END AS txn_type,
    CAST(price AS DECIMAL(18,2)) AS amount,
    concat('C', CAST(o_custkey AS VARCHAR)) AS name_orig,
    concat(CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'M' ELSE 'C' END, CAST(suppkey AS VARCHAR)) AS name_dest,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') AND rf = 'R' AND price >= 80000 THEN 1 ELSE 0 END AS is_fraud
  FROM l JOIN orders ON l.l_orderkey = o_orderkey)"""

# plain-window feature table (the straightforward single-node formulation)
FEATURES = """
fw AS (
  SELECT t.*,
    COUNT(*) OVER (PARTITION BY name_orig ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o_n,
    SUM(amount) OVER (PARTITION BY name_orig ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o_s,
    MAX(amount) OVER (PARTITION BY name_orig ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o_mx,
    step - LAG(step) OVER (PARTITION BY name_orig ORDER BY step, txn_id) AS o_gap,
    LAG(txn_type) OVER (PARTITION BY name_orig ORDER BY step, txn_id) AS o_prev_type,
    COUNT(*) OVER (PARTITION BY name_orig ORDER BY step RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING) AS o_v24,
    COUNT(*) OVER (PARTITION BY name_dest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS d_n,
    SUM(amount) OVER (PARTITION BY name_dest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS d_s,
    MAX(amount) OVER (PARTITION BY name_dest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS d_mx,
    step - LAG(step) OVER (PARTITION BY name_dest ORDER BY step, txn_id) AS d_gap,
    COUNT(*) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING) AS d_v24,
    COUNT(*) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 72 PRECEDING AND 1 PRECEDING) AS d_v72,
    COUNT(*) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 168 PRECEDING AND 1 PRECEDING) AS d_v168,
    SUM(amount) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 24 PRECEDING AND 1 PRECEDING) AS d_a24,
    COUNT(*) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS d_v1,
    COUNT(*) OVER (PARTITION BY name_orig, name_dest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_n,
    SUM(amount) OVER (PARTITION BY name_orig, name_dest ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_s,
    COUNT(*) OVER (PARTITION BY txn_type ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t_n,
    SUM(amount) OVER (PARTITION BY txn_type ORDER BY step, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t_s,
    CASE WHEN ROW_NUMBER() OVER (PARTITION BY name_orig, name_dest ORDER BY step, txn_id) = 1 THEN 1 ELSE 0 END AS first_contact
  FROM transactions t),
fw2 AS (
  SELECT fw.*, COALESCE(SUM(first_contact) OVER (PARTITION BY name_dest ORDER BY step, txn_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d_f,
    CAST(o_s AS DOUBLE) / NULLIF(CAST(o_n AS DOUBLE), 0) AS o_avg,
    CAST(d_s AS DOUBLE) / NULLIF(CAST(d_n AS DOUBLE), 0) AS d_avg,
    CAST(t_s AS DOUBLE) / NULLIF(CAST(t_n AS DOUBLE), 0) AS t_avg
  FROM fw),
features AS (
  SELECT txn_id, step,
    CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS sim_day,
    CAST((step - 1) % 24 AS INTEGER) AS hour_of_day,
    txn_type, amount,
    round(log10(CAST(greatest(amount, 0) AS DOUBLE) + 1.0), 9) AS log_amount,
    CASE WHEN amount % 1000 = 0 THEN 1 ELSE 0 END AS amount_is_round_1000,
    name_orig, name_dest, substr(name_dest, 1, 1) AS dest_kind,
    CASE WHEN substr(name_dest, 1, 1) = 'M' THEN 1 ELSE 0 END AS dest_is_merchant,
    o_n AS orig_prior_txn_count, o_avg AS orig_prior_avg_amount, CAST(o_mx AS DOUBLE) AS orig_prior_max_amount,
    COALESCE(CAST(o_s AS DOUBLE), 0.0) AS orig_prior_total_amount, o_gap AS orig_steps_since_prev_txn,
    CASE WHEN o_n > 0 THEN 1 ELSE 0 END AS orig_has_history,
    CAST(amount AS DOUBLE) / NULLIF(o_avg, 0) AS orig_amount_to_prior_avg,
    CAST(amount AS DOUBLE) - o_avg AS orig_amount_minus_prior_avg,
    CAST(amount AS DOUBLE) / NULLIF(CAST(o_mx AS DOUBLE), 0) AS orig_amount_to_prior_max,
    o_v24 AS orig_txn_prev_24h, o_prev_type AS orig_prev_txn_type,
    d_n AS dest_prior_txn_count, d_avg AS dest_prior_avg_amount, CAST(d_mx AS DOUBLE) AS dest_prior_max_amount,
    COALESCE(CAST(d_s AS DOUBLE), 0.0) AS dest_prior_total_amount, d_gap AS dest_steps_since_prev_txn,
    CASE WHEN d_n > 0 THEN 1 ELSE 0 END AS dest_has_history,
    CASE WHEN d_n = 0 THEN 1 ELSE 0 END AS dest_is_new,
    CAST(amount AS DOUBLE) / NULLIF(d_avg, 0) AS dest_amount_to_prior_avg,
    CAST(d_f AS BIGINT) AS dest_prior_unique_senders,
    d_v24 AS dest_txn_prev_24h, d_v72 AS dest_txn_prev_72h, d_v168 AS dest_txn_prev_168h,
    COALESCE(CAST(d_a24 AS DOUBLE), 0.0) AS dest_amount_prev_24h, d_v1 AS dest_txn_prev_1h,
    CAST(d_v24 AS DOUBLE) / NULLIF(CAST(d_v168 AS DOUBLE) / CAST(7 AS DOUBLE), 0) AS dest_velocity_ratio_24h_vs_168h,
    p_n AS pair_prior_txn_count, CASE WHEN p_n = 0 THEN 1 ELSE 0 END AS pair_is_new,
    COALESCE(CAST(p_s AS DOUBLE), 0.0) AS pair_prior_total_amount,
    t_avg AS type_prior_avg_amount, CAST(amount AS DOUBLE) / NULLIF(t_avg, 0) AS amount_to_type_prior_avg,
    CASE WHEN txn_type = 'CASH_IN' THEN 1 ELSE 0 END AS type_CASH_IN,
    CASE WHEN txn_type = 'CASH_OUT' THEN 1 ELSE 0 END AS type_CASH_OUT,
    CASE WHEN txn_type = 'DEBIT' THEN 1 ELSE 0 END AS type_DEBIT,
    CASE WHEN txn_type = 'PAYMENT' THEN 1 ELSE 0 END AS type_PAYMENT,
    CASE WHEN txn_type = 'TRANSFER' THEN 1 ELSE 0 END AS type_TRANSFER,
    is_fraud
  FROM fw2)"""

SCORED = """
scored AS (
  SELECT t.*, CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + CAST(250 AS DOUBLE))
    * CASE WHEN txn_type IN ('TRANSFER','CASH_OUT') THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END AS score
  FROM transactions t)"""


def with_ctes(body: str, *ctes: str) -> str:
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return "WITH " + ",".join(ctes) + ",\n" + b[4:]
    return "WITH " + ",".join(ctes) + "\n" + body


def pct(a: str, b: str) -> str:
    """SQL twin of functions.derive.pct."""
    return f"CAST(100 AS DOUBLE) * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def cnt(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def q(expr: str, level: float) -> str:
    """Rounded linear quantile of a DOUBLE expression."""
    return f"round(quantile_cont(CAST({expr} AS DOUBLE), {level}), 9)"
