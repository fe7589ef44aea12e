"""Registered source / sink queries (S1-S9) and row-level derivations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.functions import derive as dv
from riskframe.operators import features as fe
from riskframe.oracles.base import FEATURES, TXN, with_ctes
from riskframe.plans.catalog import register
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import contract as ct
from riskframe.sources import sinks
from riskframe.sources.fixtures import events_transactions

T = events_transactions


def _scratch(spark, name: str) -> str:
    """A fresh path under the shared checkpoint dir (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskframe-{name}-{uuid.uuid4().hex}"


def _raw(spark, sf):
    """The events fixture in the raw 11-column contract (mixed-case names, no txn_id)."""
    return ct.raw_from_canonical(T(spark, sf))


_MONEY_DBL = ("txn_id, step, txn_type, CAST(amount AS DOUBLE) AS amount, name_orig, name_dest, "
              "CAST(old_balance_orig AS DOUBLE) AS old_balance_orig, CAST(new_balance_orig AS DOUBLE) AS new_balance_orig, "
              "CAST(old_balance_dest AS DOUBLE) AS old_balance_dest, CAST(new_balance_dest AS DOUBLE) AS new_balance_dest, "
              "is_fraud, is_flagged_fraud")


def _fsql(cols: str) -> str:
    return with_ctes(f"SELECT {cols} FROM features", TXN, FEATURES)


def _money_dbl(df):
    money = {"amount", "old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest"}
    return df.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c) for c in df.columns])


_RAW_SQL = ('step, txn_type AS "type", CAST(amount AS DOUBLE) AS amount, name_orig AS "nameOrig", '
            'CAST(old_balance_orig AS DOUBLE) AS "oldbalanceOrg", CAST(new_balance_orig AS DOUBLE) AS "newbalanceOrig", '
            'name_dest AS "nameDest", CAST(old_balance_dest AS DOUBLE) AS "oldbalanceDest", '
            'CAST(new_balance_dest AS DOUBLE) AS "newbalanceDest", is_fraud AS "isFraud", is_flagged_fraud AS "isFlaggedFraud"')


def _raw_dbl(df):
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if "decimal" in f.dataType.simpleString() else F.col(f.name)
                       for f in df.schema.fields])


def _raw_folder(spark, sf) -> str:
    """The fixture as CSV files in one folder: three header forms, dealt by id, and a foreign file."""
    path = _scratch(spark, "raw-csv")
    keyed = T(spark, sf)
    raw = [ct.raw_from_canonical(keyed.where(F.pmod("txn_id", F.lit(3)) == k)) for k in range(3)]
    raw[1] = raw[1].select(*reversed(raw[1].columns))
    raw[2] = raw[2].select(F.lit("x").alias("note"), "*")
    for df in (*raw, raw[0].select("step", "amount")):
        df.write.mode("append").option("header", True).csv(path)
    return path


@register("scan_contract", with_ctes(f"SELECT {_RAW_SQL} FROM transactions", TXN))
def q_scan_contract(spark, sf):
    """Raw CSV files in contract order, reordered and with an extra column; a foreign file is skipped."""
    return _raw_dbl(ct.scan_contract(spark, _raw_folder(spark, sf)))


@register("validate_columns", with_ctes(f"SELECT {_RAW_SQL} FROM transactions", TXN))
def q_validate_columns(spark, sf):
    """Missing columns raise, extra columns are ignored (an extra column is added here on purpose)."""
    raw = _raw(spark, sf).withColumn("extra_note", F.lit("x"))
    return _raw_dbl(raw.select(*ct.validate_columns(raw.columns)))


@register("load_transactions", with_ctes(f"SELECT {_MONEY_DBL.replace('txn_id', 'txn_id + 1 AS txn_id', 1)} FROM transactions", TXN))
def q_load_transactions(spark, sf):
    """S3: CSV files -> canonical table with ids in load order (money shown as DOUBLE for the comparison)."""
    path = _scratch(spark, "ordered-csv")
    ordered = T(spark, sf).repartitionByRange("txn_id").sortWithinPartitions("txn_id")
    ct.raw_from_canonical(ordered).write.option("header", True).csv(path)
    return _money_dbl(ct.load_csv(spark, path))


@register("rename_and_cast", with_ctes(
    "SELECT step, txn_type, CAST(amount AS DOUBLE) AS amount, name_orig, "
    "CAST(old_balance_orig AS DOUBLE) AS old_balance_orig, CAST(new_balance_orig AS DOUBLE) AS new_balance_orig, name_dest, "
    "CAST(old_balance_dest AS DOUBLE) AS old_balance_dest, CAST(new_balance_dest AS DOUBLE) AS new_balance_dest, "
    "is_fraud, is_flagged_fraud FROM transactions", TXN))
def q_rename_and_cast(spark, sf):
    """Raw mixed-case names -> snake_case, money -> DECIMAL(18,2)."""
    return _money_dbl(ct.rename_and_cast(_raw(spark, sf)))


@register("txn_id", with_ctes("SELECT txn_id + 1 AS txn_id, step, txn_type, CAST(amount AS DOUBLE) AS amount FROM transactions", TXN))
def q_txn_id(spark, sf):
    """Order-preserving surrogate key built from file splits (events file order = event order)."""
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").drop("event_id")
    keyed = ct.sequential_ids(ev)
    # rebuild the canonical columns on the keyed scan: same derivation, new key
    from riskframe.sources.fixtures import EVENT_TYPE_MAP, _case
    return keyed.select(
        "txn_id",
        (F.expr("CAST(timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS INT)") + 1).alias("step"),
        _case(F.col("event_type"), EVENT_TYPE_MAP, "DEBIT").alias("txn_type"),
        F.col("value").cast("decimal(18,2)").cast("double").alias("amount"))


@register("early_window", with_ctes(f"SELECT {_MONEY_DBL} FROM transactions ORDER BY txn_id LIMIT 2500", TXN))
def q_early_window(spark, sf):
    """The first rows as an early window on the id (never a bare limit)."""
    return _money_dbl(ct.early_window(T(spark, sf), n_rows=2500, first_id=0))


@register("load_summary", with_ctes("""
SELECT COUNT(*) AS rows_loaded, COUNT(DISTINCT step) AS distinct_steps, MIN(step) AS first_step, MAX(step) AS last_step,
  COUNT(DISTINCT txn_type) AS distinct_types, CAST(SUM(is_fraud) AS BIGINT) AS fraud_rows,
  CAST(SUM(is_fraud) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS fraud_rate FROM transactions""", TXN))
def q_load_summary(spark, sf):
    return ct.load_summary(T(spark, sf))


@register("write_features", _fsql("*"))
def q_write_features(spark, sf):
    """Feature table written partitioned by sim_day, then read back (prunable by day)."""
    path = _scratch(spark, "features")
    sinks.write_features(fe.build_features(T(spark, sf)), path)
    return spark.read.parquet(path)


@register("write_table", with_ctes("""
SELECT txn_type, COUNT(*) AS transactions, CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM transactions GROUP BY 1""", TXN))
def q_write_table(spark, sf):
    """A result table written as CSV with header and read back."""
    path = _scratch(spark, "table")
    by_type = T(spark, sf).groupBy("txn_type").agg(F.count("*").alias("transactions"), F.sum("is_fraud").alias("fraud"))
    sinks.write_table(by_type, path, "csv")
    return spark.read.option("header", True).schema("txn_type string, transactions bigint, fraud bigint").csv(path)


# ---- P1-P18 ----------------------------------------------------------------

@register("entity_split", with_ctes("""
SELECT txn_id, substr(name_orig, 1, 1) AS orig_kind, TRY_CAST(substr(name_orig, 2) AS BIGINT) AS orig_number,
  substr(name_dest, 1, 1) AS dest_kind, TRY_CAST(substr(name_dest, 2) AS BIGINT) AS dest_number FROM transactions""", TXN))
def q_entity_split(spark, sf):
    return dv.entity_split(T(spark, sf)).select("txn_id", "orig_kind", "orig_number", "dest_kind", "dest_number")


@register("compact", with_ctes("""
SELECT txn_id, step, txn_type, CAST(amount AS DOUBLE) AS amount, substr(name_orig, 1, 1) AS orig_kind,
  TRY_CAST(substr(name_orig, 2) AS BIGINT) AS orig_number, substr(name_dest, 1, 1) AS dest_kind,
  TRY_CAST(substr(name_dest, 2) AS BIGINT) AS dest_number, CAST(old_balance_orig AS DOUBLE) AS old_balance_orig,
  CAST(new_balance_orig AS DOUBLE) AS new_balance_orig, CAST(old_balance_dest AS DOUBLE) AS old_balance_dest,
  CAST(new_balance_dest AS DOUBLE) AS new_balance_dest, is_fraud, is_flagged_fraud FROM transactions""", TXN))
def q_compact(spark, sf):
    """Names replaced by kind + number columns; every other column stays."""
    return _money_dbl(dv.entity_split(T(spark, sf)).drop("name_orig", "name_dest"))


@register("time_columns", with_ctes("""
SELECT txn_id, CAST(floor((step - 1) / 24) AS INTEGER) + 1 AS sim_day, CAST((step - 1) % 24 AS INTEGER) AS hour_of_day,
  CAST(CAST(floor((step - 1) / 24) AS BIGINT) % 7 AS INTEGER) AS assumed_day_of_week FROM transactions""", TXN))
def q_time_columns(spark, sf):
    return dv.time_columns(T(spark, sf)).select("txn_id", "sim_day", "hour_of_day", "assumed_day_of_week")


@register("balance_residuals", with_ctes("""
SELECT txn_id, CAST(new_balance_orig - (old_balance_orig + CASE WHEN txn_type = 'CASH_IN' THEN amount ELSE -amount END) AS DOUBLE)
  AS balance_error_orig, CAST(new_balance_dest - (old_balance_dest + amount) AS DOUBLE) AS balance_error_dest FROM transactions""", TXN))
def q_balance_residuals(spark, sf):
    r = dv.balance_residuals(T(spark, sf))
    return r.select("txn_id", F.col("balance_error_orig").cast("double").alias("balance_error_orig"),
                    F.col("balance_error_dest").cast("double").alias("balance_error_dest"))


@register("log_amount", with_ctes(
    "SELECT txn_id, round(log10(CAST(greatest(amount, 0) AS DOUBLE) + 1.0), 9) AS log_amount FROM transactions", TXN))
def q_log_amount(spark, sf):
    return T(spark, sf).select("txn_id", dv.log_amount().alias("log_amount"))


@register("amount_is_round_1000", with_ctes(
    "SELECT txn_id, CASE WHEN amount % 1000 = 0 THEN 1 ELSE 0 END AS amount_is_round_1000 FROM transactions", TXN))
def q_amount_is_round_1000(spark, sf):
    return T(spark, sf).select("txn_id", dv.is_round_1000().alias("amount_is_round_1000"))


@register("dest_is_merchant", with_ctes(
    "SELECT txn_id, CASE WHEN starts_with(name_dest, 'M') THEN 1 ELSE 0 END AS dest_is_merchant FROM transactions", TXN))
def q_dest_is_merchant(spark, sf):
    return T(spark, sf).select("txn_id", dv.dest_is_merchant().alias("dest_is_merchant"))


@register("safe_ratio", with_ctes(
    "SELECT txn_id, CAST(amount AS DOUBLE) / NULLIF(CAST(old_balance_dest AS DOUBLE), 0) AS amount_to_dest_balance, "
    "CAST(new_balance_orig AS DOUBLE) / NULLIF(CAST(old_balance_orig AS DOUBLE), 0) AS orig_balance_ratio FROM transactions", TXN))
def q_safe_ratio(spark, sf):
    """X / NULLIF(y, 0) on columns that really are zero for fraud rows (no DIVIDE_BY_ZERO under ANSI)."""
    t = T(spark, sf)
    return t.select("txn_id", dv.ratio("amount", "old_balance_dest").alias("amount_to_dest_balance"),
                    dv.ratio("new_balance_orig", "old_balance_orig").alias("orig_balance_ratio"))


_BAND_SQL = ("CASE WHEN amount IS NULL OR amount < 0 THEN NULL WHEN amount < 1000 THEN '0-1k' WHEN amount < 10000 THEN '1k-10k' "
             "WHEN amount < 50000 THEN '10k-50k' WHEN amount < 200000 THEN '50k-200k' WHEN amount < 1000000 THEN '200k-1M' "
             "ELSE '1M+' END")


@register("amount_band", with_ctes(f"SELECT txn_id, {_BAND_SQL} AS amount_band FROM transactions", TXN))
def q_amount_band(spark, sf):
    return T(spark, sf).select("txn_id", dv.amount_band().alias("amount_band"))


@register("fan_in_band", with_ctes(
    "SELECT txn_id, CASE WHEN dest_prior_unique_senders = 0 THEN '0 senders (first ever)' WHEN dest_prior_unique_senders < 5 "
    "THEN '1-4 senders' WHEN dest_prior_unique_senders < 20 THEN '5-19 senders' WHEN dest_prior_unique_senders < 50 "
    "THEN '20-49 senders' ELSE '50+ senders' END AS fan_in_band FROM features", TXN, FEATURES))
def q_fan_in_band(spark, sf):
    d = fe.dest_history(T(spark, sf))
    return d.select("txn_id", dv.fan_in_band().alias("fan_in_band"))


@register("velocity_band", with_ctes(
    "SELECT txn_id, CASE WHEN dest_txn_prev_24h = 0 THEN '0' WHEN dest_txn_prev_24h = 1 THEN '1' WHEN dest_txn_prev_24h < 5 "
    "THEN '2-4' WHEN dest_txn_prev_24h < 10 THEN '5-9' ELSE '10+' END AS velocity_band FROM features", TXN, FEATURES))
def q_velocity_band(spark, sf):
    d = fe.dest_history(T(spark, sf), fan_in=False)
    return d.select("txn_id", dv.velocity_band().alias("velocity_band"))


@register("one_hot_type", with_ctes("SELECT txn_id, " + ", ".join(
    f"CASE WHEN txn_type = '{t}' THEN 1 ELSE 0 END AS type_{t}" for t in ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"))
    + " FROM transactions", TXN))
def q_one_hot_type(spark, sf):
    return T(spark, sf).select("txn_id", *dv.one_hot_type())


@register("fill_missing", with_ctes("SELECT txn_id, " + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in fe.MODEL_COLUMNS) + " FROM features", TXN, FEATURES))
def q_fill_missing(spark, sf):
    f = fe.fill_missing(fe.build_features(T(spark, sf)))
    return f.select("txn_id", *fe.MODEL_COLUMNS)


@register("class_label", with_ctes(
    "SELECT txn_id, CASE WHEN is_fraud = 1 THEN 'fraudulent' ELSE 'legitimate' END AS class FROM transactions", TXN))
def q_class_label(spark, sf):
    return T(spark, sf).select("txn_id", dv.class_label().alias("class"))


@register("model_columns", with_ctes(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, COUNT({c}) AS defined, COUNT(*) FILTER (WHERE {c} <> 0) AS non_zero FROM features"
    for i, c in enumerate(fe.MODEL_COLUMNS)), TXN, FEATURES))
def q_model_columns(spark, sf):
    """The model input list with how many rows define each column and how many are not zero."""
    from riskframe.config import LEAKAGE_SUSPECTS
    banned = set(LEAKAGE_SUSPECTS) | {"step", "is_fraud", "txn_id"}
    assert not banned & set(fe.MODEL_COLUMNS)
    f = fe.build_features(T(spark, sf))
    one = f.agg(*[F.count(c).alias(f"d_{c}") for c in fe.MODEL_COLUMNS],
                *[F.count(F.when(F.col(c) != 0, 1)).alias(f"z_{c}") for c in fe.MODEL_COLUMNS])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"d_{c}").alias("defined"), F.col(f"z_{c}").alias("non_zero"))
        for i, c in enumerate(fe.MODEL_COLUMNS)])).alias("s")).select("s.*")


_SCORE = ("CAST(amount AS DOUBLE) / (CAST(amount AS DOUBLE) + CAST(250 AS DOUBLE)) * CASE WHEN txn_type IN "
          "('TRANSFER','CASH_OUT') THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END")


@register("outcome_class", with_ctes(f"""
SELECT txn_id, CASE WHEN s >= 0.5 AND is_fraud = 1 THEN 'true_positive' WHEN s >= 0.5 AND is_fraud = 0 THEN 'false_positive'
  WHEN NOT s >= 0.5 AND is_fraud = 1 THEN 'false_negative' ELSE 'true_negative' END AS outcome_class
FROM (SELECT *, {_SCORE} AS s FROM transactions)""", TXN))
def q_outcome_class(spark, sf):
    from riskframe.sources.fixtures import scorecard
    s = scorecard(T(spark, sf)).withColumn("predicted_flag", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    return s.select("txn_id", dv.outcome_class().alias("outcome_class"))


@register("risk_band", with_ctes(f"""
SELECT txn_id, CASE WHEN s >= 0.6 THEN 'HIGH' WHEN s >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
FROM (SELECT *, {_SCORE} AS s FROM transactions)""", TXN))
def q_risk_band(spark, sf):
    """P18 with two literal bounds (the cost-derived bounds are exercised by risk_bands / scored_table)."""
    from riskframe.sources.fixtures import scorecard
    return scorecard(T(spark, sf)).select("txn_id", dv.risk_band("score", 0.3, 0.6).alias("risk_band"))
