"""Coverage and business analysis on the feature table."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig
from riskframe.session import cached
from riskframe.functions.derive import (class_label, count_if, dbl, fan_in_band, pct, risk_type,
                                        sql_amount_band, velocity_band)
from riskframe.functions.radix import profiles, quantile_rows
from riskframe.operators.features import MODEL_COLUMNS


def _n():
    return F.count(F.lit(1))


def _fraud():
    return F.sum("is_fraud").cast("bigint").alias("fraud")


def feature_coverage(features: DataFrame, columns: list[str] | None = None, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """B1: per feature -- % defined, % non-zero, mean, median; counts, sums and medians of all features come from the
    same radix passes over one row per transaction, which is kept while they run."""
    columns = columns or MODEL_COLUMNS
    features = cached(features.select(*[dbl(c).alias(c) for c in columns]))
    found = profiles(features, columns, [0.5])
    rows = []
    for c in columns:
        p = found.get((c, ""))
        rows.append((c, p.n, p.n - p.zeros, p.total, p.quantiles[0.5]) if p else (c, 0, 0, None, None))
    table = features.sparkSession.createDataFrame(rows, "feature string, _def long, _nz long, _sum double, _med double")
    return table.crossJoin(features.agg(_n().alias("_n"))).where("_n > 0").select(
        "feature", pct("_def", "_n").alias("defined_pct"), pct("_nz", "_n").alias("nonzero_pct"),
        F.round(F.col("_sum") / F.when(F.col("_def") > 0, dbl("_def")), 6).alias("mean"), F.round("_med", 6).alias("median"))


def leakage_self_check(features: DataFrame) -> DataFrame:
    """B2: first row of every destination (found by aggregation) must have zero prior count."""
    first = features.groupBy("name_dest").agg(F.min(F.struct("step", "txn_id")).alias("f")) \
                    .select(F.col("f.txn_id").alias("txn_id"))
    v = features.select("txn_id", "dest_prior_txn_count").join(first, "txn_id")
    return v.agg(count_if(F.col("dest_prior_txn_count") != 0).alias("frames_that_include_the_current_row"))


def class_separation(features: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """B3 (Q1): per class medians/averages of the behavioural features."""
    def avg_int(c):
        return dbl(F.sum(c)) / dbl(_n())
    features = cached(features.select("is_fraud", "amount", "dest_prior_txn_count", "dest_prior_unique_senders", "dest_txn_prev_24h",
                                      "dest_txn_prev_168h", "pair_prior_txn_count", "pair_is_new", "dest_is_new",
                                      "dest_is_merchant", "amount_to_type_prior_avg"))  # aggregate + median passes
    g = features.groupBy(class_label().alias("class")).agg(
        _n().alias("transactions"),
        avg_int("dest_prior_txn_count").alias("avg_dest_prior_txns"),
        avg_int("dest_prior_unique_senders").alias("avg_dest_fan_in"),
        avg_int("dest_txn_prev_24h").alias("avg_dest_velocity_24h"),
        avg_int("dest_txn_prev_168h").alias("avg_dest_velocity_168h"),
        avg_int("pair_prior_txn_count").alias("avg_pair_history"),
        (F.lit(100.0) * avg_int("pair_is_new")).alias("pct_new_relationship"),
        (F.lit(100.0) * avg_int("dest_is_new")).alias("pct_new_destination"),
        (F.lit(100.0) * avg_int("dest_is_merchant")).alias("pct_to_merchant"),
        F.round(F.avg("amount_to_type_prior_avg"), 6).alias("avg_amount_vs_type_avg"))
    med = quantile_rows(features.select(class_label().alias("class"), "amount"), ["amount"], [0.5], "class") \
        .select("class", F.round("value", 9).alias("median_amount"))
    return g.join(med, "class")


def fraud_by_type(txns: DataFrame) -> DataFrame:
    """B4 (Q2)."""
    fv = F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")))
    g = txns.groupBy("txn_type").agg(_n().alias("transactions"), _fraud(), fv.alias("_fv"), F.sum("amount").alias("_tv"))
    return g.select("txn_type", "transactions", "fraud", pct("fraud", "transactions").alias("fraud_rate_pct"),
                    dbl("_fv").alias("fraud_value"), pct("_fv", "_tv").alias("fraud_share_of_value_pct"))


def amount_bands(txns: DataFrame) -> DataFrame:
    """B6 (Q3): risk per amount band, incl. fraud value per 1,000 transactions."""
    fv = F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")))
    g = txns.groupBy(sql_amount_band().alias("amount_band")).agg(_n().alias("transactions"), _fraud(), fv.alias("_fv"))
    return g.select("amount_band", "transactions", "fraud", pct("fraud", "transactions").alias("fraud_rate_pct"),
                    dbl("_fv").alias("fraud_value"),
                    (F.lit(1000.0) * dbl("_fv") / dbl("transactions")).alias("fraud_value_per_1000_txns"))


def _banded(features: DataFrame, band, floor_col: str, label: str) -> DataFrame:
    g = features.groupBy(band.alias(label)).agg(F.min(floor_col).alias("band_floor"), _n().alias("transactions"),
                                                _fraud())
    return g.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def fan_in_bands(features: DataFrame) -> DataFrame:
    """B7 (Q4): ordered by band floor."""
    return _banded(features, fan_in_band(), "dest_prior_unique_senders", "fan_in_band")


def relationship(features: DataFrame) -> DataFrame:
    """B8 (Q5)."""
    lab = F.when(F.col("pair_is_new") == 1, "first transaction to this counterparty").otherwise("existing relationship")
    g = features.groupBy(lab.alias("relationship")).agg(_n().alias("transactions"), _fraud())
    return g.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def velocity_bands(features: DataFrame) -> DataFrame:
    """B9 (Q6): fraud by 24h destination-velocity band."""
    return _banded(features, velocity_band(), "dest_txn_prev_24h", "dest_txns_in_prev_24h")


def daily_trend(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """B10 (Q7)."""
    day = (F.floor((F.col("step") - 1) / cfg.steps_per_day) + 1).cast("int")
    fv = F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")))
    g = txns.groupBy(day.alias("sim_day")).agg(_n().alias("transactions"), _fraud(), fv.alias("_fv"))
    return g.select("sim_day", "transactions", "fraud", pct("fraud", "transactions").alias("fraud_rate_pct"),
                    dbl("_fv").alias("fraud_value"))


def split_boundaries(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """B11 (Q8): last step whose cumulative volume share is <= train and <= train+validation.

    Integer arithmetic (cum * q <= total * p) instead of float shares.  The
    per-step table has one row per step (bounded by the time span), so the
    running sum over it is a small single-partition window by design.
    """
    tr = Fraction(str(cfg.train_fraction)).limit_denominator(10 ** 6)
    tv = Fraction(str(cfg.train_fraction)) + Fraction(str(cfg.validation_fraction))
    tv = tv.limit_denominator(10 ** 6)
    per = txns.groupBy("step").agg(_n().alias("n"))
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    c = per.select("step", F.sum("n").over(w).alias("cum"), F.sum("n").over(Window.partitionBy()).alias("tot"))
    ok_tr = F.col("cum") * tr.denominator <= F.col("tot") * tr.numerator
    ok_tv = F.col("cum") * tv.denominator <= F.col("tot") * tv.numerator
    return c.agg(F.max(F.when(ok_tr, F.col("step"))).alias("train_end_step"),
                 F.max(F.when(ok_tv, F.col("step"))).alias("validation_end_step"),
                 F.max("step").alias("test_end_step"))


NOTEBOOK_MEDIAN_COLUMNS = ["amount", "dest_prior_txn_count", "dest_prior_unique_senders", "dest_txn_prev_24h",
                           "dest_txn_prev_168h", "pair_prior_txn_count", "pair_is_new", "dest_is_new",
                           "dest_is_merchant"]


def class_medians(features: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Medians of nine features by class, long form (column, is_fraud, median)."""
    features = cached(features.select("is_fraud", *[dbl(c).alias(c) for c in NOTEBOOK_MEDIAN_COLUMNS]))  # read by each pass
    m = quantile_rows(features, NOTEBOOK_MEDIAN_COLUMNS, [0.5], "is_fraud")
    return m.select("column", "is_fraud", F.round("value", 9).alias("median"))


def rule_queue(features: DataFrame, k: int = 50) -> DataFrame:
    """T1 (Q9): the k largest TRANSFER/CASH_OUT amounts to a brand-new pair (a top-k report:
    TakeOrderedAndProject keeps k rows per partition, never a global sort)."""
    return (features.where(risk_type() & (F.col("pair_is_new") == 1))
            .orderBy(F.col("amount").desc(), F.col("txn_id")).limit(k)
            .select("txn_id", "step", "txn_type", dbl("amount").alias("amount"), "dest_prior_txn_count",
                    "dest_prior_unique_senders", "dest_txn_prev_24h", "pair_is_new", "is_fraud"))
