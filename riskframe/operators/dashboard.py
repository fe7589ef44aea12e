"""Dashboard tables and figure data.

Everything starts from one decision context: the threshold is chosen on the
validation split (argmin of simulated cost), the LOW/MEDIUM/HIGH bounds come
from two validation sweeps, and the scored table is the test split.  Only
three numbers travel through the driver; all tables stay distributed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig, TXN_TYPES
from riskframe.functions.derive import (amount_band, count_if, dbl, outcome_class, pct, risk_band)
from riskframe.functions.ordered import exact_quantiles
from riskframe.functions.radix import quantile_rows
from riskframe.operators import cost as co
from riskframe.operators import ranking as rk
from riskframe.operators.model import split_steps


@dataclass
class Decision:
    scored_test: DataFrame      # test rows + fraud_probability, predicted_flag, risk_band, outcome_class, amount_band
    test: DataFrame             # test rows with `score`
    threshold: float            # chosen on validation
    verify: float
    block: float
    train_end: int
    val_end: int


def decide(rows: DataFrame, score: str = "score", cfg: RiskConfig = DEFAULT, thin: DataFrame | None = None,
           split: tuple[int, int, int] | None = None) -> Decision:
    """Split by step, choose the threshold and band bounds on validation, score the test split.

    `thin` is a cheaper frame of the same transactions with step, score and
    label (before the features are added, say): boundaries and thresholds are
    read from it, so `rows` itself is computed once, for the output.  `split`
    has the boundaries where they are known: then no rows of training are needed."""
    thin = rows if thin is None else thin
    tr, ve, _ = split or split_steps(thin, cfg)
    val = thin.where((F.col("step") > tr) & (F.col("step") <= ve))
    test = rows.where(F.col("step") > ve)
    bands = co.risk_band_thresholds(val, score, "is_fraud", cfg).first()   # two control values
    block, verify = float(bands["high_risk_threshold_block"]), float(bands["medium_risk_threshold_verify"])
    threshold = block  # argmin of the validation sweep at the blocking cost = the chosen operating point
    s = test.select("*", F.col(score).alias("fraud_probability"),
                    F.when(F.col(score) >= F.lit(threshold), 1).otherwise(0).alias("predicted_flag"),
                    risk_band(score, verify, block).alias("risk_band"))
    s = s.select("*", outcome_class().alias("outcome_class"), amount_band("amount", cfg).alias("amount_band"))
    return Decision(s, test, threshold, verify, block, tr, ve)


CONTEXT_COLUMNS = ["txn_id", "step", "sim_day", "hour_of_day", "txn_type", "amount", "name_orig", "name_dest",
                   "dest_is_merchant", "dest_prior_txn_count", "dest_prior_unique_senders", "dest_txn_prev_24h",
                   "dest_txn_prev_168h", "dest_txn_prev_1h", "pair_prior_txn_count", "pair_is_new", "dest_is_new",
                   "orig_prior_txn_count", "orig_amount_to_prior_avg", "amount_to_type_prior_avg",
                   "fraud_probability", "risk_band", "predicted_flag", "is_fraud", "outcome_class", "amount_band"]


def scored_table(d: Decision) -> DataFrame:
    """Row-level scored test set (txn_id is the row identity, D16)."""
    cols = [c for c in CONTEXT_COLUMNS if c in d.scored_test.columns]
    return d.scored_test.select(*[dbl(c).alias(c) if c == "amount" else F.col(c) for c in cols])


def kpi_summary(d: Decision, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Single-row KPIs; the test sweep contains the chosen threshold so alerts agree with FP+TP."""
    s = d.scored_test
    sweep = co.threshold_sweep(d.test, extra_thresholds=[d.threshold], cfg=cfg)
    opt = co.summarise_at(sweep, d.threshold, cfg)
    rank = rk.ranking_metrics(d.test, "score", "is_fraud", [], cfg).select(
        F.col("roc_auc").alias("model_roc_auc"), F.col("pr_auc").alias("model_pr_auc"))
    base = s.agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.sum("is_fraud").cast("bigint").alias("total_fraud_transactions"),
                 dbl(F.sum("amount")).alias("total_transaction_value"),
                 dbl(F.sum(F.when(F.col("is_fraud") == 1, F.col("amount")))).alias("fraudulent_transaction_value"),
                 F.sum("predicted_flag").cast("bigint").alias("alerts_raised"))
    return base.crossJoin(opt).crossJoin(rank).select(
        "total_transactions", "total_fraud_transactions",
        pct("total_fraud_transactions", "total_transactions").alias("fraud_rate_pct"),
        "total_transaction_value", "fraudulent_transaction_value",
        F.col("optimal_threshold").alias("selected_threshold"),
        (F.lit(100.0) * F.col("fraud_capture_rate")).alias("fraud_capture_rate_pct"),
        (F.lit(100.0) * F.col("false_positive_rate")).alias("false_positive_rate_pct"),
        (F.lit(100.0) * F.col("precision")).alias("precision_pct"), "alerts_raised",
        F.col("FP").alias("legitimate_transactions_blocked"), F.col("FN").alias("fraud_missed"),
        F.col("total_cost_at_optimum").alias("simulated_total_cost"),
        F.col("cost_missed_fraud").alias("simulated_cost_missed_fraud"),
        F.col("cost_customer_friction").alias("simulated_cost_customer_friction"),
        F.col("cost_at_threshold_0_50").alias("simulated_cost_at_threshold_0_50"),
        "model_roc_auc", "model_pr_auc",
        F.lit(cfg.cost_fn).alias("cost_assumption_false_negative"),
        F.lit(cfg.cost_fp).alias("cost_assumption_false_positive"),
        F.lit("SIMULATED / ESTIMATED UNDER ASSUMPTIONS").alias("cost_basis"))


def threshold_cost_curve(d: Decision, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """D3: the test sweep (with the chosen threshold on its grid)."""
    return co.threshold_sweep(d.test, extra_thresholds=[d.threshold], cfg=cfg)


def cost_sensitivity(d: Decision, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The 25-scenario grid on test scores (D13: split parameter defaults to test)."""
    return co.sensitivity_grid(d.test, cfg=cfg)


def _oc(name):
    return count_if(F.col("outcome_class") == name)


def fraud_by_type(d: DataFrame) -> DataFrame:
    """One grouped pass with conditional counts."""
    g = d.groupBy("txn_type").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"),
        dbl(F.sum("amount")).alias("total_amount"),
        dbl(F.coalesce(F.sum(F.when(F.col("is_fraud") == 1, F.col("amount"))), F.lit(0))).alias("fraud_amount"),
        F.sum("predicted_flag").cast("bigint").alias("alerts"), _oc("false_positive").alias("false_positives"),
        _oc("true_positive").alias("true_positives"), _oc("false_negative").alias("false_negatives"))
    return g.select("*", pct("fraud", "transactions").alias("fraud_rate_pct"),
                    pct("false_positives", F.col("transactions") - F.col("fraud")).alias("false_positive_rate_pct"))


def fraud_over_time(d: DataFrame) -> DataFrame:
    """Per step; outcome counts by conditional aggregation (one shuffle instead of 3 left joins)."""
    g = d.groupBy("step").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"),
        F.sum("predicted_flag").cast("bigint").alias("alerts"), dbl(F.sum("amount")).alias("total_amount"),
        _oc("true_positive").alias("true_positive"), _oc("false_positive").alias("false_positive"),
        _oc("false_negative").alias("false_negative"))
    return g.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def outcomes_by_step_join(d: DataFrame) -> DataFrame:
    """The same trend as a left equi-join of per-step outcome counts onto the per-step volume."""
    base = d.groupBy("step").agg(F.count(F.lit(1)).alias("transactions"))
    out = base
    for name in ("true_positive", "false_positive", "false_negative"):
        c = d.where(F.col("outcome_class") == name).groupBy("step").agg(F.count(F.lit(1)).alias(name))
        out = out.join(c, "step", "left")
    return out.fillna(0, ["true_positive", "false_positive", "false_negative"])


def false_positive_profile(d: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Legitimate rows only, by type x amount band (observed groups)."""
    legit = d.where(F.col("is_fraud") == 0)
    g = legit.groupBy("txn_type", "amount_band").agg(
        F.count(F.lit(1)).alias("legitimate_transactions"), _oc("false_positive").alias("false_positives"),
        dbl(F.sum("amount")).alias("legitimate_value"))
    return g.select("*", pct("false_positives", "legitimate_transactions").alias("false_positive_rate_pct"),
                    (dbl("false_positives") * F.lit(cfg.cost_fp)).alias("simulated_friction_cost"))


def risk_band_definition(d: Decision, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Band definitions left-joined with observed counts (missing band -> 0)."""
    spark = d.scored_test.sparkSession
    bands = spark.createDataFrame(
        [(0, "LOW", 0.0, d.verify, co.BAND_ACTIONS[0][1]), (1, "MEDIUM", d.verify, d.block, co.BAND_ACTIONS[1][1]),
         (2, "HIGH", d.block, None, co.BAND_ACTIONS[2][1])],
        "band_order int, band string, lower_bound double, upper_bound double, action string")
    counts = d.scored_test.groupBy(F.col("risk_band").alias("band")).agg(
        F.count(F.lit(1)).alias("transactions_in_band"), F.sum("is_fraud").cast("bigint").alias("fraud_in_band"))
    j = bands.join(F.broadcast(counts), "band", "left").fillna(0, ["transactions_in_band", "fraud_in_band"])
    return j.select("band_order", "band", "lower_bound", "upper_bound", "action",
                    F.col("transactions_in_band").cast("bigint").alias("transactions_in_band"),
                    F.col("fraud_in_band").cast("bigint").alias("fraud_in_band"),
                    pct("fraud_in_band", "transactions_in_band").alias("fraud_rate_in_band_pct"))


def friction_summary(d: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Total FP, FP rate among legitimate rows, friction cost, worst type (ties -> name)."""
    legit = d.where(F.col("is_fraud") == 0)
    fp = F.col("outcome_class") == "false_positive"
    by_type = legit.groupBy("txn_type").agg(count_if(fp).alias("fps"), F.count(F.lit(1)).alias("n"))
    worst = by_type.orderBy(F.col("fps").desc(), "txn_type").limit(1).select(
        F.col("txn_type").alias("worst_type"), F.col("fps").alias("worst_type_false_positives"),
        pct("fps", "n").alias("worst_type_false_positive_rate_pct"))
    tot = legit.agg(count_if(fp).alias("total_false_positives"), F.count(F.lit(1)).alias("_n"))
    return tot.crossJoin(worst).select(
        "total_false_positives", pct("total_false_positives", "_n").alias("false_positive_rate_pct"),
        (dbl("total_false_positives") * F.lit(cfg.cost_fp)).alias("friction_cost"),
        "worst_type", "worst_type_false_positives", "worst_type_false_positive_rate_pct")


def dash_measures(d: DataFrame, cost_fn: float | None = None, cost_fp: float | None = None,
                  cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Fraud rate, alert precision, simulated total cost with what-if costs."""
    cost_fn = cfg.cost_fn if cost_fn is None else cost_fn
    cost_fp = cfg.cost_fp if cost_fp is None else cost_fp
    a = d.agg(F.count(F.lit(1)).alias("_n"), F.sum("is_fraud").alias("_f"), _oc("true_positive").alias("_tp"),
              count_if(F.col("predicted_flag") == 1).alias("_fl"), _oc("false_negative").alias("_fn"),
              _oc("false_positive").alias("_fp"))
    return a.select((dbl("_f") / F.when(F.col("_n") > 0, dbl("_n"))).alias("fraud_rate"),
                    (dbl("_tp") / F.when(F.col("_fl") > 0, dbl("_fl"))).alias("alert_precision"),
                    (dbl("_fn") * F.lit(float(cost_fn)) + dbl("_fp") * F.lit(float(cost_fp))).alias("simulated_total_cost"))


def amount_band_by_class(d: DataFrame) -> DataFrame:
    """Count by amount band x label."""
    return d.groupBy("amount_band", "is_fraud").agg(F.count(F.lit(1)).alias("transactions"))


def queue_composition(d: DataFrame) -> DataFrame:
    """Alerts in queue, queue (HIGH/MEDIUM) by band, alerts by type -- long form (view, key, n)."""
    q = d.where(F.col("risk_band").isin("HIGH", "MEDIUM")).groupBy(F.col("risk_band").alias("key")) \
         .agg(F.count(F.lit(1)).alias("n")).withColumn("view", F.lit("queue_by_risk_band"))
    t = d.where(F.col("predicted_flag") == 1).groupBy(F.col("txn_type").alias("key")) \
         .agg(F.count(F.lit(1)).alias("n")).withColumn("view", F.lit("alerts_by_type"))
    a = d.agg(count_if(F.col("predicted_flag") == 1).alias("n")).select(
        F.lit("alerts_in_queue").alias("view"), F.lit("all").alias("key"), "n")
    return q.select("view", "key", "n").unionByName(t.select("view", "key", "n")).unionByName(a)


def band_column(label: str) -> str:
    return "fp_rate_" + label.replace("-", "_to_").replace("+", "_plus")


def friction_heat(d: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """FP-rate matrix, type x amount band (fixed band list -> stable schema)."""
    legit = d.where(F.col("is_fraud") == 0)
    p = legit.groupBy("txn_type").pivot("amount_band", list(cfg.amount_band_labels)).agg(
        pct(count_if(F.col("outcome_class") == "false_positive"), F.count(F.lit(1))))
    return p.select("txn_type", *[F.col(f"`{b}`").alias(band_column(b)) for b in cfg.amount_band_labels])


def blocked_value(d: DataFrame) -> DataFrame:
    """Value of legitimate transactions blocked."""
    return d.agg(dbl(F.coalesce(F.sum(F.when(F.col("outcome_class") == "false_positive", F.col("amount"))),
                                F.lit(0))).alias("blocked_legitimate_value"))


def hist_log_amount(txns: DataFrame, bins: int = 60, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """log10(amount) over positive amounts.

    `all`: counts in `bins` equal bins.  `legitimate` and `fraudulent` (each if
    it has rows): counts, densities and the class median over the bins between
    `bins` edges, so one bin less.  Empty bins are rows with zero.
    """
    x = txns.where(F.col("amount") > 0).select(F.round(F.log10(dbl("amount")), 9).alias("x"), "is_fraud")
    mm = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))

    def bin_of(k: int):
        width = (F.col("hi") - F.col("lo")) / F.lit(float(k))
        at = F.floor((F.col("x") - F.col("lo")) / F.when(width > 0, width))
        return F.least(F.coalesce(at, F.lit(0)), F.lit(k - 1)).cast("int")

    small = x.crossJoin(F.broadcast(mm)).groupBy("lo", "hi", "is_fraud", bin_of(bins).alias("b0"), bin_of(bins - 1).alias("b1")) \
        .agg(F.count(F.lit(1)).alias("n"))  # bins x 2 x 2 rows at most
    med = exact_quantiles(x, "x", [0.5], ["is_fraud"], cfg).select(F.col("is_fraud").alias("of"), F.round("value", 9).alias("median"))
    label = F.when(F.col("is_fraud") == 1, "fraudulent").otherwise("legitimate")
    every = small.groupBy("lo", "hi", F.lit("all").alias("histogram"), F.lit(None).cast("int").alias("of"), F.col("b0").alias("bin")) \
        .agg(F.sum("n").alias("n"))
    classes = small.groupBy("lo", "hi", label.alias("histogram"), F.col("is_fraud").alias("of"), F.col("b1").alias("bin")) \
        .agg(F.sum("n").alias("n"))
    counts = every.unionByName(classes)
    frame = counts.groupBy("lo", "hi", "histogram", "of").agg(F.sum("n").alias("total"))
    k = F.when(F.col("histogram") == "all", bins).otherwise(bins - 1)
    frame = frame.withColumn("k", k).withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    full = frame.join(counts.select("histogram", "bin", "n"), ["histogram", "bin"], "left").join(med, "of", "left")
    width = (F.col("hi") - F.col("lo")) / dbl("k")
    n = F.coalesce("n", F.lit(0))
    return full.select("histogram", "bin", (F.col("lo") + dbl("bin") * width).alias("bin_lo"), n.cast("bigint").alias("n"),
                       F.when(F.col("histogram") != "all", dbl(n) / F.when(width > 0, dbl("total") * width)).alias("density"),
                       "median")


def hist_account_txns(txns: DataFrame, clip: int = 20) -> DataFrame:
    """accounts by transaction count clipped at 20, per side, with % single-use accounts; empty bins are rows with 0."""
    out = None
    for key, side in (("name_orig", "origin"), ("name_dest", "destination")):
        per = txns.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        h = per.groupBy(F.least(F.col("n"), F.lit(clip)).alias("c")).agg(F.count(F.lit(1)).alias("accounts"))
        once = h.agg(pct(F.sum(F.when(F.col("c") == 1, F.col("accounts")).otherwise(0)), F.sum("accounts")).alias("single_use_pct"))
        bins = txns.sparkSession.range(1, clip + 1).withColumnRenamed("id", "txns_clipped")
        h = bins.join(h, F.col("txns_clipped") == F.col("c"), "left").crossJoin(once).select(
            F.lit(side).alias("side"), "txns_clipped", F.coalesce("accounts", F.lit(0)).cast("bigint").alias("accounts"), "single_use_pct")
        out = h if out is None else out.unionByName(h)
    return out


def fp_by_type_and_band(d: DataFrame) -> DataFrame:
    """FP sum / rate / size among legitimate rows, by type and by amount band (stacked)."""
    legit = d.where(F.col("is_fraud") == 0)
    fp = F.col("outcome_class") == "false_positive"

    def by(col_, dim):
        return legit.groupBy(F.col(col_).alias("key")).agg(
            count_if(fp).alias("false_positives"), (dbl(count_if(fp)) / dbl(F.count(F.lit(1)))).alias("fp_rate"),
            F.count(F.lit(1)).alias("legitimate_transactions")).withColumn("dimension", F.lit(dim))
    cols = ["dimension", "key", "false_positives", "fp_rate", "legitimate_transactions"]
    return by("txn_type", "type").select(*cols).unionByName(by("amount_band", "amount_band").select(*cols))


def band_distribution(d: Decision) -> DataFrame:
    """n, fraud, rate per LOW / MEDIUM / HIGH (fixed list, left join)."""
    spark = d.scored_test.sparkSession
    bands = spark.createDataFrame([(0, "LOW"), (1, "MEDIUM"), (2, "HIGH")], "band_order int, risk_band string")
    c = d.scored_test.groupBy("risk_band").agg(F.count(F.lit(1)).alias("transactions"),
                                               F.sum("is_fraud").cast("bigint").alias("fraud"))
    j = bands.join(F.broadcast(c), "risk_band", "left").fillna(0, ["transactions", "fraud"])
    return j.select("band_order", "risk_band", F.col("transactions").cast("bigint").alias("transactions"),
                    F.col("fraud").cast("bigint").alias("fraud"), pct("fraud", "transactions").alias("fraud_rate_pct"))


def analyst_queue(d: DataFrame) -> DataFrame:
    """HIGH/MEDIUM rows by probability (desc, txn_id) -- a distributed range-partitioned sort."""
    cols = ["txn_id", "step", "txn_type", "amount", "fraud_probability", "risk_band", "dest_txn_prev_24h",
            "dest_prior_unique_senders", "dest_prior_txn_count", "pair_is_new", "dest_is_new",
            "orig_amount_to_prior_avg", "amount_to_type_prior_avg"]
    q = d.where(F.col("risk_band").isin("HIGH", "MEDIUM"))
    return q.orderBy(F.col("fraud_probability").desc(), "txn_id").select(
        *[dbl(c).alias(c) if c == "amount" else F.col(c) for c in cols if c in q.columns])


def top_scored(d: DataFrame, n: int = 10) -> DataFrame:
    """T4: n largest probabilities (ties by txn_id) -- TakeOrderedAndProject."""
    return d.orderBy(F.col("fraud_probability").desc(), "txn_id").limit(n)


def leading_features(importance: DataFrame, d: DataFrame, k: int = 5) -> list[str]:
    """The k most important features of an importance table (feature, importance) that d has: k names for the driver."""
    known = importance.where(F.col("feature").isin(d.columns))
    return [r["feature"] for r in known.orderBy(F.col("importance").desc(), "feature").limit(k).collect()]


def _medians(d: DataFrame, names: list[str]) -> DataFrame:
    return quantile_rows(d, names, [0.5]).select(F.col("column").alias("feature"), F.col("value").alias("population_median"))


def explain_examples(d: DataFrame, importance: DataFrame, n: int = 10, k: int = 5) -> DataFrame:
    """The top-n rows with each of the k leading features against the population median.

    The features come from the importance table of a fitted model, at run time."""
    names = leading_features(importance, d, k)
    ex = top_scored(d, n).select(
        "txn_id", "step", "txn_type", dbl("amount").alias("amount"), "fraud_probability", "risk_band",
        F.col("is_fraud").alias("actual_label"), F.explode(F.array(*[
            F.struct(F.lit(i + 1).alias("feature_rank"), F.lit(c).alias("feature"), dbl(c).alias("value"))
            for i, c in enumerate(names)])).alias("s")).select("*", "s.*").drop("s").where(F.col("value").isNotNull())
    j = ex.join(F.broadcast(_medians(d, names)), "feature")  # k rows
    pos = F.when(F.col("value") > F.col("population_median"), "above") \
           .when(F.col("value") < F.col("population_median"), "below").otherwise("at")
    return j.select("txn_id", "step", "txn_type", "amount", "fraud_probability", "risk_band", "actual_label", "feature_rank",
                    "feature", "value", F.round("population_median", 9).alias("population_median"),
                    pos.alias("relative_position"))


def values_above_median(d: DataFrame, importance: DataFrame, k: int = 5) -> DataFrame:
    """Every row's k leading features against the population medians (k rows, broadcast); NULL values give no row."""
    names = leading_features(importance, d, k)
    long = d.select("txn_id", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), dbl(c).alias("value")) for c in names]))
                    .alias("s")).select("txn_id", "s.*").where(F.col("value").isNotNull())
    return long.join(F.broadcast(_medians(d, names)), "feature").select(
        "txn_id", "feature", F.when(F.col("value") > F.col("population_median"), 1).otherwise(0).alias("above_median"))


TYPE_LIST = list(TXN_TYPES)
