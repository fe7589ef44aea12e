"""Cost model (C1-C8): threshold grid, sweep, optimum, bands, sensitivity.

The sweep never loops over thresholds on the data.  Scores are bucketed once
against the sorted grid (<= 99 + 80 edges, collected as control values), the
per-bucket label counts (<= 180 rows) are reverse-cumulated, and every cost
scenario is a projection over that small table.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig
from riskframe.functions.derive import dbl, with_score
from riskframe.functions.radix import quantile_rows


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced levels computed as i * step + start with the last one pinned to stop."""
    if num == 1:
        return [start]
    step = (stop - start) / (num - 1)
    out = [i * step + start for i in range(num)]
    out[-1] = stop
    return out


def quantile_levels(cfg: RiskConfig = DEFAULT) -> list[float]:
    return linspace(cfg.quantile_min, cfg.quantile_max, cfg.quantile_points)


def threshold_grid(scored: DataFrame, score: str = "score", cfg: RiskConfig = DEFAULT,
                   use_quantiles: bool = True, extra: list[float] | None = None) -> DataFrame:
    """Fixed grid UNION quantile thresholds (rounded to 9 dp, clipped to [1e-6, 0.999999],
    dropped when they round (4 dp) onto a fixed value), tagged by `grid_source`."""
    spark = scored.sparkSession
    fixed = spark.createDataFrame([(t, "fixed") for t in cfg.fixed_thresholds()], "threshold double, grid_source string")
    grid = fixed
    if use_quantiles:
        qv = quantile_rows(scored, [score], quantile_levels(cfg))
        qt = qv.select(F.greatest(F.least(F.round("value", 9), F.lit(0.999999)), F.lit(1e-6)).alias("threshold")).distinct()
        qt = qt.join(F.broadcast(fixed.select(F.col("threshold").alias("f"))), F.round("threshold", 4) == F.col("f"),
                     "left_anti").withColumn("grid_source", F.lit("quantile"))
        grid = grid.unionByName(qt)
    if extra:
        ex = spark.createDataFrame([(float(t), "chosen") for t in extra], "threshold double, grid_source string")
        grid = grid.unionByName(ex.join(grid.select("threshold"), "threshold", "left_anti"))
    return grid


def sweep_counts(scored: DataFrame, grid: DataFrame, score: str = "score", label: str = "is_fraud",
                 group_cols: list[str] | tuple = ()) -> DataFrame:
    """Confusion counts at every grid threshold (flag = score >= t), via one bucketing pass."""
    g = list(group_cols)
    rows = grid.orderBy("threshold").collect()  # <= ~180 control values
    # re-create the grid from the collected rows so its plan (quantiles) is not executed twice
    grid = scored.sparkSession.createDataFrame([(r["threshold"], r["grid_source"]) for r in rows],
                                               "threshold double, grid_source string")
    ts = [r["threshold"] for r in rows]
    src = sorted({t for t in ts if t is not None and not math.isnan(t)})
    splits = [-math.inf] + src + [math.inf]
    b = Bucketizer(splits=splits, inputCol="__s", outputCol="__b", handleInvalid="keep")
    hist = b.transform(with_score(scored, score).select(*g, dbl(score).alias("__s"), F.col(label).alias("__y"))) \
        .groupBy(*g, F.col("__b").cast("int").alias("__b")) \
        .agg(F.sum("__y").cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))
    spark: SparkSession = scored.sparkSession
    idx = spark.createDataFrame([(i + 1, t) for i, t in enumerate(src)], "__b int, threshold double")
    # rows with score >= src[i] are exactly buckets >= i + 1; tiny table -> reverse running sums
    keys = (hist.select(*g).distinct().crossJoin(idx)) if g else idx
    full = keys.join(hist, g + ["__b"], "full_outer").fillna(0, ["pos", "n"])
    w_rev = Window.partitionBy(*g).orderBy(F.col("__b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(*g)
    c = full.select(*g, "__b", "threshold", F.sum("pos").over(w_rev).alias("TP"),
                    (F.sum("n").over(w_rev) - F.sum("pos").over(w_rev)).alias("FP"),
                    F.sum("pos").over(tot).alias("P"), F.sum("n").over(tot).alias("N_ALL"))
    c = c.where(F.col("threshold").isNotNull())
    return c.join(grid, "threshold").select(
        *g, "threshold", "grid_source", F.col("TP").cast("long").alias("TP"),
        (F.col("N_ALL") - F.col("P") - F.col("FP")).cast("long").alias("TN"), F.col("FP").cast("long").alias("FP"),
        (F.col("P") - F.col("TP")).cast("long").alias("FN"), F.col("N_ALL").cast("long").alias("n_rows"))


def with_sweep_metrics(c: DataFrame, cost_fn: float, cost_fp: float) -> DataFrame:
    """Guarded ratios and the three cost columns (C2 output columns)."""
    def safe(num, den):
        return F.when(dbl(den) > 0, dbl(num) / dbl(den)).otherwise(F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("TP", "FP", "FN", "TN"))
    prec, rec = safe(tp, tp + fp), safe(tp, tp + fn)
    cm = dbl(fn) * F.lit(float(cost_fn))
    cf = dbl(fp) * F.lit(float(cost_fp))
    return c.select(
        *[x for x in c.columns if x != "n_rows"], prec.alias("precision"), rec.alias("recall"),
        rec.alias("fraud_capture_rate"), safe(fp, fp + tn).alias("false_positive_rate"),
        F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
        fp.alias("legitimate_transactions_blocked"), fn.alias("fraud_missed"), (tp + fp).alias("alert_volume"),
        (dbl(tp + fp) / dbl("n_rows")).alias("alert_rate"), cm.alias("cost_missed_fraud"),
        cf.alias("cost_customer_friction"), (cm + cf).alias("total_cost"))


def threshold_sweep(scored: DataFrame, score: str = "score", label: str = "is_fraud", cost_fn: float | None = None,
                    cost_fp: float | None = None, use_quantile_grid: bool = True, cfg: RiskConfig = DEFAULT,
                    extra_thresholds: list[float] | None = None) -> DataFrame:
    """Confusion and cost at every threshold of the grid."""
    cost_fn = cfg.cost_fn if cost_fn is None else cost_fn
    cost_fp = cfg.cost_fp if cost_fp is None else cost_fp
    scored = _narrow_scores(scored, score, label)
    grid = threshold_grid(scored, score, cfg, use_quantile_grid, extra_thresholds)
    return with_sweep_metrics(sweep_counts(scored, grid, score, label), cost_fn, cost_fp)


def _narrow_scores(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(score, label) only, persisted: the grid quantiles and the histogram both read it."""
    from riskframe.session import cached
    return cached(with_score(scored, score).select(F.col(score), F.col(label)))


_SUMMARY_COLS = ["TP", "FP", "FN", "TN", "precision", "recall", "fraud_capture_rate", "false_positive_rate",
                 "legitimate_transactions_blocked", "alert_volume", "alert_rate"]


def _summary(best: DataFrame, sweep: DataFrame, cost_fn: float, cost_fp: float) -> DataFrame:
    at50 = sweep.orderBy(F.abs(F.col("threshold") - F.lit(0.5)), "threshold").limit(1) \
                .select(F.col("total_cost").alias("cost_at_threshold_0_50"))
    red = F.col("cost_at_threshold_0_50") - F.col("total_cost")
    return best.crossJoin(at50).select(
        F.col("threshold").alias("optimal_threshold"), F.col("total_cost").alias("total_cost_at_optimum"),
        "cost_missed_fraud", "cost_customer_friction", *_SUMMARY_COLS, "cost_at_threshold_0_50",
        red.alias("cost_reduction_vs_0_50"),
        F.when(F.col("cost_at_threshold_0_50") != 0, F.lit(100.0) * red / F.col("cost_at_threshold_0_50"))
        .otherwise(F.lit(0.0)).alias("cost_reduction_vs_0_50_pct"),
        (dbl(F.col("TP") + F.col("FN")) * F.lit(float(cost_fn))).alias("cost_if_no_intervention"),
        (dbl(F.col("TN") + F.col("FP")) * F.lit(float(cost_fp))).alias("cost_if_block_everything"))


def optimal_threshold(sweep: DataFrame, cfg: RiskConfig = DEFAULT, cost_fn: float | None = None,
                      cost_fp: float | None = None) -> DataFrame:
    """Minimum total cost (ties -> lowest threshold) against the 0.50 row and the two extremes."""
    cost_fn = cfg.cost_fn if cost_fn is None else cost_fn
    cost_fp = cfg.cost_fp if cost_fp is None else cost_fp
    best = sweep.orderBy("total_cost", "threshold").limit(1)
    return _summary(best, sweep, cost_fn, cost_fp)


def summarise_at(sweep: DataFrame, threshold, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """C4: the sweep row nearest to `threshold` (a float or a 1-row DataFrame column `threshold`)."""
    if isinstance(threshold, DataFrame):
        t = threshold.select(F.col("threshold").alias("__t"))
        best = sweep.crossJoin(F.broadcast(t)).orderBy(F.abs(F.col("threshold") - F.col("__t")), "threshold") \
                    .limit(1).drop("__t")
    else:
        best = sweep.orderBy(F.abs(F.col("threshold") - F.lit(float(threshold))), "threshold").limit(1)
    return _summary(best, sweep, cfg.cost_fn, cfg.cost_fp)


def risk_band_thresholds(scored: DataFrame, score: str = "score", label: str = "is_fraud",
                         cfg: RiskConfig = DEFAULT) -> DataFrame:
    """C5 core: one sweep, two cost columns (block / verify), two argmins; verify <= block."""
    scored = _narrow_scores(scored, score, label)
    c = sweep_counts(scored, threshold_grid(scored, score, cfg), score, label)
    fn = F.lit(cfg.cost_fn)
    c = c.select("threshold", (dbl("FN") * fn + dbl("FP") * F.lit(cfg.cost_fp)).alias("block_cost"),
                 (dbl("FN") * fn + dbl("FP") * F.lit(cfg.cost_verify)).alias("verify_cost"))
    b = c.agg(F.min_by("threshold", F.struct("block_cost", "threshold")).alias("high_risk_threshold_block"),
              F.min_by("threshold", F.struct("verify_cost", "threshold")).alias("_verify"))
    return b.select("high_risk_threshold_block",
                    F.least("_verify", "high_risk_threshold_block").alias("medium_risk_threshold_verify"))


# fixed values: band actions
BAND_ACTIONS = [("LOW", "allow without friction"), ("MEDIUM", "step-up verification / manual review"),
                ("HIGH", "block / hard decline")]


def band_rationale(cfg: RiskConfig = DEFAULT) -> dict[str, str]:
    """Why each band gets its action, from the costs it was derived with."""
    return {"LOW": f"expected loss stays below the {cfg.cost_verify:.0f} that even a verification costs",
            "MEDIUM": f"expected loss is worth a verification at {cfg.cost_verify:.0f}, not a wrong block at {cfg.cost_fp:.0f}",
            "HIGH": f"expected loss is above the {cfg.cost_fp:.0f} that a wrong block costs"}


def risk_bands(scored: DataFrame, score: str = "score", label: str = "is_fraud", cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Three bands with numeric bounds [lower, upper), actions and rationale (D17: bounds, not 2-dp text)."""
    t = risk_band_thresholds(scored, score, label, cfg)
    spark = scored.sparkSession
    why = band_rationale(cfg)
    acts = spark.createDataFrame([(i, b, a, why[b]) for i, (b, a) in enumerate(BAND_ACTIONS)],
                                 "band_order int, band string, action string, rationale string")
    v, h = F.col("medium_risk_threshold_verify"), F.col("high_risk_threshold_block")
    j = acts.crossJoin(t)
    lower = F.when(F.col("band") == "LOW", F.lit(0.0)).when(F.col("band") == "MEDIUM", v).otherwise(h)
    upper = F.when(F.col("band") == "LOW", v).when(F.col("band") == "MEDIUM", h).otherwise(F.lit(None).cast("double"))
    return j.select("band_order", "band", lower.alias("lower_bound"), upper.alias("upper_bound"), "action", "rationale",
                    "medium_risk_threshold_verify", "high_risk_threshold_block")


def sensitivity_grid(scored: DataFrame, score: str = "score", label: str = "is_fraud", cfg: RiskConfig = DEFAULT,
                     fn_costs: tuple[float, ...] | None = None, fp_costs: tuple[float, ...] | None = None) -> DataFrame:
    """Unit-cost sweep x 25 scenarios (broadcast cross join of a 25-row table), argmin per scenario."""
    fn_costs = fn_costs or cfg.sensitivity_fn_costs
    fp_costs = fp_costs or cfg.sensitivity_fp_costs
    spark = scored.sparkSession
    sc = spark.createDataFrame([(float(a), float(b)) for a in fn_costs for b in fp_costs],
                               "cost_false_negative double, cost_false_positive double")
    scored = _narrow_scores(scored, score, label)
    base = with_sweep_metrics(sweep_counts(scored, threshold_grid(scored, score, cfg), score, label), 1.0, 1.0)
    x = base.crossJoin(F.broadcast(sc)).withColumn(
        "scenario_cost", dbl("FN") * F.col("cost_false_negative") + dbl("FP") * F.col("cost_false_positive"))
    w = Window.partitionBy("cost_false_negative", "cost_false_positive").orderBy("scenario_cost", "threshold")
    best = x.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return best.select(
        "cost_false_negative", "cost_false_positive",
        (F.col("cost_false_negative") / F.col("cost_false_positive")).alias("cost_ratio_fn_over_fp"),
        F.col("threshold").alias("optimal_threshold"), F.col("scenario_cost").alias("total_cost"),
        "TP", "FP", "FN", "TN", "fraud_capture_rate", "precision", "false_positive_rate",
        "legitimate_transactions_blocked", "fraud_missed", "alert_rate")


def threshold_matrix(grid: DataFrame, value: str = "optimal_threshold", cfg: RiskConfig = DEFAULT) -> DataFrame:
    """FN cost rows x FP cost columns (fixed column list, so the schema never depends on data)."""
    fps = [float(x) for x in cfg.sensitivity_fp_costs]
    p = grid.groupBy("cost_false_negative").pivot("cost_false_positive", fps).agg(F.first(value))
    return p.select("cost_false_negative", *[F.col(f"`{c}`").alias(f"fp_{int(c)}") for c in fps])


def sensitivity_summary(grid: DataFrame) -> DataFrame:
    """Threshold range/spread/median, capture and blocked ranges, direction as FN/FP ratio rises."""
    by_ratio = grid.groupBy("cost_ratio_fn_over_fp").agg(F.avg("optimal_threshold").alias("m"))
    d = by_ratio.agg(F.min_by("m", "cost_ratio_fn_over_fp").alias("m_lo"), F.max_by("m", "cost_ratio_fn_over_fp").alias("m_hi"))
    a = grid.agg(F.count(F.lit(1)).alias("scenarios_tested"), F.min("optimal_threshold").alias("threshold_min"),
                 F.max("optimal_threshold").alias("threshold_max"),
                 F.median("optimal_threshold").alias("threshold_median"),
                 F.min("fraud_capture_rate").alias("fraud_capture_rate_min"),
                 F.max("fraud_capture_rate").alias("fraud_capture_rate_max"),
                 F.min("legitimate_transactions_blocked").alias("legitimate_blocked_min"),
                 F.max("legitimate_transactions_blocked").alias("legitimate_blocked_max"))
    return a.crossJoin(d).select(
        "scenarios_tested", "threshold_min", "threshold_max",
        (F.col("threshold_max") - F.col("threshold_min")).alias("threshold_spread"), "threshold_median",
        "fraud_capture_rate_min", "fraud_capture_rate_max", "legitimate_blocked_min", "legitimate_blocked_max",
        F.when(F.col("m_hi") < F.col("m_lo"), "falls").otherwise("rises").alias("direction_with_rising_fn_fp_ratio"))
