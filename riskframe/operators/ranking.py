"""Threshold-free ranking metrics and review-capacity views.

All of them need a global order by score.  They go through
`functions.ordered.cumulative`, which collapses ties first and never runs a
window without a partition key over the full data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig
from riskframe.functions.derive import count_if, dbl, with_score
from riskframe.functions.ordered import cumulative


def _desc_cum(scored: DataFrame, score: str, label: str, group_cols: list[str], cfg: RiskConfig) -> DataFrame:
    """Distinct scores, highest first: pos/n per score and inclusive running pos/n from the top."""
    src = with_score(scored, score).select(*group_cols, (-F.col(score).cast("double")).alias("__neg"), F.col(label).alias("__y"))
    return cumulative(src, "__neg", {"pos": F.col("__y").cast("long"), "n": F.lit(1).cast("long")},
                      group_cols, cfg)


def ranking_metrics(scored: DataFrame, score: str = "score", label: str = "is_fraud",
                    group_cols: list[str] | tuple = (), cfg: RiskConfig = DEFAULT) -> DataFrame:
    """M6 average precision (sum of dRecall * Precision over distinct scores) and
    M7 ROC-AUC (Mann-Whitney, ties count one half); NULL when a group has one class only, no row for no rows.

    Rows without a score (NULL or NaN) take no part."""
    g = list(group_cols)
    c = _desc_cum(scored, score, label, g, cfg)
    P, N = dbl("tot_pos"), dbl("tot_n") - dbl("tot_pos")
    neg = dbl("n") - dbl("pos")
    cum_neg = dbl("cum_n") - dbl("cum_pos")
    ap_term = dbl("pos") / F.when(P > 0, P) * (dbl("cum_pos") / dbl("cum_n"))
    auc_term = dbl("pos") * ((N - cum_neg) + F.lit(0.5) * neg)
    agg = c.groupBy(*g).agg(F.sum(ap_term).alias("ap"), F.sum(auc_term).alias("auc_num"),
                            F.first("tot_pos").alias("P"), F.first("tot_n").alias("n"))
    valid = (F.col("P") > 0) & (F.col("P") < F.col("n"))
    prevalence = dbl("P") / dbl("n")
    return agg.select(
        *g,
        F.when(valid, F.round(F.col("auc_num") / (dbl("P") * (dbl("n") - dbl("P"))), 9)).alias("roc_auc"),
        F.when(valid, F.round("ap", 9)).alias("pr_auc"),
        prevalence.alias("pr_auc_no_skill_baseline"),
        F.when(valid, F.round(F.col("ap") / prevalence, 9)).alias("pr_auc_lift_over_no_skill"),
    )


def binary_metrics(scored: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "is_fraud",
                   group_cols: list[str] | tuple = (), flag: str | None = None) -> DataFrame:
    """M8: confusion counts and guarded ratios (0.0 for zero denominators) at score >= threshold."""
    g = list(group_cols)
    pred = (F.col(flag) == 1) if flag else (F.col(score) >= F.lit(float(threshold)))
    y = F.col(label) == 1
    rows = scored if flag else with_score(scored, score)
    c = rows.groupBy(*g).agg(count_if(pred & y).alias("TP"), count_if(pred & ~y).alias("FP"),
                               count_if(~pred & y).alias("FN"), count_if(~pred & ~y).alias("TN"))
    return with_confusion_ratios(c)


def with_confusion_ratios(c: DataFrame) -> DataFrame:
    def safe(num, den):
        return F.when(dbl(den) > 0, dbl(num) / dbl(den)).otherwise(F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("TP", "FP", "FN", "TN"))
    total = tp + fp + fn + tn
    prec, rec = safe(tp, tp + fp), safe(tp, tp + fn)
    return c.select(
        "*",
        safe(tp + tn, total).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        rec.alias("fraud_capture_rate"),
        F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
        safe(fp, fp + tn).alias("false_positive_rate"),
        (tp + fp).alias("alert_volume"), safe(tp + fp, total).alias("alert_rate"),
    )


def evaluate(scored: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "is_fraud",
             group_cols: list[str] | tuple = (), cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Ranking metrics plus the confusion at one threshold (one row per group)."""
    g = list(group_cols)
    r = ranking_metrics(scored, score, label, g, cfg)
    b = binary_metrics(scored, threshold, score, label, g).withColumn("threshold", F.lit(float(threshold)))
    return r.crossJoin(b) if not g else r.join(b, g)


def compare_models(long_scores: DataFrame, model_col: str = "model", score: str = "score",
                   label: str = "is_fraud", cfg: RiskConfig = DEFAULT) -> DataFrame:
    """M9: one row per model, ranked by PR-AUC (NULL last); rank 1 is the selected model."""
    r = ranking_metrics(long_scores, score, label, [model_col], cfg)
    b = binary_metrics(long_scores, 0.5, score, label, [model_col])
    b = b.select(model_col, *[F.col(c).alias(f"at_0_5_{c}") for c in b.columns if c != model_col])
    out = r.join(b, model_col)
    w = Window.orderBy(F.col("pr_auc").desc_nulls_last(), F.col(model_col))  # one row per model
    return out.withColumn("selection_rank", F.row_number().over(w).cast("bigint"))


def top_k_capture(scored: DataFrame, score: str = "score", label: str = "is_fraud",
                  fractions: tuple[float, ...] | None = None, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Fraud captured when only the top fraction f of rows (score desc, txn_id asc) is reviewed;
    reviewed = max(int(f * n), 1)."""
    spark = scored.sparkSession
    fractions = fractions or cfg.review_fractions
    c = _desc_cum(scored, score, label, [], cfg)
    fr = spark.createDataFrame([(float(f),) for f in fractions], "review_fraction double")
    tot = c.agg(F.first("tot_n").alias("n_rows"), F.first("tot_pos").alias("P"))
    fr = fr.crossJoin(tot).withColumn(
        "reviewed", F.greatest(F.floor(F.col("review_fraction") * dbl("n_rows")).cast("long"), F.lit(1)))
    # the distinct score whose tie group contains the cut
    bnd = c.join(F.broadcast(fr), (F.col("cum_n") - F.col("n") < F.col("reviewed")) & (F.col("reviewed") <= F.col("cum_n"))) \
           .select("review_fraction", "reviewed", "n_rows", "P", F.col("__neg").alias("b_neg"),
                   (F.col("cum_pos") - F.col("pos")).alias("pos_before"),
                   (F.col("reviewed") - (F.col("cum_n") - F.col("n"))).alias("m"))
    ties = with_score(scored, score).select("txn_id", (-F.col(score).cast("double")).alias("b_neg"), F.col(label).alias("__y")) \
                 .join(F.broadcast(bnd.select("review_fraction", "b_neg", "m")), "b_neg")
    tc = cumulative(ties, "txn_id", {"tp": F.col("__y").cast("long"), "k": F.lit(1).cast("long")},
                    ["review_fraction"], cfg)
    tie_pos = tc.join(F.broadcast(bnd.select("review_fraction", "m")), "review_fraction") \
                .where(F.col("cum_k") == F.col("m")).select("review_fraction", F.col("cum_tp").alias("tie_pos"))
    out = bnd.join(tie_pos, "review_fraction")
    captured = F.col("pos_before") + F.col("tie_pos")
    return out.select(
        "review_fraction", F.col("reviewed").alias("transactions_reviewed"), captured.alias("fraud_captured"),
        (dbl(captured) / dbl(F.greatest(F.col("P"), F.lit(1)))).alias("fraud_capture_rate"),
        (dbl(captured) / dbl("reviewed")).alias("precision_in_queue"),
    )


def _thinned(points: DataFrame, index: str, size: DataFrame, max_points: int) -> DataFrame:
    """Rows of a curve at evenly spaced indices (all of them if there are max_points at most)."""
    j = F.explode(F.sequence(F.lit(0), F.least(F.col("size"), F.lit(max_points)).cast("int") - 1))
    at = F.when(F.col("size") <= max_points, F.col("j").cast("long")).otherwise(
        F.floor(dbl("j") * ((dbl("size") - 1) / F.lit(float(max_points - 1)))).cast("long"))
    wanted = size.select("size", j.alias("j")).select(at.alias(index)).distinct()
    return points.join(F.broadcast(wanted), index)  # max_points rows at most


def curve_points(scored: DataFrame, score: str = "score", label: str = "is_fraud", max_points: int = 500,
                 cfg: RiskConfig = DEFAULT) -> DataFrame:
    """(curve, point_index, threshold, x, y), each curve thinned on its own to max_points.

    `roc`: x = false, y = true positive rate from the top score down, starting
    at (0, 0) without a threshold; points on a straight line between their
    neighbours are left out.  `pr`: x = recall, y = precision from the lowest
    score up, ending at (0, 1) without a threshold.  Rates with an empty class
    are NULL.
    """
    c = _desc_cum(scored, score, label, [], cfg).withColumn("neg", F.col("n") - F.col("pos"))
    here = F.struct("pos", "neg")
    # the next distinct score: in the same bucket, or the first of the next one (one row per bucket)
    firsts = c.groupBy("__bk").agg(F.min_by(here, "__neg").alias("f"), F.count("*").alias("rows"))
    after = firsts.select(F.col("__bk").alias("of"), F.lead("f").over(Window.orderBy("__bk")).alias("after"))
    in_bucket = Window.partitionBy("__bk").orderBy("__neg")
    c = c.join(after, F.col("__bk") == F.col("of")).withColumn("next", F.coalesce(F.lead(here).over(in_bucket), F.col("after")))
    c = c.withColumn("kept", ((F.col("cum_d") == 1) | F.col("next").isNull() | (F.col("next") != here)).cast("long"))
    kept = c.groupBy("__bk").agg(F.sum("kept").alias("k"))
    base = kept.select(F.col("__bk").alias("kb"), F.coalesce(
        F.sum("k").over(Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    c = c.join(base, F.col("__bk") == F.col("kb")).withColumn(
        "i", F.col("base") + F.sum("kept").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    P, N = dbl("tot_pos"), dbl("tot_n") - dbl("tot_pos")
    fpr = F.when(N > 0, (dbl("cum_n") - dbl("cum_pos")) / F.when(N > 0, N))
    tpr = F.when(P > 0, dbl("cum_pos") / F.when(P > 0, P))
    threshold = -F.col("__neg")
    ends = c.agg(F.sum("kept").alias("k"), F.max("tot_d").alias("d")).where("d is not null")
    null, zero, one = F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0)
    roc = c.where("kept = 1").select("i", threshold.alias("threshold"), fpr.alias("x"), tpr.alias("y")).unionAll(
        ends.select(F.lit(0).cast("long"), null, zero, zero))
    pr = c.select((F.col("tot_d") - F.col("cum_d")).alias("i"), threshold.alias("threshold"), tpr.alias("x"),
                  (dbl("cum_pos") / dbl("cum_n")).alias("y")).unionAll(ends.select("d", null, zero, one))
    roc = _thinned(roc, "i", ends.select((F.col("k") + 1).alias("size")), max_points)
    pr = _thinned(pr, "i", ends.select((F.col("d") + 1).alias("size")), max_points)
    return roc.select(F.lit("roc").alias("curve"), F.col("i").alias("point_index"), "threshold", "x", "y").unionAll(
        pr.select(F.lit("pr").alias("curve"), F.col("i").alias("point_index"), "threshold", "x", "y"))
