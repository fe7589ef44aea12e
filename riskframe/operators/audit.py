"""Stage-1 audit (A1-A22): one-pass aggregations over the canonical table.

Each section is a small DataFrame; counts are `count_if` columns of a single
aggregate so one scan answers a whole section.  Percentages are DOUBLE
`100 * a / b`; exact quantiles come from `functions.ordered`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig
from riskframe.functions.derive import balance_residuals, class_label, count_if, dbl, pct, risk_type
from riskframe.functions.ordered import exact_quantiles
from riskframe.functions.radix import quantile_rows
from riskframe.operators import ranking
from riskframe.session import small_table

CANONICAL = ["txn_id", "step", "txn_type", "amount", "name_orig", "name_dest", "old_balance_orig",
             "new_balance_orig", "old_balance_dest", "new_balance_dest", "is_fraud", "is_flagged_fraud"]
DUPLICATE_KEY = ["step", "txn_type", "amount", "name_orig", "name_dest", "old_balance_orig",
                 "new_balance_orig", "old_balance_dest", "new_balance_dest", "is_fraud"]


def _n():
    return F.count(F.lit(1))


def duplicate_rows(txns: DataFrame, key: list[str] | None = None) -> DataFrame:
    """A2: exact-duplicate groups over the business columns and surplus rows (reported, not deleted).

    A 16-byte hash of the key is grouped first; only rows whose hash occurs
    twice are grouped by the key itself, so the key columns of unique rows are
    not shuffled (while the repeated hashes are few enough to broadcast)."""
    key = key or [c for c in DUPLICATE_KEY if c in txns.columns]
    rows = txns.select(*key, F.xxhash64(*key).alias("_h1"), F.xxhash64(F.lit(1), *key).alias("_h2"))
    twice, _ = small_table(rows.groupBy("_h1", "_h2").agg(_n().alias("n")).where(F.col("n") > 1).select("_h1", "_h2"))
    met = rows.join(twice, ["_h1", "_h2"], "left_semi")
    g = met.groupBy(*key).agg(_n().alias("occurrences")).where(F.col("occurrences") > 1)
    return g.agg(_n().alias("duplicate_groups"),
                 F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"))


def quality_counts(txns: DataFrame) -> DataFrame:
    """A1: rows, NULLs per column, zero/negative amounts, steps below 1, duplicates, issue list."""
    cols = [c for c in CANONICAL if c in txns.columns]
    a = txns.agg(_n().alias("total_rows"),
                 *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
                 count_if(F.col("amount") == 0).alias("zero_amount"),
                 count_if(F.col("amount") < 0).alias("negative_amount"),
                 count_if(F.col("step") < 1).alias("steps_below_1"))
    d = duplicate_rows(txns)
    out = a.crossJoin(d)
    total_missing = sum((F.col(f"null_{c}") for c in cols), F.lit(0).cast("bigint"))
    counted = lambda c, text: F.when(F.col(c) > 0, F.concat(F.format_number(c, 0), F.lit(f" {text}")))
    # fixed values: issue wording
    issues = F.concat_ws("; ",
                         F.when(F.col("negative_amount") > 0, F.lit("negative transaction amounts present")),
                         counted("zero_amount", "transactions with amount = 0"),
                         F.when(F.col("steps_below_1") > 0, F.lit("step values below 1")),
                         counted("surplus_rows", "exactly duplicated rows (may be genuine repeats)"))
    return out.select("*", total_missing.alias("total_missing_values"),
                      pct("surplus_rows", "total_rows").alias("duplicate_row_pct"),
                      F.when(issues == "", F.lit("no obvious structural problems detected")).otherwise(issues)
                      .alias("data_quality_issues"))


def class_balance(txns: DataFrame) -> DataFrame:
    """A3."""
    a = txns.agg(_n().alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"))
    legit = F.col("transactions") - F.col("fraud")
    return a.select("transactions", "fraud", legit.alias("legitimate"),
                    pct("fraud", "transactions").alias("fraud_rate_pct"),
                    (dbl(legit) / F.when(F.col("fraud") > 0, dbl("fraud"))).alias("legit_per_fraud"),
                    pct(legit, "transactions").alias("always_legit_accuracy_pct"))


def profile_by_type(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """A4: per type volume, fraud, shares, total/mean/median amount (window over the <=5-row aggregate)."""
    g = txns.groupBy("txn_type").agg(_n().alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"),
                                     F.sum("amount").alias("_sum"))
    med = quantile_rows(txns, ["amount"], [0.5], "txn_type").select("txn_type", F.round("value", 9)
                                                                            .alias("median_amount"))
    all_ = Window.partitionBy()  # the aggregate has one row per type
    out = g.join(med, "txn_type").select(
        "txn_type", "transactions", pct("transactions", F.sum("transactions").over(all_)).alias("pct_of_volume"),
        "fraud", pct("fraud", "transactions").alias("fraud_rate_pct"),
        pct("fraud", F.sum("fraud").over(all_)).alias("share_of_all_fraud_pct"),
        dbl("_sum").alias("total_amount"), (dbl("_sum") / dbl("transactions")).alias("mean_amount"),
        "median_amount", F.when(F.col("fraud") > 0, 1).otherwise(0).alias("has_fraud"))
    return out


def amount_stats(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """A5: all / fraudulent / legitimate amount statistics (sample std, linear quantiles)."""
    rows = txns.select(F.explode(F.array(F.lit("all"), class_label())).alias("class"), "amount")
    g = rows.groupBy("class").agg(_n().alias("count"), F.sum("amount").alias("_sum"),
                                  F.stddev_samp(dbl("amount")).alias("_std"),
                                  F.min("amount").alias("_min"), F.max("amount").alias("_max"))
    qs = {0.25: "q1", 0.5: "median", 0.75: "q3", 0.9: "p90", 0.99: "p99"}
    q = quantile_rows(rows, ["amount"], list(qs), "class") \
        .groupBy("class").pivot("q", list(qs)).agg(F.first("value"))
    q = q.select("class", *[F.round(F.col(f"`{k}`"), 9).alias(v) for k, v in qs.items()])
    fv = txns.agg(F.sum("amount").alias("_tv"), F.sum(F.when(F.col("is_fraud") == 1, F.col("amount"))).alias("_fv"))
    return g.join(q, "class").crossJoin(fv).select(
        "class", "count", dbl("_sum").alias("sum"), (dbl("_sum") / dbl("count")).alias("mean"), "median",
        F.round("_std", 9).alias("std"), dbl("_min").alias("min"), "q1", "q3", "p90", "p99", dbl("_max").alias("max"),
        F.coalesce(pct("_fv", "_tv"), F.lit(0.0)).alias("fraud_value_share_pct"))


def step_profile(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Step range, gaps, per-step and per-day volume (two-level aggregation)."""
    per_step = txns.groupBy("step").agg(_n().alias("n"))
    s = per_step.agg(F.min("step").alias("step_min"), F.max("step").alias("step_max"),
                     _n().alias("unique_steps"), F.sum("n").alias("_rows"),
                     F.min("n").alias("transactions_per_step_min"), F.max("n").alias("transactions_per_step_max"))
    day = (F.floor((F.col("step") - 1) / cfg.steps_per_day) + 1).cast("int")
    d = txns.groupBy(day.alias("sim_day")).agg(_n().alias("n")) \
        .agg(F.min("n").alias("daily_volume_min"), F.max("n").alias("daily_volume_max"))
    span = F.col("step_max") - F.col("step_min") + 1
    return s.crossJoin(d).select(
        "step_min", "step_max", "unique_steps", (span - F.col("unique_steps")).alias("missing_steps_in_range"),
        span.alias("implied_steps"), (dbl(span) / F.lit(float(cfg.steps_per_day))).alias("implied_days"),
        (dbl("_rows") / dbl("unique_steps")).alias("transactions_per_step_mean"),
        "transactions_per_step_min", "transactions_per_step_max", "daily_volume_min", "daily_volume_max")


def calendar_gap_fill(txns: DataFrame) -> DataFrame:
    """Per-step volume over the full [min, max] step range, missing steps as 0
    (calendar generated by `sequence` from the two bounds, then a left join)."""
    per_step = txns.groupBy("step").agg(_n().alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"))
    cal = per_step.agg(F.explode(F.sequence(F.min("step"), F.max("step"))).alias("step"))
    return cal.join(per_step, "step", "left").select(
        "step", F.coalesce("transactions", F.lit(0)).cast("bigint").alias("transactions"),
        F.coalesce("fraud", F.lit(0)).cast("bigint").alias("fraud"))


def hour_calendar(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Volume and fraud rate for every hour of the cycle, hours without a row as 0 (rate NULL)."""
    cal = txns.sparkSession.range(cfg.steps_per_day).select(F.col("id").cast("int").alias("hour_of_day"))
    h = cal.join(hourly_profile(txns, cfg).drop("fraud_rate_pct"), "hour_of_day", "left").fillna(0, ["transactions", "fraud"])
    return h.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def hourly_profile(txns: DataFrame, cfg: RiskConfig = DEFAULT, where=None) -> DataFrame:
    """A7 (and B5 with `where`)."""
    t = txns if where is None else txns.where(where)
    hour = ((F.col("step") - 1) % cfg.steps_per_day).cast("int")
    g = t.groupBy(hour.alias("hour_of_day")).agg(_n().alias("transactions"),
                                                 F.sum("is_fraud").cast("bigint").alias("fraud"))
    return g.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def daily_profile(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """A8."""
    day = (F.floor((F.col("step") - 1) / cfg.steps_per_day) + 1).cast("int")
    return txns.groupBy(day.alias("sim_day")).agg(_n().alias("transactions"),
                                                  F.sum("is_fraud").cast("bigint").alias("fraud"))


def low_volume_hours(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Hours with volume < 25 % of the median hour; fraud rate there vs elsewhere (<= 24-row table)."""
    h = hourly_profile(txns, cfg)
    med = exact_quantiles(h, "transactions", [0.5], [], cfg).select(F.col("value").alias("median_hour"))
    h = h.crossJoin(med).withColumn("low", dbl("transactions") < F.col("median_hour") * F.lit(0.25))
    return h.agg(
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("low"), F.col("hour_of_day"))))
                    .cast("array<string>")).alias("low_volume_hours"),
        count_if(F.col("low")).alias("n_low_volume_hours"),
        (F.lit(100.0) * dbl(F.sum(F.when(F.col("low"), F.col("fraud")).otherwise(0)))
         / dbl(F.greatest(F.sum(F.when(F.col("low"), F.col("transactions")).otherwise(0)), F.lit(1))))
        .alias("fraud_rate_low_volume_hours_pct"),
        (F.lit(100.0) * dbl(F.sum(F.when(~F.col("low"), F.col("fraud")).otherwise(0)))
         / dbl(F.greatest(F.sum(F.when(~F.col("low"), F.col("transactions")).otherwise(0)), F.lit(1))))
        .alias("fraud_rate_other_hours_pct"))


def _repetition(txns: DataFrame, key: str, side: str, cfg: RiskConfig) -> DataFrame:
    per = txns.groupBy(key).agg(_n().alias("txns"))
    med = exact_quantiles(per, "txns", [0.5], [], cfg).select(F.col("value").alias("median_txns_per_account"))
    rep = F.col("txns") > 1
    a = per.agg(_n().alias("unique_accounts"), count_if(rep).alias("repeat_accounts"),
                F.sum(F.when(rep, F.col("txns")).otherwise(0)).alias("_rep_txns"), F.sum("txns").alias("_txns"),
                F.max("txns").alias("max_txns_one_account"),
                count_if(F.col("txns") == 1).alias("accounts_1_txn"), count_if(F.col("txns") == 2).alias("accounts_2_txns"),
                count_if(F.col("txns").between(3, 5)).alias("accounts_3_to_5_txns"),
                count_if(F.col("txns").between(6, 20)).alias("accounts_6_to_20_txns"),
                count_if(F.col("txns") > 20).alias("accounts_21_plus_txns"))
    return a.crossJoin(med).select(
        F.lit(side).alias("side"), "unique_accounts", "repeat_accounts",
        pct("repeat_accounts", "unique_accounts").alias("pct_accounts_repeat"),
        pct("_rep_txns", "_txns").alias("pct_txns_from_repeat"),
        (dbl("_txns") / dbl("unique_accounts")).alias("mean_txns_per_account"), F.round("median_txns_per_account", 9)
        .alias("median_txns_per_account"), "max_txns_one_account", "accounts_1_txn", "accounts_2_txns",
        "accounts_3_to_5_txns", "accounts_6_to_20_txns", "accounts_21_plus_txns")


def account_repetition(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Origin and destination repetition, UNION ALL of both sides."""
    return _repetition(txns, "name_orig", "origin", cfg).unionByName(
        _repetition(txns, "name_dest", "destination", cfg))


def fan_in_stats(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Distinct senders per receiver (count_distinct per key, partial aggregation) -> mean/max/p99."""
    per = txns.groupBy("name_dest").agg(F.count_distinct("name_orig").alias("unique_senders"))
    p99 = exact_quantiles(per, "unique_senders", [0.99], [], cfg).select(F.round("value", 9).alias("p99_unique_senders"))
    a = per.agg((dbl(F.sum("unique_senders")) / dbl(_n())).alias("mean_unique_senders"),
                F.max("unique_senders").alias("max_unique_senders"))
    return a.crossJoin(p99)


def history_coverage(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Share of rows (all, fraud) with an earlier row of the same origin / destination.

    A row has prior history unless it is its account's first row, so each
    account takes one row, and its label, from the totals: no join."""
    total = txns.agg(_n().alias("_n"), count_if(F.col("is_fraud") == 1).alias("_nf"))
    for key, side in (("name_orig", "origin"), ("name_dest", "destination")):
        per = txns.groupBy(key).agg(F.min_by("is_fraud", F.struct("step", "txn_id")).alias("first"))
        total = total.crossJoin(F.broadcast(per.agg(_n().alias(f"_a_{side}"), F.coalesce(F.sum("first"), F.lit(0)).alias(f"_f_{side}"))))
    return total.select(
        *[pct(F.col("_n") - F.col(f"_a_{s}"), "_n").alias(f"rows_with_prior_{s}_history_pct") for s in ("origin", "destination")],
        *[pct(F.col("_nf") - F.col(f"_f_{s}"), "_nf").alias(f"fraud_rows_with_prior_{s}_history_pct") for s in ("origin", "destination")])


def counterparty_kind(txns: DataFrame) -> DataFrame:
    """A13."""
    g = txns.groupBy(F.substring("name_dest", 1, 1).alias("dest_kind")).agg(
        _n().alias("transactions"), F.sum("is_fraud").cast("bigint").alias("fraud"))
    return g.withColumn("fraud_rate_pct", pct("fraud", "transactions"))


def design_decision(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Origin-side history is usable if >= 30 % of transactions come from repeat senders."""
    per = txns.groupBy("name_orig").agg(_n().alias("n"))
    o = per.agg(pct(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.sum("n")).alias("pct_txns_from_repeat"))
    usable = F.col("pct_txns_from_repeat") >= F.lit(cfg.repeat_origin_share_pct)
    # fixed values: the two decision texts
    return o.select(F.col("pct_txns_from_repeat").alias("origin_pct_txns_from_repeat"),
                    F.when(usable, 1).otherwise(0).alias("origin_history_usable"),
                    F.when(usable, F.lit("build both origin and destination behaviour"))
                    .otherwise(F.lit("shift behavioural analysis to destination, pair, fan-in and velocity"))
                    .alias("design_decision"))


LEAKAGE_CHECKS = ["origin_balance_does_not_reconcile", "destination_balance_does_not_reconcile",
                  "amount_equals_entire_origin_balance", "origin_balance_emptied_to_zero",
                  "destination_balances_both_zero"]


def leakage_checks(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Five balance-pattern rates for fraud vs legitimate and their gap (strict tolerances)."""
    tol = F.lit(cfg.balance_tolerance)
    r = balance_residuals(txns)
    conds = {
        LEAKAGE_CHECKS[0]: F.abs(F.col("balance_error_orig")) > tol,
        LEAKAGE_CHECKS[1]: F.abs(F.col("balance_error_dest")) > tol,
        LEAKAGE_CHECKS[2]: F.abs(F.col("old_balance_orig") - F.col("amount")) < tol,
        LEAKAGE_CHECKS[3]: F.abs(F.col("new_balance_orig")) < tol,
        LEAKAGE_CHECKS[4]: (F.col("old_balance_dest") == 0) & (F.col("new_balance_dest") == 0) & (F.col("amount") > 0),
    }
    fr = F.col("is_fraud") == 1
    a = r.agg(count_if(fr).alias("_nf"), count_if(~fr).alias("_nl"),
              *[count_if(c & fr).alias(f"{k}__f") for k, c in conds.items()],
              *[count_if(c & ~fr).alias(f"{k}__l") for k, c in conds.items()])
    stacked = a.select("_nf", "_nl", F.explode(F.array(*[
        F.struct(F.lit(k).alias("check"), F.col(f"{k}__f").alias("hf"), F.col(f"{k}__l").alias("hl"))
        for k in conds])).alias("s"))
    fp = F.coalesce(pct("s.hf", "_nf"), F.lit(0.0))
    lp = F.coalesce(pct("s.hl", "_nl"), F.lit(0.0))
    return stacked.select(F.col("s.check").alias("check"), fp.alias("fraud_pct"), lp.alias("legitimate_pct"),
                          (fp - lp).alias("separation_pct_points"))


SUSPECT_COLUMNS = ["old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest",
                   "balance_error_orig", "balance_error_dest", "is_flagged_fraud", "amount"]


def univariate_auc(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """ROC-AUC and AP of each suspect column used alone as a score (stack, then rank per column)."""
    r = balance_residuals(txns)
    cols = [c for c in SUSPECT_COLUMNS if c in r.columns]
    stacked = r.select("is_fraud", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), dbl(c).alias("value")) for c in cols])).alias("s")) \
        .select(F.col("s.column").alias("column"), F.col("s.value").alias("value"), "is_fraud")
    m = ranking.ranking_metrics(stacked, "value", "is_fraud", ["column"], cfg)
    return m.select("column", F.col("roc_auc").alias("roc_auc_single_feature"),
                    F.col("pr_auc").alias("pr_auc_single_feature"))


_SIMULATED = "a balance before the event, known in time, but shaped by how the simulator books and reverses payments"
_AFTERWARDS = "a balance after the event, so nobody has it when the payment must be let through or stopped"

# fixed values: the leakage decision table (column, risk, decision); the reasons are this library's words
LEAKAGE_DECISIONS = [
    ("old_balance_orig", "MEDIUM", "EXCLUDE", _SIMULATED),
    ("new_balance_orig", "HIGH", "EXCLUDE", _AFTERWARDS),
    ("old_balance_dest", "MEDIUM", "EXCLUDE", _SIMULATED),
    ("new_balance_dest", "HIGH", "EXCLUDE", _AFTERWARDS),
    ("is_flagged_fraud", "HIGH", "EXCLUDE (kept as a benchmark baseline)",
     "the verdict of another control, not something observed about the payment"),
    ("amount", "LOW", "INCLUDE", "part of the payment request itself"),
    ("txn_type", "LOW", "INCLUDE", "part of the payment request itself"),
    ("step", "LOW (use with care)", "INCLUDE as hour_of_day only",
     "known in time, but as a running number it only says how far the recording has come"),
]


def leakage_decisions(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Static decision table with a reason each, left-joined with the measured single-column AUCs."""
    spark = txns.sparkSession
    d = spark.createDataFrame(LEAKAGE_DECISIONS, "column string, leakage_risk string, primary_model_decision string, reason string")
    return d.join(F.broadcast(univariate_auc(txns, cfg)), "column", "left")


def flag_rule_audit(txns: DataFrame) -> DataFrame:
    """The simulator's own flag rule against the label."""
    fl, fr = F.col("is_flagged_fraud") == 1, F.col("is_fraud") == 1
    a = txns.agg(_n().alias("_n"), count_if(fl).alias("flagged_count"), count_if(fl & fr).alias("flagged_and_fraud"),
                 count_if(fl & ~fr).alias("flagged_and_legitimate"), count_if(~fl & fr).alias("fraud_not_flagged"),
                 count_if(fr).alias("_nf"),
                 F.concat_ws(",", F.array_sort(F.collect_set(F.when(fl, F.col("txn_type"))))).alias("types_flagged"),
                 dbl(F.min(F.when(fl, F.col("amount")))).alias("min_flagged_amount"))
    return a.select("flagged_count", pct("flagged_count", "_n").alias("flagged_pct"), "flagged_and_fraud",
                    "flagged_and_legitimate", "fraud_not_flagged",
                    (F.lit(100.0) * dbl("flagged_and_fraud") / dbl(F.greatest(F.col("_nf"), F.lit(1))))
                    .alias("share_of_fraud_flagged_pct"), "types_flagged", "min_flagged_amount")


def amount_p99(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """J1 helper: the one-row p99 cutoff of amount."""
    return quantile_rows(txns, ["amount"], [0.99]).select(F.col("value").alias("p99_amount_cutoff"))


def cutoff_cross_join(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Every row against the 1-row p99 cutoff (broadcast cross join of a single row)."""
    return txns.crossJoin(F.broadcast(amount_p99(txns, cfg))).select(
        "txn_id", "is_fraud", F.when(dbl("amount") >= F.col("p99_amount_cutoff"), 1).otherwise(0).alias("rule_amount"))


RULES = ["baseline_1_flag_nothing", "baseline_2_flag_everything", "baseline_3_is_flagged_fraud",
         "baseline_4_transfer_or_cashout", "baseline_5_amount_above_p99"]


def rule_baselines(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Five rules in one scan (5 x 4 count_if), stacked to one row per rule."""
    t = txns.crossJoin(F.broadcast(amount_p99(txns, cfg)))
    preds = {RULES[0]: F.lit(False), RULES[1]: F.lit(True), RULES[2]: F.col("is_flagged_fraud") == 1,
             RULES[3]: risk_type(), RULES[4]: dbl("amount") >= F.col("p99_amount_cutoff")}
    y = F.col("is_fraud") == 1
    aggs = []
    for k, p in preds.items():
        aggs += [count_if(p & y).alias(f"{k}__TP"), count_if(p & ~y).alias(f"{k}__FP"),
                 count_if(~p & y).alias(f"{k}__FN"), count_if(~p & ~y).alias(f"{k}__TN")]
    a = t.agg(*aggs)
    stacked = a.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("rule"), *[F.col(f"{k}__{m}").alias(m) for m in ("TP", "FP", "FN", "TN")])
        for k in preds])).alias("s")).select("s.*")
    return ranking.with_confusion_ratios(stacked)


def amount_ranking(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Amount used as a score -- ROC-AUC, AP, lift, p99 cutoff."""
    m = ranking.ranking_metrics(txns.select(dbl("amount").alias("score"), "is_fraud"), "score", "is_fraud", [], cfg)
    return m.crossJoin(amount_p99(txns, cfg).select(F.round("p99_amount_cutoff", 9).alias("p99_amount_cutoff")))


def structure(txns: DataFrame) -> DataFrame:
    """row/column counts and the schema as rows (column, dtype, position)."""
    spark = txns.sparkSession
    schema = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(txns.dtypes)],
                                   "position int, column string, dtype string")
    return schema.crossJoin(txns.agg(_n().alias("n_rows"))).withColumn("n_columns", F.lit(len(txns.columns)))


def full_audit(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> dict[str, DataFrame]:
    """Every section as a lazily built DataFrame; a failing section is isolated, not fatal."""
    sections = {
        "structure": structure, "data_quality": quality_counts, "step_and_time": step_profile,
        "transaction_type": profile_by_type, "amount": amount_stats, "target": class_balance,
        "flagged": flag_rule_audit, "account_repetition": account_repetition,
        "leakage_audit": leakage_checks, "honest_baselines": rule_baselines,
    }
    out: dict[str, DataFrame] = {}
    for name, fn in sections.items():
        try:
            out[name] = fn(txns, cfg) if fn.__code__.co_argcount > 1 else fn(txns)
        except Exception as exc:  # noqa: BLE001 - isolate the section, report it as a row
            out[name] = _failure(txns, exc)
    return out


def _failure(txns: DataFrame, exc: Exception) -> DataFrame:
    return txns.sparkSession.createDataFrame([(f"{type(exc).__name__}: {exc}"[:500],)], "error string")


# the column that names a section's rows; the other sections have one row
SECTION_ITEM = {"structure": "column", "transaction_type": "txn_type", "amount": "class",
                "account_repetition": "side", "leakage_audit": "check", "honest_baselines": "rule"}


def _long(section: str, df: DataFrame) -> DataFrame:
    """(section, item, metric, value, text): one row per cell of a section, numbers in value and strings in text."""
    item = SECTION_ITEM.get(section)
    cells = []
    for f in df.schema.fields:
        if f.name == item and item in df.columns:
            continue
        text = f.dataType.simpleString() == "string"
        cells.append(F.struct(F.lit(f.name).alias("metric"),
                              (F.lit(None) if text else F.col(f.name)).cast("double").alias("value"),
                              (F.col(f.name) if text else F.lit(None)).cast("string").alias("text")))
    named = F.col(item) if item in df.columns else F.lit("")
    return df.select(F.lit(section).alias("section"), named.alias("item"), F.explode(F.array(*cells)).alias("c")).select(
        "section", "item", "c.metric", "c.value", "c.text")


def audit_report(sections: dict[str, DataFrame]) -> DataFrame:
    """A22 as one table of typed cells: (section, item, metric, value, text).

    Every section is a report of a few rows (types, columns, rules, classes), so
    it is run here; one that fails at run time gives its error as text and costs no other."""
    out = []
    spark = next(iter(sections.values())).sparkSession
    for name, df in sections.items():
        try:
            out += [tuple(r) for r in _long(name, df).collect()]
        except Exception as exc:  # noqa: BLE001
            out.append((name, "", "error", None, f"{type(exc).__name__}: {exc}"[:500]))
    return spark.createDataFrame(out, "section string, item string, metric string, value double, text string")


def share_over_total(txns: DataFrame) -> DataFrame:
    """SUM(COUNT(*)) OVER () and SUM(SUM(is_fraud)) OVER () -- a window over the <= #types
    aggregate (never over rows), giving each type's share of volume and of fraud."""
    g = txns.groupBy("txn_type").agg(F.count(F.lit(1)).alias("transactions"),
                                     F.sum("is_fraud").cast("bigint").alias("fraud"))
    all_ = Window.partitionBy()
    return g.select("txn_type", "transactions", "fraud",
                    F.sum("transactions").over(all_).alias("total_transactions"),
                    F.sum("fraud").over(all_).cast("bigint").alias("total_fraud"),
                    pct("transactions", F.sum("transactions").over(all_)).alias("pct_of_volume"),
                    pct("fraud", F.sum("fraud").over(all_)).alias("share_of_all_fraud_pct"))
