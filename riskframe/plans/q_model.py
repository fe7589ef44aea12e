"""Registered split and model queries (M1-M5, M3w, M11, M12, I1-I3, T5).

Model fits are actions inside the builders (MLlib fits eagerly); the returned
DataFrames are small tables or the scored split.  Only the split queries and
the class weights have exact oracles; the rest are rows-only checks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.models import compiled as cm
from riskframe.models import frozen
from riskframe.operators import dashboard as db
from riskframe.operators import features as fe
from riskframe.operators import model as md
from riskframe.operators.ranking import ranking_metrics
from riskframe.oracles.base import FEATURES, TXN, pct, with_ctes
from riskframe.plans.catalog import register
from riskframe.plans.q_analysis import SPLIT_SQL
from riskframe.plans.q_audit import ranking_sql
from riskframe.sources.fixtures import events_transactions

T = events_transactions


def _split_features(spark, sf):
    from riskframe.session import cached
    # one feature computation feeds the three splits and every fit/score below
    f = cached(fe.build_features(T(spark, sf)))
    tr, ve, _ = md.split_steps(f)
    return f, f.where(F.col("step") <= tr), f.where((F.col("step") > tr) & (F.col("step") <= ve)), f.where(F.col("step") > ve)


@register("time_split", with_ctes(f"""
SELECT split, rows, {pct('rows', 'SUM(rows) OVER ()')} AS row_pct, fraud, {pct('fraud', 'rows')} AS fraud_rate_pct,
  first_step, last_step, train_end_step, validation_end_step
FROM (SELECT CASE WHEN step <= train_end_step THEN 'train' WHEN step <= validation_end_step THEN 'validation' ELSE 'test' END AS split,
        COUNT(*) AS rows, CAST(SUM(is_fraud) AS BIGINT) AS fraud, MIN(step) AS first_step, MAX(step) AS last_step,
        ANY_VALUE(train_end_step) AS train_end_step, ANY_VALUE(validation_end_step) AS validation_end_step
      FROM transactions, bounds GROUP BY 1)""", TXN, SPLIT_SQL))
def q_time_split(spark, sf):
    return md.time_split(T(spark, sf))[1]


@register("split_guard", with_ctes("""
SELECT split, rows, fraud, true AS usable FROM (
  SELECT CASE WHEN step <= train_end_step THEN 'train' WHEN step <= validation_end_step THEN 'validation' ELSE 'test' END AS split,
    COUNT(*) AS rows, CAST(SUM(is_fraud) AS BIGINT) AS fraud FROM transactions, bounds GROUP BY 1)""", TXN, SPLIT_SQL))
def q_split_guard(spark, sf):
    return md.split_guard(md.time_split(T(spark, sf))[1]).select("split", "rows", "fraud", "usable")


@register("class_weight", with_ctes("""
SELECT txn_id, CAST(n AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(nc AS DOUBLE)) AS class_weight
FROM (SELECT txn_id, COUNT(*) OVER () AS n, COUNT(*) OVER (PARTITION BY is_fraud) AS nc FROM transactions)""", TXN))
def q_class_weight(spark, sf):
    return md.class_weights(T(spark, sf)).select("txn_id", "class_weight")


@register("fit_logreg")
def q_fit_logreg(spark, sf):
    _, train, _, _ = _split_features(spark, sf)
    m = md.fit_logreg(train)
    lr = m.stages[-1]
    rows = [(c, float(w)) for c, w in zip(fe.MODEL_COLUMNS, lr.coefficients.toArray())] + [("(intercept)", float(lr.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double")


@register("fit_random_forest")
def q_fit_random_forest(spark, sf):
    _, train, _, _ = _split_features(spark, sf)
    return md.builtin_importance(md.fit_random_forest(train))


@register("fit_gbt")
def q_fit_gbt(spark, sf):
    _, train, _, _ = _split_features(spark, sf)
    return md.builtin_importance(md.fit_gbt(train))


@register("score_rows")
def q_score_rows(spark, sf):
    _, train, _, test = _split_features(spark, sf)
    return md.score_rows(md.fit_logreg(train), test.select("txn_id", "step", "is_fraud", *fe.MODEL_COLUMNS)) \
             .select("txn_id", "is_fraud", "score")


_FITTERS = {"logistic_regression": md.fit_logreg, "random_forest": md.fit_random_forest}


@register("model_selection")
def q_model_selection(spark, sf):
    """M9 on real models: LR and RF scored on validation, ranked by PR-AUC (rank 1 is selected)."""
    _, train, val, _ = _split_features(spark, sf)
    return md.select_model(md.fit_all(train, _FITTERS, required=_FITTERS), val)[1]


def _model_decision(spark, sf):
    """The selected model's scores on validation and test, and the decision context they give."""
    from riskframe.session import cached
    f, train, val, _ = _split_features(spark, sf)
    split = md.split_steps(f)
    models = md.fit_all(train, _FITTERS, required=_FITTERS)
    name, _ = md.select_model(models, val)
    scored = cached(md.score_rows(models[name], f.where(F.col("step") > split[0])))  # a decision reads no training rows
    return name, db.decide(scored, split=split)


@register("model_kpi_summary")
def q_model_kpi_summary(spark, sf):
    """C2-C5 and D2 for the selected model: threshold and bands from its validation scores, KPIs on the test split."""
    name, d = _model_decision(spark, sf)
    return db.kpi_summary(d).withColumn("model", F.lit(name))


@register("model_scored_table")
def q_model_scored_table(spark, sf):
    """D1 for the selected model."""
    return db.scored_table(_model_decision(spark, sf)[1])


@register("leakage_demo")
def q_leakage_demo(spark, sf):
    """Random forest on the excluded balance columns -- NOT a deployable model."""
    t = T(spark, sf)
    tr, ve, _ = md.split_steps(t)
    cols = md.LEAKAGE_DEMO_COLUMNS
    train = t.where(F.col("step") <= tr)
    test = t.where(F.col("step") > ve)
    m = md.fit_random_forest(train, columns=cols)
    s = md.score_rows(m, test.select("txn_id", "is_fraud", *cols), columns=cols)
    return ranking_metrics(s).withColumn("note", F.lit("LEAKAGE DEMONSTRATION - NOT VALID FOR DEPLOYMENT"))


@register("builtin_importance")
def q_builtin_importance(spark, sf):
    _, train, _, _ = _split_features(spark, sf)
    return md.builtin_importance(md.fit_logreg(train))


@register("top_importance")
def q_top_importance(spark, sf):
    _, train, _, _ = _split_features(spark, sf)
    return md.top_importance(md.builtin_importance(md.fit_random_forest(train)), 25)


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    _, train, _, test = _split_features(spark, sf)
    m = md.fit_logreg(train)
    return md.permutation_importance(m, test, repeats=3)


_FROZEN = {"logistic_regression": frozen.logreg, "random_forest": frozen.forest, "boosted_trees": frozen.boosted}


@register("frozen_score_rows", with_ctes(
    "SELECT txn_id, " + ", ".join(f"round({cm.score_sql(m())}, 12) AS {name}" for name, m in _FROZEN.items()) + " FROM features",
    TXN, FEATURES))
def q_frozen_score_rows(spark, sf):
    """M12 with models fitted once: every transaction scored by the compiled logistic regression, forest and boosted trees."""
    rows = fe.build_features(T(spark, sf))
    return rows.select("txn_id", *[F.round(cm.score(m()), 12).alias(name) for name, m in _FROZEN.items()])


@register("frozen_linear_attribution", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(AVG(abs({t})), 9) AS mean_abs_attribution FROM features"
    for c, t in cm.linear_terms(frozen.logreg()).items()), TXN, FEATURES))
def q_frozen_linear_attribution(spark, sf):
    """I3 for the frozen logistic regression, over all transactions; features without weight or spread are left out."""
    found = md.linear_attribution(frozen.logreg(), fe.build_features(T(spark, sf)))
    return found.where(F.col("feature").isin(list(cm.linear_terms(frozen.logreg())))).select(
        "feature", F.round("mean_abs_attribution", 9).alias("mean_abs_attribution"))


@register("frozen_model_comparison", with_ctes(
    "SELECT model, roc_auc, pr_auc, pr_auc_no_skill_baseline, pr_auc_lift_over_no_skill FROM rm",
    TXN, FEATURES, ranking_sql(" UNION ALL ".join(
        f"SELECT '{name}' AS model, round({cm.score_sql(m())}, 12) AS value, is_fraud AS y FROM features" for name, m in _FROZEN.items()),
        "model")))
def q_frozen_model_comparison(spark, sf):
    """M6, M7 and M9 on model scores: PR-AUC and ROC-AUC of each frozen model over all transactions."""
    rows = fe.build_features(T(spark, sf))
    long = rows.select("is_fraud", F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.round(cm.score(m()), 12).alias("score"))
                                                       for name, m in _FROZEN.items()])).alias("s")).select("is_fraud", "s.*")
    return ranking_metrics(long, group_cols=["model"])


@register("linear_attribution")
def q_linear_attribution(spark, sf):
    _, train, _, test = _split_features(spark, sf)
    return md.linear_attribution(md.fit_logreg(train), test)
