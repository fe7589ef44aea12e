"""The reference's invariants: no peeking features, no leaking split, a cost curve that minimises cost."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, LEAKAGE_SUSPECTS
from riskframe.operators import audit, cost, features as fe, model, ranking
from riskframe.sources import contract
from riskframe.sources.fixtures import scorecard


def test_contract_rejects_wrong_schema():
    with pytest.raises(contract.ContractError):
        contract.validate_columns(["step", "amount"])


def test_contract_ignores_extra_columns():
    cols = list(contract.RAW_COLUMNS if hasattr(contract, "RAW_COLUMNS") else []) or list(
        __import__("riskframe.config", fromlist=["RAW_COLUMNS"]).RAW_COLUMNS)
    assert contract.validate_columns(cols + ["note"]) == cols


def test_hour_and_day_ranges(features):
    r = features.agg(F.min("hour_of_day"), F.max("hour_of_day"), F.min("sim_day")).first()
    assert r[0] >= 0 and r[1] <= 23 and r[2] >= 1


def test_first_transaction_has_no_history(features):
    firsts = features.groupBy("name_dest").agg(F.min(F.struct("step", "txn_id")).alias("f")).select("f.txn_id")
    rows = features.join(firsts, "txn_id").agg(
        F.max("dest_prior_txn_count"), F.count("dest_prior_avg_amount"), F.max("dest_txn_prev_24h"),
        F.max("dest_prior_unique_senders")).first()
    assert rows[0] == 0 and rows[1] == 0 and rows[2] == 0 and rows[3] == 0
    ofirst = features.groupBy("name_orig").agg(F.min(F.struct("step", "txn_id")).alias("f")).select("f.txn_id")
    o = features.join(ofirst, "txn_id").agg(F.max("orig_prior_txn_count"), F.count("orig_prior_avg_amount")).first()
    assert o[0] == 0 and o[1] == 0


def test_velocity_windows_nest(features):
    bad = features.where((F.col("dest_txn_prev_24h") > F.col("dest_txn_prev_72h"))
                         | (F.col("dest_txn_prev_72h") > F.col("dest_txn_prev_168h"))).count()
    assert bad == 0


def test_fan_in_not_above_count(features):
    assert features.where(F.col("dest_prior_unique_senders") > F.col("dest_prior_txn_count")).count() == 0


def test_window_count_equals_brute_force(spark):
    """400 rows, 12 entities, steps 1..199, window 24: chunked RANGE count == brute force."""
    rng = random.Random(7)
    rows = sorted((rng.randint(0, 11), rng.randint(1, 199)) for _ in range(400))
    data = [(i, s, "PAYMENT", 10.0, "C1", f"E{e}") for i, (e, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "txn_id long, step int, txn_type string, amount double, name_orig string, name_dest string") \
              .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    for cfg in (DEFAULT, DEFAULT.__class__(history_block=16, hot_key_rows=30)):  # plain, then mostly chunked
        got = {r["txn_id"]: r["v"] for r in fe.past_only(df, ["name_dest"], cfg, ranges={"v": (24, 1, "count")})
               .select("txn_id", "v").collect()}
        for i, (e, s) in enumerate(rows):
            expect = sum(1 for (e2, s2) in rows if e2 == e and s - 24 <= s2 <= s - 1)
            assert got[i] == expect


def test_expanding_history_equals_brute_force(spark):
    rng = random.Random(11)
    data = [(i, rng.randint(1, 50), "PAYMENT", float(rng.randint(1, 500)), "C1", f"E{rng.randint(0, 3)}") for i in range(300)]
    df = spark.createDataFrame(data, "txn_id long, step int, txn_type string, amount double, name_orig string, name_dest string") \
              .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    for cfg in (DEFAULT, DEFAULT.__class__(history_block=8, hot_key_rows=70)):
        _check_expanding(fe.past_only(df, ["name_dest"], cfg, want_max=True, want_prev=True, prefix="d"), data)


def _check_expanding(result, data):
    got = {r["txn_id"]: r for r in result.collect()}
    for i, s, _, a, _, d in data:
        prior = [(s2, i2, a2) for (i2, s2, _, a2, _, d2) in data if d2 == d and (s2, i2) < (s, i)]
        r = got[i]
        assert r["d_n"] == len(prior)
        assert (r["d_mx"] is None) == (not prior)
        if prior:
            assert float(r["d_mx"]) == max(p[2] for p in prior)
            assert float(r["d_s"]) == pytest.approx(sum(p[2] for p in prior))
            assert r["d_prev_step"] == max(prior)[0]


def test_model_columns_exclude_leakage():
    banned = set(LEAKAGE_SUSPECTS) | {"step", "is_fraud", "txn_id"}
    assert not banned & set(fe.MODEL_COLUMNS)
    assert len(fe.MODEL_COLUMNS) == 38


def test_split_is_chronological_disjoint_complete(txns):
    labelled, summary = model.time_split(txns)
    r = {row["split"]: row for row in summary.collect()}
    assert r["train"]["last_step"] < r["validation"]["first_step"] <= r["validation"]["last_step"] < r["test"]["first_step"]
    assert sum(x["rows"] for x in r.values()) == txns.count()


def test_sweep_counts_are_consistent(txns):
    s = cost.threshold_sweep(scorecard(txns)).orderBy("threshold").collect()
    n = txns.count()
    p = txns.agg(F.sum("is_fraud")).first()[0]
    for row in s:
        assert row["TP"] + row["TN"] + row["FP"] + row["FN"] == n
        assert row["TP"] + row["FN"] == p
    alerts = [row["alert_volume"] for row in s]
    assert all(a >= b for a, b in zip(alerts, alerts[1:]))


def test_optimum_is_minimum_cost(txns):
    sweep = cost.threshold_sweep(scorecard(txns))
    best = cost.optimal_threshold(sweep).first()
    assert best["total_cost_at_optimum"] == sweep.agg(F.min("total_cost")).first()[0]


def test_verify_not_above_block(txns):
    b = cost.risk_band_thresholds(scorecard(txns)).first()
    assert b["medium_risk_threshold_verify"] <= b["high_risk_threshold_block"]


def test_all_audit_sections_run(txns):
    secs = audit.full_audit(txns)
    assert set(secs) >= {"structure", "data_quality", "leakage_audit", "honest_baselines"}
    for name, df in secs.items():
        assert df.columns != ["error"], name


def test_flag_nothing_accuracy_is_one_minus_prevalence(txns):
    r = {x["rule"]: x for x in audit.rule_baselines(txns).collect()}
    prev = txns.agg(F.avg("is_fraud")).first()[0]
    assert math.isclose(r["baseline_1_flag_nothing"]["accuracy"], 1 - prev)


def test_ap_and_auc_match_fixture_values(txns):
    m = ranking.ranking_metrics(scorecard(txns)).first()
    assert round(m["pr_auc"], 9) == 0.782585845
    assert round(m["roc_auc"], 9) == 0.945774428


def test_a_failing_section_costs_no_other(txns):
    """Analysis errors and run-time errors both become rows."""
    from riskframe.operators.audit import audit_report
    ok = txns.agg(F.count("*").alias("n"))
    boom = txns.select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
    rows = {r["section"]: r for r in audit_report({"a": ok, "b": boom, "c": ok}).collect()}
    assert rows["b"]["metric"] == "error" and "boom" in rows["b"]["text"] and rows["b"]["value"] is None
    assert rows["a"]["text"] is None and rows["c"]["value"] == rows["a"]["value"] > 0


def test_hour_calendar_has_every_hour(txns):
    from riskframe.operators.audit import hour_calendar
    rows = hour_calendar(txns.where("(step - 1) % 24 < 5")).orderBy("hour_of_day").collect()
    assert [r["hour_of_day"] for r in rows] == list(range(24))
    assert all(r["transactions"] == 0 and r["fraud_rate_pct"] is None for r in rows[5:]) and rows[0]["transactions"] > 0


def test_permutation_deals_each_row_once(spark):
    from riskframe.config import DEFAULT
    from riskframe.operators import model
    rows = [(i, i % 2, float(i), float(-i)) for i in range(300)] + [(None, 1, 500.0, 500.0), (7, 1, 600.0, 600.0)]
    x = spark.createDataFrame(rows, "txn_id long, is_fraud int, a double, b double").repartition(3)
    pairs = [(c, r) for c in ("a", "b") for r in range(2)]
    dealt = model._dealt(x, ["a", "b"], pairs, 4, False, DEFAULT)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Generate" not in plan  # a row's values travel with the row, not one by one
    got = dealt.collect()
    assert sorted(r["txn_id"] for r in got) == sorted([*range(300), 7])
    assert {(r["txn_id"], r["a"]) for r in got} == {(i, a) for i, _, a, _ in rows if i is not None}
    for i, (c, _) in enumerate(pairs):
        given = [r["given"][i] for r in got]  # each value of a bucket once; a row without an id may give its own
        assert len(set(given)) == 301 and set(given) <= {r[2 if c == "a" else 3] for r in rows}
    assert [r["given"][0] for r in got] != [r["given"][1] for r in got]


def test_permutation_importance_with_many_positives(spark):
    """Half of all rows positive: the strong feature keeps its importance, and a rerun gives the same numbers."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    rng = random.Random(3)
    data = [(i, i % 2, (i % 2) * 2.0 + rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(2000)]
    df = spark.createDataFrame(data, "txn_id long, is_fraud int, strong double, weak double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["strong", "weak"], outputCol="features"),
                         LogisticRegression(labelCol="is_fraud")]).fit(df)
    runs = [{r["feature"]: r["pr_auc_drop_when_shuffled"] for r in
             model.permutation_importance(m, df.repartition(n), ["strong", "weak"], repeats=2, bucket_rows=500).collect()} for n in (2, 5)]
    assert runs[0]["strong"] > 0.2 and abs(runs[0]["weak"]) < 0.05
    assert all(math.isclose(runs[0][c], runs[1][c], abs_tol=1e-9) for c in runs[0])


def test_model_kpis_agree_with_the_confusion_counts(spark, txns):
    """A trained model carried into the decision tables: alerts equal FP + TP, and one failing fit costs no other."""
    from riskframe.operators import dashboard
    f = fe.build_features(txns)
    tr, ve, _ = model.split_steps(txns)
    train, val = f.where(F.col("step") <= tr), f.where((F.col("step") > tr) & (F.col("step") <= ve))

    def broken(_):
        raise ValueError("no")
    models = model.fit_all(train, {"broken": broken, "logistic_regression": model.fit_logreg})
    name, table = model.select_model(models, val)
    assert name == "logistic_regression" and table.count() == 1
    d = dashboard.decide(model.score_rows(models[name], f))
    kpi = dashboard.kpi_summary(d).first()
    out = {r["outcome_class"]: r["count"] for r in d.scored_test.groupBy("outcome_class").count().collect()}
    assert kpi["alerts_raised"] == out.get("true_positive", 0) + out.get("false_positive", 0)
    with pytest.raises(RuntimeError):
        model.fit_all(train, {"broken": broken})


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from riskframe import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
