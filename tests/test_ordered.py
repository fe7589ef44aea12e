"""The bucketed global-order primitive against plain Python on skewed data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.config import RiskConfig
from riskframe.functions.ordered import cumulative, exact_quantiles
from riskframe.operators.cost import threshold_sweep
from riskframe.operators.ranking import binary_metrics, curve_points, ranking_metrics, top_k_capture


def _np_quantile(v, q):
    v = np.sort(np.asarray(v, dtype=float))
    pos = q * (len(v) - 1)
    lo, hi = int(np.floor(pos)), int(np.ceil(pos))
    return v[lo] + (v[hi] - v[lo]) * (pos - lo)


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.full(3000, 7.25), rng.normal(0, 5, 6000).round(3)])  # one value = 1/3 of rows
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    cfg = RiskConfig(order_bucket_rows=50, order_fanout=32)
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9, 0.999], [], cfg).collect()}
    for q, v in got.items():
        assert abs(v - _np_quantile(vals, q)) < 1e-9


def test_cumulative_is_exact_across_buckets(spark):
    rng = np.random.default_rng(5)
    vals = rng.integers(0, 500, 4000)
    df = spark.createDataFrame([(int(x),) for x in vals], "v long")
    out = cumulative(df, "v", {"n": F.lit(1).cast("long")}, [], RiskConfig(order_bucket_rows=10, order_fanout=4))
    got = {r["v"]: r["cum_n"] for r in out.collect()}
    for v, c in got.items():
        assert c == int((vals <= v).sum())


def test_ap_auc_with_ties_against_brute_force(spark):
    rng = np.random.default_rng(9)
    y = (rng.random(3000) < 0.05).astype(int)
    s = np.round(rng.random(3000) * 0.3 + 0.4 * y, 2)  # many ties
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, is_fraud int")
    m = ranking_metrics(df, cfg=RiskConfig(order_bucket_rows=5, order_fanout=3)).first()
    # brute force
    order = sorted(set(s), reverse=True)
    P = y.sum()
    ap, tp, n = 0.0, 0, 0
    for t in order:
        sel = s == t
        tp += y[sel].sum(); n += sel.sum()
        ap += y[sel].sum() / P * (tp / n)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(m["pr_auc"] - ap) < 1e-8 and abs(m["roc_auc"] - auc) < 1e-8


def test_top_k_breaks_ties_by_txn_id(spark):
    data = [(i, 0.5 if i < 100 else 0.1, 1 if i % 3 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(data, "txn_id long, score double, is_fraud int")
    r = {x["review_fraction"]: x for x in top_k_capture(df, fractions=(0.05, 0.2)).collect()}
    assert r[0.05]["transactions_reviewed"] == 50
    assert r[0.05]["fraud_captured"] == sum(1 for i in range(50) if i % 3 == 0)
    assert r[0.2]["fraud_captured"] == sum(1 for i in range(100) if i % 3 == 0) + sum(1 for i in range(100, 200) if i % 3 == 0)


def test_many_buckets_stay_exact(spark):
    """Thousands of buckets over three levels."""
    vals = list(range(4000)) * 2
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    out = cumulative(df, "v", {"n": F.lit(1).cast("long")}, [], RiskConfig(order_bucket_rows=1, order_fanout=8))
    assert out.agg(F.countDistinct("__bk")).first()[0] > 800
    assert out.where(F.col("cum_n") != (F.col("v") + 1) * 2).count() == 0
    assert out.where(F.col("cum_d") != F.col("v") + 1).count() == 0
    got = exact_quantiles(df, "v", [0.0, 0.123, 0.5, 1.0], [], RiskConfig(order_bucket_rows=3, order_fanout=8)).collect()
    assert {r["q"]: r["value"] for r in got} == {q: _np_quantile(vals, q) for q in (0.0, 0.123, 0.5, 1.0)}


def test_quantiles_of_groups_with_null_keys_nan_and_infinity(spark):
    rows = [(None, float(i)) for i in range(50)] + [("a", float(i % 7)) for i in range(100)] + [("b", None), ("c", float("inf")), ("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for cfg in (RiskConfig(), RiskConfig(order_bucket_rows=4, order_fanout=3)):
        got = {r["g"]: r["value"] for r in exact_quantiles(df, "v", [0.25], ["g"], cfg).collect()}
        assert got[None] == _np_quantile(range(50), 0.25) and got["a"] == _np_quantile([i % 7 for i in range(100)], 0.25)
        assert "b" not in got and got["c"] == float("inf")


@pytest.mark.parametrize("labels", [[], [0, 0, 0], [1, 1, 1], [0, 1, 0]])
def test_one_class_has_no_ranking_metric(spark, labels):
    df = spark.createDataFrame([(0.1 * i, y) for i, y in enumerate(labels)], "score double, is_fraud int")
    rows = ranking_metrics(df).collect()
    if len(set(labels)) < 2:
        assert all(r["pr_auc"] is None and r["roc_auc"] is None for r in rows)
    else:
        assert rows[0]["pr_auc"] is not None
    curve_points(df).collect()


def test_scores_without_a_value_take_no_part(spark):
    rows = [(0.9, 1), (0.2, 0), (0.4, 1), (None, 0), (None, 1), (float("nan"), 0)]
    df, full = (spark.createDataFrame(r, "score double, is_fraud int") for r in (rows, rows[:3]))
    for f in (ranking_metrics, threshold_sweep, binary_metrics, curve_points):
        assert sorted(map(str, f(df).collect())) == sorted(map(str, f(full).collect()))


def test_curves_have_their_ends(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 0), (0.6, 1)], "score double, is_fraud int")
    pts = curve_points(df, cfg=RiskConfig(order_bucket_rows=1, order_fanout=2)).orderBy("curve", "point_index").collect()
    roc = [(r["x"], r["y"]) for r in pts if r["curve"] == "roc"]
    pr = [(r["x"], r["y"]) for r in pts if r["curve"] == "pr"]
    assert roc == [(0.0, 0.0), (0.0, 0.5), (1.0, 0.5), (1.0, 1.0)]
    assert pr == [(1.0, 0.5), (0.5, 1 / 3), (0.5, 0.5), (0.5, 1.0), (0.0, 1.0)]
