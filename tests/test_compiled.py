import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from riskframe.models import compiled as cm
from riskframe.models import frozen
from riskframe.operators import model as md

COLUMNS = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3)).round(3)
    y = (x[:, 0] - 0.7 * x[:, 1] * (x[:, 2] > 0) + rng.normal(size=600) > 0.4).astype(int)
    data = [(i, int(y[i]), *(None if (i + j) % 17 == 0 else float(v) for j, v in enumerate(x[i])), 2.0) for i in range(600)]
    return spark.createDataFrame(data, "txn_id long, is_fraud int, a double, b double, c double, flat double").cache()


@pytest.fixture(scope="module")
def models(rows):
    fit = lambda m: Pipeline(stages=[md._assembler(COLUMNS), m]).fit(md._training_rows(rows, COLUMNS))
    return {"logreg": md.fit_logreg(rows, COLUMNS),
            "forest": fit(RandomForestClassifier(labelCol="is_fraud", numTrees=6, maxDepth=4, seed=1)),
            "boosted": fit(GBTClassifier(labelCol="is_fraud", maxIter=4, maxDepth=3, seed=1))}


@pytest.mark.parametrize("name", ["logreg", "forest", "boosted"])
def test_compiled_scores_equal_the_fitted_model(rows, models, name):
    plain = cm.compiled(models[name], COLUMNS)
    assert cm.from_json(cm.as_json(plain)) == plain
    want = {r["txn_id"]: r["score"] for r in md.score_rows(models[name], rows, COLUMNS).collect()}
    got = {r["txn_id"]: r["score"] for r in cm.score_rows(plain, rows).collect()}
    assert len(got) == 600 and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    assert 0.05 < np.std(list(got.values()))


@pytest.mark.parametrize("name", ["logreg", "forest", "boosted"])
def test_the_same_text_scores_on_another_engine(rows, models, name):
    plain = cm.compiled(models[name], COLUMNS)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (txn_id BIGINT, is_fraud INT, a DOUBLE, b DOUBLE, c DOUBLE, flat DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", [tuple(r) for r in rows.collect()])
    other = dict(con.execute(f"SELECT txn_id, {cm.score_sql(plain)} FROM t").fetchall())
    own = {r["txn_id"]: r["score"] for r in cm.score_rows(plain, rows).collect()}
    assert all(math.isclose(own[k], other[k], abs_tol=1e-12) for k in own)


def _matrix(rows):
    found = sorted(rows.collect(), key=lambda r: r["txn_id"])
    return np.array([[r[c] or 0.0 for c in COLUMNS] for r in found]), np.array([r["is_fraud"] for r in found])


def test_logistic_regression_meets_the_conditions_of_its_optimum(rows, models):
    """M3 against numpy: the gradient of the summed loss with C = 1 vanishes on standardised columns."""
    x, y = _matrix(rows)
    plain = cm.compiled(models["logreg"], COLUMNS)
    sd = x.std(axis=0, ddof=1)
    assert np.allclose(plain.means, x.mean(axis=0)) and np.allclose(plain.sds, sd)
    z = (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1)
    w = np.array(plain.weights)
    off = 1 / (1 + np.exp(-(plain.intercept + z @ w))) - y
    assert np.abs(z.T @ off + w).max() < 0.05 * np.abs(z.T @ (y.mean() - y)).max() and abs(off.sum()) < 0.1 and w[3] == 0


def test_importances_and_attributions_equal_numpy(spark, rows, models):
    """I1 and I3."""
    x, _ = _matrix(rows)
    plain = cm.compiled(models["logreg"], COLUMNS)
    table = {r["feature"]: r["importance"] for r in md.builtin_importance(models["logreg"], COLUMNS).collect()}
    assert table == cm.importance(plain) == {c: abs(w) for c, w in zip(COLUMNS, plain.weights)}
    assert {r["feature"]: r["importance"] for r in md.builtin_importance(models["forest"], COLUMNS).collect()} == \
        cm.importance(cm.compiled(models["forest"], COLUMNS))
    sd = np.where(np.array(plain.sds) > 0, plain.sds, 1)
    want = np.abs(np.array(plain.weights) * (x - plain.means) / sd).mean(axis=0)
    got = {r["feature"]: r["mean_abs_attribution"] for r in md.linear_attribution(models["logreg"], rows, COLUMNS).collect()}
    assert all(math.isclose(got[c], v, abs_tol=1e-9) for c, v in zip(COLUMNS, want))
    top = md.top_importance(cm.importance_table(spark, plain), 2).collect()
    assert [r["feature"] for r in top] == sorted(COLUMNS, key=lambda c: (-table[c], c))[:2]


@pytest.mark.parametrize("name", ["logreg", "forest", "boosted"])
def test_permutation_by_changes_equals_permutation_of_wide_rows(rows, models, name):
    """The same drops whether a row is scored anew or by what one value changes."""
    of = lambda **kw: {r["feature"]: (r["pr_auc_drop_when_shuffled"], r["std"]) for r in md.permutation_importance(
        models[name], rows, COLUMNS, repeats=2, **kw).collect()}
    assert cm.changed_nodes(cm.compiled(models[name], COLUMNS), COLUMNS * 2) <= 1_000
    narrow, wide = of(), of(most_nodes=-1)
    assert set(narrow) == set(COLUMNS) and narrow["a"][0] > 0.02 and abs(narrow["flat"][0]) < 1e-12
    assert all(math.isclose(u, v, abs_tol=1e-6) for c in COLUMNS for u, v in zip(narrow[c], wide[c]))


def test_no_wide_copies_for_compiled_models(rows, models):
    plan = md.permutation_importance(models["logreg"], rows, COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan


def test_unusual_models(spark):
    none = cm.Linear(("a",), (0.0,), (0.0,), (3.0,), -1.0)
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS a")
    assert row.select(cm.score(none).alias("s")).first()["s"] == pytest.approx(1 / (1 + math.e))
    leaf = cm.Trees(("a",), (cm.Leaf(0.25),), (1.0,), (0.0,), False)
    assert row.select(cm.score(leaf).alias("s")).first()["s"] == 0.25 and cm.changed_nodes(leaf, ['a']) == 0
    with pytest.raises(ValueError):
        cm.number(float("nan"))


def test_frozen_models_rank_fraud(spark, features):
    for model in (frozen.logreg(), frozen.forest(), frozen.boosted()):
        by = {r["is_fraud"]: r["s"] for r in features.groupBy("is_fraud").agg(F.avg(cm.score(model)).alias("s")).collect()}
        assert by[1] > 1.5 * by[0]
