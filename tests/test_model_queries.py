"""The registered model queries on made-up events."""
import random

import pytest

from riskframe.operators import model as md
from riskframe.plans import q_model


@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    rng = random.Random(5)
    kinds = ["purchase", "click", "view", "signup", "error"]
    rows = [(i, 60 * i, rng.randrange(40), rng.choice(kinds), rng.randrange(100, 30_000) / 100, f'{{"k": {rng.randrange(9)}}}')
            for i in range(3_000)]
    out = tmp_path_factory.mktemp("events")
    spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "timestamp_seconds(1704067200 + s) AS ts", "user_id", "event_type", "value", "props").write.parquet(f"{out}/events.parquet")
    return str(out)


@pytest.mark.parametrize("query", [q_model.q_model_kpi_summary, q_model.q_model_scored_table, q_model.q_model_selection])
def test_a_failed_fit_is_no_result(spark, events_dir, monkeypatch, query):
    """With one of the two models missing, the other one would be reported as the selected model."""
    def broken(_):
        raise ValueError("no")
    monkeypatch.setattr(q_model, "_FITTERS", {"random_forest": broken, "logistic_regression": md.fit_logreg})
    with pytest.raises(RuntimeError, match="random_forest"):
        query(spark, events_dir).collect()


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    """Levels of deep trees do not walk from the roots again, and the trees are those that such walks give."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    rng = random.Random(7)
    data = [(i, int(rng.random() < 0.3 + 0.4 * (i % 3 == 0)), float(i % 3), rng.random(), rng.random()) for i in range(1_200)]
    rows, columns = spark.createDataFrame(data, "txn_id long, is_fraud int, a double, b double, c double"), ["a", "b", "c"]
    own = md.fit_random_forest(rows, columns, fast=True).stages[-1]
    assert own.getCacheNodeIds()
    walked = Pipeline(stages=[md._assembler(columns), RandomForestClassifier(
        labelCol="is_fraud", featureSubsetStrategy="sqrt", seed=42, **md.RF_FAST)]).fit(md._training_rows(rows, columns)).stages[-1]
    assert own.toDebugString.split("\n", 1)[1] == walked.toDebugString.split("\n", 1)[1] and own.totalNumNodes > 40
