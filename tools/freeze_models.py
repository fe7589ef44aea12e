"""Fit small models on the events fixture and freeze them beside riskframe/models.

Usage: python tools/freeze_models.py [sf_dir]
Numbers are kept to six digits; the forest and the boosted trees are small, as they end up as SQL text.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def rounded(x):
    if isinstance(x, float):
        return float(f"{x:.6g}")
    if isinstance(x, list):
        return [rounded(v) for v in x]
    return x


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.sql import functions as F

    from riskframe.config import DEFAULT
    from riskframe.models.compiled import as_json, compiled
    from riskframe.operators import features as fe
    from riskframe.operators import model as md
    from riskframe.session import cached, local_session
    from riskframe.sources.fixtures import events_transactions
    spark = local_session()
    features = cached(fe.build_features(events_transactions(spark, sf_dir)))
    train_end, _, _ = md.split_steps(features)
    train = features.where(F.col("step") <= train_end)
    rows, columns = md._training_rows(train, fe.MODEL_COLUMNS), fe.MODEL_COLUMNS
    trees = dict(labelCol="is_fraud", seed=DEFAULT.seed, minInstancesPerNode=20)
    models = {"logreg": md.fit_logreg(train),
              "forest": Pipeline(stages=[md._assembler(columns), RandomForestClassifier(numTrees=8, maxDepth=4, **trees)]).fit(rows),
              "boosted": Pipeline(stages=[md._assembler(columns), GBTClassifier(maxIter=6, maxDepth=3, **trees)]).fit(rows)}
    for name, model in models.items():
        plain = {k: rounded(v) for k, v in json.loads(as_json(compiled(model, columns))).items()}
        (ROOT / "riskframe" / "models" / f"{name}.json").write_text(json.dumps(plain) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
