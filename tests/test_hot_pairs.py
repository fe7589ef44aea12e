"""Hot pairs are looked for among the rows of hot origins."""
import random

from riskframe.config import RiskConfig
from riskframe.operators import features as fe


def _rows(spark, hot_origin: bool):
    rng = random.Random(11)
    out = []
    for i in range(400):
        orig = "C1" if hot_origin and i % 4 == 0 else rng.choice([None, *(f"C{k}" for k in range(2, 40))])
        dest = "C7" if i % 3 else rng.choice([None, "C8", "M9"])
        out.append((i, 1 + i // 9 if i % 50 else None, rng.choice(["PAYMENT", "TRANSFER"]), f"{rng.randrange(1, 9000)}.50", orig, dest, i % 2))
    return spark.createDataFrame(out, "txn_id long, step int, txn_type string, a string, name_orig string, name_dest string, is_fraud int") \
        .selectExpr("txn_id", "step", "txn_type", "CAST(a AS DECIMAL(18,2)) AS amount", "name_orig", "name_dest", "is_fraud")


def _table(df):
    return {r["txn_id"]: [round(v, 6) if isinstance(v, float) else v for v in r] for r in df.collect()}


def test_hot_pairs_of_hot_origins_are_split(spark, monkeypatch):
    rows, split = _rows(spark, True), RiskConfig(hot_key_rows=30, history_block=4)
    seen, was = {}, fe.hot_keys

    def counted(source, keys, cfg):
        hot, n = was(source, keys, cfg)
        seen[tuple(keys)] = n
        return hot, n
    monkeypatch.setattr(fe, "hot_keys", counted)
    got = _table(fe.build_features(rows, split))
    assert seen[("name_orig", "name_dest")] == 1 and seen[("name_orig",)] >= 1 and seen[("name_dest",)] >= 1
    assert got == _table(fe.build_features(rows))


def test_pairs_are_not_counted_without_a_hot_origin(spark, monkeypatch):
    rows, split = _rows(spark, False), RiskConfig(hot_key_rows=30, history_block=4)
    tables, was = [], fe.materialized

    def named(df, name):
        tables.append((name, df.columns))
        return was(df, name)
    monkeypatch.setattr(fe, "materialized", named)
    out = fe.build_features(rows, split)
    assert [name for name, _ in tables].count("hot-keys") == 2  # origins and destinations
    assert _table(out) == _table(fe.build_features(rows))


def test_rows_are_dealt_without_a_second_copy_of_a_hot_key(spark):
    rows = _rows(spark, True).drop("is_fraud")
    out = fe.history(rows, ["name_dest"], RiskConfig(hot_key_rows=30, history_block=4), prefix="d", ranges={"v": (24, 1, "count")})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    after = plan[:plan.rindex(windows[-1]) + len(windows[-1])].splitlines()  # what stands on the layout by chunk
    assert windows and not any("_hot#" in line for line in after)
