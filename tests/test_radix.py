import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import radix
from riskframe.functions.ordered import exact_quantiles
from riskframe.plans.inspect import plan_text

ODD = [0.0, -0.0, 1.5, -1.5, float("inf"), float("-inf"), float("nan"), 5e-324, -5e-324, 1e308, -1e308, 1.0, 1.0 + 2 ** -52]


def test_keys_keep_the_order_and_the_value():
    v = np.array(ODD)
    keys = radix.keys_of(v)
    order = sorted(range(len(ODD)), key=lambda i: (math.isnan(ODD[i]), 0.0 if math.isnan(ODD[i]) else ODD[i]))
    assert all(keys[a] <= keys[b] for a, b in zip(order, order[1:]))
    assert keys[0] == keys[1] and all(radix.value_of(int(k)) == x or math.isnan(x) for k, x in zip(keys, ODD))


def _frame(spark, n=4000, seed=0):
    rng = np.random.default_rng(seed)
    cols = {"few": rng.integers(0, 4, n).astype(float), "money": rng.lognormal(5, 2, n).round(2), "wide": rng.normal(size=n) * 1e6,
            "close": 1 + rng.integers(0, 50, n) * 2.0 ** -50, "same": np.full(n, 7.25)}
    rows = [(str(rng.integers(3)), *(None if (i + j) % 11 == 0 else float(c[i]) for j, c in enumerate(cols.values()))) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{c} double" for c in cols)).repartition(7)
    return df, rows, list(cols)


QS = [0.0, 0.01, 0.5, 0.77, 0.99, 1.0]


@pytest.mark.parametrize("whole, driver", [(4_000_000, 1 << 18), (3, 1 << 18), (3, 2)])  # 3: sixteen bits a pass, down to whole keys
def test_quantiles_equal_numpy(spark, monkeypatch, whole, driver):
    monkeypatch.setattr(radix, "_WHOLE_ROWS", whole)
    monkeypatch.setattr(radix, "_DRIVER_COUNTS", driver)  # 2: positions are found by a join
    df, rows, cols = _frame(spark)
    for group in (None, F.col("g")):
        found = radix.profiles(df, cols, QS, group)
        for (c, g), p in found.items():
            v = np.array([r[1 + cols.index(c)] for r in rows if r[1 + cols.index(c)] is not None and (not g or r[0] == g)])
            assert p.n == len(v) and p.zeros == (v == 0).sum() and math.isclose(p.total, v.sum(), rel_tol=1e-9)
            for q in QS:
                pos = q * (len(v) - 1)
                s, lo, hi = np.sort(v), math.floor(pos), math.ceil(pos)
                assert p.quantiles[q] == (s[lo] if lo == hi else s[lo] + (s[hi] - s[lo]) * (pos - lo))


def test_the_same_as_the_ordered_form(spark):
    df, _, _ = _frame(spark, 1500, 3)
    a = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "money", QS, ["g"]).collect()}
    b = {(r["g"], r["q"]): r["value"] for r in radix.quantile_rows(df, ["money"], QS, "g").collect()}
    assert a == b


def test_odd_values_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, x) for x in [*ODD, None]] + [(None, 3.0), (2, None)], "k int, x double")
    found = radix.profiles(df, ["x"], [0.0, 1.0], F.col("k").cast("string"))
    assert set(found) == {("x", "1")}
    p = found["x", "1"]
    assert p.n == len(ODD) and p.zeros == 2 and p.quantiles[0.0] == -math.inf and math.isnan(p.quantiles[1.0])
    assert radix.profiles(df.where("false"), ["x"], [0.5]) == {}
    assert radix.quantile_rows(df.where("false"), ["x"], [0.5], "k").count() == 0
    typed = radix.quantile_rows(df, ["x"], [0.5], "k")
    assert dict(typed.dtypes)["k"] == "int"


def test_too_many_targets_are_refused(spark, monkeypatch):
    monkeypatch.setattr(radix, "_MOST_TARGETS", 4)
    with pytest.raises(radix.TooManyTargets):
        radix.profiles(spark.range(9).withColumn("g", F.col("id").cast("string")), ["id"], [0.5], F.col("g"))


def test_rows_are_neither_unpivoted_nor_shuffled_whole(spark):
    df, _, cols = _frame(spark, 500)
    text = plan_text(radix._histogram(df, cols, None, 16, None))
    assert "Generate" not in text and text.count("MapInArrow") == 1
    assert text.count("Exchange hashpartitioning(col") == 1
