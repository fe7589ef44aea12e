import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, is_anchor):
    """Brute force over rows: every row is its own, whatever it equals."""
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in filter(usable, rows)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, v, label) in enumerate(rows):
        if not is_anchor(i):
            continue
        others = [(-score(v, w), j, m) for k, (j, w, m) in enumerate(rows) if k != n]
        for p, j, m in sorted(o for o in others if o[2] == label)[:5]:
            fit = [(s, k) for s, k, m in sorted(others) if m != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def made(spark, rows, every, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("key", F.lit(1)).withColumn("cell", F.lit(2))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % every == 0, **kwargs).collect())


def clustered(seed, n, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [(int(i), (centres[rng.integers(4)] + 0.4 * rng.normal(size=width)).round(3).tolist(), int(rng.integers(3)))
            for i in rng.permutation(n)]


@pytest.mark.parametrize("seed,stripe", [(0, 1 << 12), (1, 9)])
def test_equals_brute_force_over_many_stripes(spark, seed, stripe):
    rows = clustered(seed, 300)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert made(spark, rows, 10, stripe_rows=stripe) == want


def test_nulls_ties_repeats_zero_vectors_and_ragged_lengths(spark):
    random.seed(3)
    rows = [(i, [float(random.randint(-1, 2)) for _ in range(3)], random.randint(0, 1)) for i in range(60)]
    rows += rows[:12] + rows[:6]                                  # equal rows
    rows += [(5, [1.0, 1.0, 1.0], 0), (5, [1.0, 1.0, 1.0], 1)]    # one id, other rows
    rows += [(70, [0.0, 0.0, 0.0], 0), (75, [2.0], 1), (80, [1.0, 2.0, 0.0, 3.0], 0), (85, [], 1)]
    rows += [(90, None, 0), (95, [1.0, None, 1.0], 0), (100, [1.0, float("nan"), 0.0], 1), (105, [float("inf"), 0.0, 0.0], 1),
             (110, [1.0, 0.0, 0.0], None), (None, [1.0, 0.0, 1.0], 0)]
    want = plain(rows, lambda i: i % 5 == 0)
    assert want and made(spark, rows, 5, stripe_rows=16) == want


def test_tables_without_result(spark):
    assert made(spark, [], 1) == []
    assert made(spark, [(1, [1.0], 0)], 1) == []
    assert made(spark, [(1, [0.0, 0.0], 0), (2, [0.0, 0.0], 0), (3, [0.0, 0.0], 1)], 1) == [(1, 2, 1, 3, 0, 0), (2, 1, 1, 3, 0, 0)]


def test_scores_beyond_doubles_are_exact(spark):
    big = float(1 << 22)
    rows = [(i, [big + i, big - i, 1.0], i % 2) for i in range(24)]
    want = plain(rows, lambda i: i % 4 == 0)
    assert made(spark, rows, 4) == want


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(0)
    q = np.floor(256 * rng.normal(size=(400, 8)))
    q[7] = 0
    q[9] = q[8] * 3
    refs = negatives.references(q[:200])
    angles, norms = negatives.angles_to(q, refs)
    true = q @ q.T
    out = 0
    for a in range(0, 400, 7):
        least, most = negatives.bounds(angles.T, norms, angles[a], norms[a])
        assert (least <= true[a]).all() and (true[a] <= most).all()
        out += int((most < 0.9 * norms[a] * norms).sum())
    assert out > 1000  # the bounds rule out most rows for a high window


def test_cells_never_rule_out_a_wanted_row(spark):
    rows = clustered(5, 200)
    df = spark.createDataFrame(rows, SCHEMA).select(F.col("vec_id").alias("id"), F.col("label").cast("long"),
                                                    F.col("embedding").alias("vec"), F.lit(1).cast("long").alias("copies"))
    refs = negatives.references(np.array([r[1] for r in rows[:50]]))
    index = negatives.indexed(df, refs).cache()
    cells = negatives.Cells.of(index, len(refs), 8)
    held = index.withColumn("stripe", cells.stripe_column()).collect()
    q = {r["id"]: np.frombuffer(r["q"], "<f8") for r in held}
    for a in held[:40]:
        for lo, hi in ((5000, 20000), (200000, 300000), (-50000, -20000)):
            to = set(cells.reached(np.array(a["angles"]), a["norm"], lo, hi))
            assert all(b["stripe"] in to for b in held if lo <= q[a["id"]] @ q[b["id"]] <= hi)
