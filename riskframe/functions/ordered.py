"""Global order without a single-task window.

`Window.orderBy(x)` with no partition key runs in one task.  Everything that
needs a rank or a running total over a whole column (quantiles, AP, ROC-AUC,
top-K capture, curve points) goes through `cumulative`:

  1. pre-aggregate to distinct (group, value) -- ties collapse, a value shared
     by a third of all rows becomes one row;
  2. put the distinct values into buckets of about `order_bucket_rows`.  Edges
     only place buckets and never change results, so they come from a hash
     sample of the distinct values, sized to the number of edges.  One level
     has at most `order_fanout` buckets; where more are needed, every bucket is
     cut again by edges from its own sample, level by level, without a cap;
  3. prefix-sum the (group, bucket) totals and join them back;
  4. finish with a window partitioned by (group, bucket).

Ties share a bucket because the bucket is a function of the value, so results
are exact.  NULL values are dropped; NaN sorts above every number, as in Spark.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, RiskConfig
from riskframe.session import cached, small_table

_PER_EDGE = 64  # sampled values per edge
_DEEP_FANOUT = 64  # buckets that a bucket is cut into on deeper levels


def _sampled(dv: DataFrame, value: str, keep_one_in: int) -> DataFrame:
    """A share of the distinct values, chosen by hash; NaN and infinities place no edge."""
    v = F.col(value).cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    return dv.where(finite & (F.pmod(F.xxhash64(value), F.lit(max(1, keep_one_in))) == 0))


def _with_bucket(dv: DataFrame, value_col: str, cfg: RiskConfig) -> DataFrame:
    """dv with `__bk`, a bigint that grows with the value; about order_bucket_rows distinct values share one."""
    n = dv.count()
    need = math.ceil(n / max(cfg.order_bucket_rows, 1))
    if need <= 1:
        return dv.withColumn("__bk", F.lit(0).cast("long"))
    k = min(need, cfg.order_fanout)
    rows = _sampled(dv, value_col, n // (_PER_EDGE * k)).select(F.col(value_col).cast("double").alias("v")).collect()
    values = sorted(r["v"] for r in rows)  # about _PER_EDGE * order_fanout doubles
    edges = sorted({values[i * len(values) // k] for i in range(1, k)}) if values else []
    if not edges:
        return dv.withColumn("__bk", F.lit(0).cast("long"))
    # NaN goes to a bucket of its own above all others
    tmp = dv.withColumn("__dbl", F.col(value_col).cast("double"))
    dv = (Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="__dbl", outputCol="__b", handleInvalid="keep")
          .transform(tmp).withColumn("__bk", F.col("__b").cast("long")).drop("__dbl", "__b"))
    need = math.ceil(need / k)
    while need > 1:  # cut every bucket again, by edges from its own sample
        k = min(need, _DEEP_FANOUT)
        buckets = dv.agg(F.count_distinct("__bk")).first()[0]
        own = _sampled(dv, value_col, n // (_PER_EDGE * k * buckets)).groupBy("__bk").agg(
            F.sort_array(F.collect_list(F.col(value_col).cast("double"))).alias("s"))
        at = [F.get("s", (F.size("s") * i / k).cast("int")) for i in range(1, k)]
        own = own.select(F.col("__bk").alias("__of"), F.array(*at).alias("__e"))
        own, _ = small_table(cached(own), F.size("__e"))  # broadcast while small, so rows are not dealt by bucket
        inside = F.size(F.filter("__e", lambda e: e <= F.col(value_col).cast("double")))
        dv = (dv.join(own, F.col("__bk") == F.col("__of"), "left")
              .withColumn("__bk", F.col("__bk") * (k + 1) + F.when(F.col("__e").isNull(), 0).otherwise(inside))
              .drop("__of", "__e"))
        need = math.ceil(need / k)
    return dv


def _bucketed(df: DataFrame, value_col: str, measures: dict[str, Column], g: list[str],
              cfg: RiskConfig) -> tuple[DataFrame, DataFrame]:
    """Distinct (group, value) rows with measure sums, `d` = 1 and bucket, and per (group, bucket) the sums before it
    (`__off_<m>`), in it (`__b_<m>`) and of the group (`tot_<m>`)."""
    dv = (df.where(F.col(value_col).isNotNull())
          .groupBy(*g, value_col).agg(*[F.sum(c).alias(m) for m, c in measures.items()])
          .withColumn("d", F.lit(1).cast("long")))
    # read by the count, the sample and the final plan: computed once (persisted blocks are rebuilt from lineage)
    dv = _with_bucket(cached(dv), value_col, cfg)
    names = [*measures, "d"]
    bt = dv.groupBy(*g, "__bk").agg(*[F.sum(m).alias(f"__b_{m}") for m in names])
    before = Window.partitionBy(*g).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select("*",
                   *[F.coalesce(F.sum(f"__b_{m}").over(before), F.lit(0)).alias(f"__off_{m}") for m in names],
                   *[F.sum(f"__b_{m}").over(Window.partitionBy(*g)).alias(f"tot_{m}") for m in names])
    return dv, bt


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that lets NULL group keys meet; the right side's keys go."""
    named = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in keys]
    return left.join(named, cond).drop(*[f"__r_{c}" for c in keys])


def cumulative(df: DataFrame, value_col: str, measures: dict[str, Column],
               group_cols: list[str] | tuple = (), cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Distinct (group, value) rows with measure sums, ascending inclusive running sums
    `cum_<m>` and per-group totals `tot_<m>`; `cum_d` counts the distinct values.  Rows with a NULL value are dropped."""
    g, names = list(group_cols), [*measures, "d"]
    dv, bt = _bucketed(df, value_col, measures, g, cfg)
    wb = Window.partitionBy(*g, "__bk").orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    out = _on(dv, bt, [*g, "__bk"])
    return out.select(*g, value_col, "__bk", *names,
                      *[(F.col(f"__off_{m}") + F.sum(m).over(wb)).alias(f"cum_{m}") for m in names],
                      *[F.col(f"tot_{m}") for m in names])


def exact_quantiles(df: DataFrame, value_col: str, qs: list[float], group_cols: list[str] | tuple = (),
                    cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Linear-interpolation quantiles (as numpy 'linear'): (group..., q, value).

    value = lo + (hi - lo) * (pos - floor(pos)), pos = q * (n - 1), on DOUBLE
    values.  The bucket of each position comes from the (group, bucket) totals;
    only the rows of those buckets are read, and a position takes the last value
    that starts at or before it, in one ordered pass over rows and positions.
    """
    g = list(group_cols)
    src = df.select(*g, F.col(value_col).cast("double").alias("__v"))
    dv, bt = _bucketed(src, "__v", {"n": F.lit(1).cast("long")}, g, cfg)
    pos = F.col("q") * (F.col("tot_n") - 1).cast("double")
    asked = bt.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    asked = asked.withColumn("pos", pos).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "i", F.when(F.col("side") == 0, F.floor("pos")).otherwise(F.ceil("pos")).cast("long"))
    asked = asked.where((F.col("i") >= F.col("__off_n")) & (F.col("i") < F.col("__off_n") + F.col("__b_n")))
    needed = asked.select(*g, "__bk", "__off_n").distinct()
    wb = Window.partitionBy(*g, "__bk").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    rows = _on(dv, needed, [*g, "__bk"]).select(
        *g, "__bk", (F.col("__off_n") + F.coalesce(F.sum("n").over(wb), F.lit(0))).alias("i"), F.lit(0).alias("asked"),
        F.col("__v").alias("v"), F.lit(None).cast("double").alias("q"), F.lit(None).cast("double").alias("pos"),
        F.lit(None).cast("int").alias("side"))
    points = asked.select(*g, "__bk", "i", F.lit(1).alias("asked"), F.lit(None).cast("double").alias("v"), "q", "pos", "side")
    order = Window.partitionBy(*g, "__bk").orderBy("i", "asked").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionAll(points).withColumn("v", F.last("v", ignorenulls=True).over(order)).where("asked = 1")
    res = found.groupBy(*g, "q").agg(F.first("pos").alias("pos"), F.max(F.when(F.col("side") == 0, F.col("v"))).alias("v_lo"),
                                     F.max(F.when(F.col("side") == 1, F.col("v"))).alias("v_hi"))
    frac = F.col("pos") - F.floor("pos").cast("double")
    val = F.when(frac == 0, F.col("v_lo")).otherwise(F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac)
    return res.select(*g, "q", val.alias("value"))
