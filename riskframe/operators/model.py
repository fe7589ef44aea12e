"""Chronological split and MLlib models (M1-M5, M3w, M11-M12, I1-I3)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import DEFAULT, RiskConfig
from riskframe.functions.derive import dbl, pct
from riskframe.operators.analysis import split_boundaries

log = logging.getLogger(__name__)


class SplitError(ValueError):
    pass


def split_steps(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> tuple[int, int, int]:
    """Boundaries (train_end, validation_end, last_step): two ints collected from a <= #steps table."""
    b = split_boundaries(txns, cfg).first()
    if b is None or b["test_end_step"] is None:
        raise SplitError("no rows to split")
    train_end = b["train_end_step"]
    if train_end is None:
        raise SplitError("training split is empty: the first step already exceeds the train fraction")
    val_end = b["validation_end_step"] if b["validation_end_step"] is not None else train_end
    return int(train_end), int(val_end), int(b["test_end_step"])


def split_column(train_end: int, val_end: int, step: str = "step"):
    s = F.col(step)
    return F.when(s <= train_end, "train").when(s <= val_end, "validation").otherwise("test")


def time_split(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """M1: label rows train/validation/test by step (never cutting a step); summary per split."""
    train_end, val_end, _ = split_steps(txns, cfg)
    labelled = txns.withColumn("split", split_column(train_end, val_end))
    summary = split_summary(labelled, train_end, val_end)
    return labelled, summary


def split_summary(labelled: DataFrame, train_end: int, val_end: int) -> DataFrame:
    g = labelled.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("is_fraud").cast("bigint").alias("fraud"),
                                      F.min("step").alias("first_step"), F.max("step").alias("last_step"))
    tot = labelled.agg(F.count(F.lit(1)).alias("_all"))
    return g.crossJoin(tot).select(
        "split", "rows", pct("rows", "_all").alias("row_pct"), "fraud", pct("fraud", "rows").alias("fraud_rate_pct"),
        "first_step", "last_step", F.lit(train_end).alias("train_end_step"), F.lit(val_end).alias("validation_end_step"))


def split_guard(summary: DataFrame) -> DataFrame:
    """M2: a split with zero fraud makes its metrics meaningless; raise like the pipeline stops."""
    bad = summary.where(F.col("split").isin("validation", "test") & (F.col("fraud") == 0)).select("split").collect()
    if bad:
        raise SplitError(f"split(s) without fraud: {[r['split'] for r in bad]}")
    return summary.withColumn("usable", F.lit(True))


# ---------------------------------------------------------------------------
# MLlib models.  Features go through fill_missing (DOUBLE, NULL -> 0) and a
# VectorAssembler; the Vector type exists only at the model boundary.
# ---------------------------------------------------------------------------

from pyspark.ml import Pipeline, PipelineModel  # noqa: E402
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier  # noqa: E402
from pyspark.ml.feature import StandardScaler, VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from riskframe.models.compiled import Linear, changed_nodes, changed_scores, compiled, linear_terms, score, score_parts  # noqa: E402
from riskframe.operators.features import MODEL_COLUMNS, fill_missing  # noqa: E402

RF_FULL = dict(numTrees=120, maxDepth=14, minInstancesPerNode=40, subsamplingRate=1.0)
RF_FAST = dict(numTrees=40, maxDepth=10, minInstancesPerNode=100, subsamplingRate=0.3)  # opt-in
GBT_PARAMS = dict(maxIter=300, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8")


def stable_layout(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fix row layout before fitting so a seeded model is repeatable (range on txn_id, sorted)."""
    by = (partitions, "txn_id") if partitions else ("txn_id",)  # else spark.sql.shuffle.partitions, sized by AQE
    return df.repartitionByRange(*by).sortWithinPartitions("txn_id")


_OWN_LAYOUT_ROWS = 50_000   # up to so many training rows, the session's shuffle partitions stand
_FIT_TASK_ROWS = 1_000_000  # a task of a fit holds about so many rows at most


def fit_partitions(rows: int, cores: int) -> int | None:
    """Partitions of a fit's input: one a core, or a whole multiple where a task would hold too many rows.

    A fit is hundreds of short jobs, and in a tree fit every task sends the
    dense statistics of all open nodes at each level. Both grow with the
    partitions, and the nodes with the rows, so partitions that grow with the
    rows as well make a fit's time grow with their square."""
    if rows <= _OWN_LAYOUT_ROWS:
        return None
    return cores * -(-rows // (cores * _FIT_TASK_ROWS))


def _training_rows(train: DataFrame, columns) -> DataFrame:
    """The filled model input in a fixed layout, persisted: every fit passes over it many times."""
    from riskframe.session import cached
    keep = [c for c in train.columns if c in {"txn_id", "is_fraud", "class_weight", *columns}]
    partitions = fit_partitions(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    return cached(stable_layout(fill_missing(train.select(*keep), list(columns)), partitions))


def class_weights(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """M3w: 'balanced' weights n / (2 * n_class) as a column (small per-class table, broadcast)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = rows.agg(F.count(F.lit(1)).alias("_n"))
    w = counts.crossJoin(total).select(label, (dbl("_n") / (F.lit(2.0) * dbl("_nc"))).alias("class_weight"))
    return rows.join(F.broadcast(w), label)


def _assembler(columns):
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def fit_logreg(train: DataFrame, columns=MODEL_COLUMNS, weight_col: str | None = None,
               cfg: RiskConfig = DEFAULT) -> PipelineModel:
    """M3: standardise (mean and std) then L2 logistic regression, C = 1 expressed as regParam = 1 / n."""
    data = _training_rows(train, columns)
    n = data.count()
    # tol 1e-4 is the reference solver's default stopping tolerance (MLlib's own default is 1e-6)
    lr = LogisticRegression(featuresCol="scaled", labelCol="is_fraud", regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                            standardization=False, maxIter=1000, tol=1e-4, **({"weightCol": weight_col} if weight_col else {}))
    pipe = Pipeline(stages=[_assembler(columns), StandardScaler(inputCol="features", outputCol="scaled",
                                                                withMean=True, withStd=True), lr])
    return pipe.fit(data)


def fit_random_forest(train: DataFrame, columns=MODEL_COLUMNS, fast: bool = False, weight_col: str | None = None,
                      cfg: RiskConfig = DEFAULT) -> PipelineModel:
    """M4: random forest, sqrt feature subsets, seeded; `fast` mirrors the reduced configuration.

    A row's nodes are kept from level to level: without them each pass walks all trees from their roots again,
    which in deep trees takes most of the time.  The fitted trees are the same."""
    p = RF_FAST if fast else RF_FULL
    rf = RandomForestClassifier(labelCol="is_fraud", featureSubsetStrategy="sqrt", seed=cfg.seed, cacheNodeIds=True, **p,
                                **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[_assembler(columns), rf]).fit(_training_rows(train, columns))


def fit_gbt(train: DataFrame, columns=MODEL_COLUMNS, max_iter: int | None = None, weight_col: str | None = None,
            cfg: RiskConfig = DEFAULT) -> PipelineModel:
    """M5: gradient-boosted trees (MLlib's GBT, not XGBoost: a different algorithm with the same knobs)."""
    p = dict(GBT_PARAMS)
    if max_iter is not None:
        p["maxIter"] = max_iter
    gbt = GBTClassifier(labelCol="is_fraud", seed=cfg.seed, **p, **({"weightCol": weight_col} if weight_col else {}))
    return Pipeline(stages=[_assembler(columns), gbt]).fit(_training_rows(train, columns))


def fit_all(train: DataFrame, fitters: dict, required: Iterable[str] = ()) -> dict[str, PipelineModel]:
    """Models by name; a fit that fails is logged and left out.  Raises if none is left, or if a required one failed:
    a comparison without it would look like one that it lost."""
    models = {}
    for name, fit in fitters.items():
        try:
            models[name] = fit(train)
        except Exception as e:  # noqa: BLE001 - one optional model's failure must not cost the others
            if name in required:
                raise RuntimeError(f"fitting {name} failed") from e
            log.exception("fitting %s failed", name)
    if not models:
        raise RuntimeError(f"no model could be fitted: {list(fitters)}")
    return models


def select_model(models: dict[str, PipelineModel], validation: DataFrame, columns=MODEL_COLUMNS,
                 cfg: RiskConfig = DEFAULT) -> tuple[str, DataFrame]:
    """M9: the name of the model with the best validation PR-AUC, and the comparison table."""
    from riskframe.operators.ranking import compare_models
    rows = validation.select("txn_id", "is_fraud", *columns)
    out = None
    for name, m in models.items():
        s = score_rows(m, rows, columns).select(F.lit(name).alias("model"), "score", "is_fraud")
        out = s if out is None else out.unionByName(s)
    table = compare_models(out, cfg=cfg)
    return table.where("selection_rank = 1").first()["model"], table


def score_rows(model: PipelineModel, rows: DataFrame, columns=MODEL_COLUMNS, score_col: str = "score") -> DataFrame:
    """P(fraud) per row."""
    out = model.transform(fill_missing(rows, list(columns)))
    keep = [c for c in rows.columns]
    return out.select(*keep, vector_to_array("probability")[1].alias(score_col))


def builtin_importance(model: PipelineModel, columns=MODEL_COLUMNS) -> DataFrame:
    """Impurity importance for trees, |standardised coefficient| for LR (a <= #features table)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals, kind = last.featureImportances.toArray().tolist(), "impurity_decrease"
    else:
        vals, kind = [abs(x) for x in last.coefficients.toArray().tolist()], "absolute_standardised_coefficient"
    return spark.createDataFrame([(c, float(v), kind) for c, v in zip(columns, vals)],
                                 "feature string, importance double, importance_type string")


def top_importance(importance: DataFrame, k: int = 25) -> DataFrame:
    """T5."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def linear_attribution(model: PipelineModel | Linear, rows: DataFrame, columns=MODEL_COLUMNS) -> DataFrame:
    """Mean |coef_j * (x_j - mean_j) / sd_j| over all rows -- exact SHAP for a linear model
    with independent features, as one distributed aggregate (no sampling, no per-row library)."""
    plain = model if isinstance(model, Linear) else compiled(model, columns)
    terms = linear_terms(plain)
    wide = rows.agg(*[F.avg(F.abs(F.expr(terms[c]) if c in terms else F.lit(0.0))).alias(c) for c in plain.columns])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs_attribution"))
                                           for c in plain.columns])).alias("s")).select("s.*")


_GIVEN_ROWS = 2_000  # rows of a batch that carries all new values


def _permuted(columns: list[str], pairs: list[tuple[str, int]], shared: bool):
    """Batches of (bucket, hashes, txn_id, is_fraud, columns), sorted by bucket and txn_id (nulls last) -> the rows that have
    a txn_id, with `given`: for each pair, the value that falls to the row in the order of the pair's hash.

    shared: rows of one txn_id all get the first of their values in the order of (pair, value)."""
    at = {c: 3 + i for i, c in enumerate(["is_fraud", *columns])}

    def bucket(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes = rows.column(1).combine_chunks().flatten().to_numpy().reshape(-1, len(pairs))
        values = {c: rows.column(at[c]).to_numpy() for c in columns}
        n = rows.num_rows - rows.column(2).null_count
        given = np.empty((n, len(pairs)))
        for i, (c, _) in enumerate(pairs):
            given[:, i] = values[c][np.lexsort((values[c], hashes[:, i]))][:n]
        if shared and n:
            ids = rows.column(2).slice(0, n).to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
            for a, b in zip(edges[:-1][np.diff(edges) > 1], edges[1:][np.diff(edges) > 1]):
                given[a:b] = np.sort(given[a:b], axis=0).T.ravel()[:len(pairs)]
        for first in range(0, n, _GIVEN_ROWS):
            part = rows.slice(first, min(_GIVEN_ROWS, n - first)).select(range(2, rows.num_columns)).combine_chunks()
            flat = given[first:first + part.num_rows].ravel()
            ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(pairs))
            yield from part.append_column("given", pa.ListArray.from_arrays(ends, pa.array(flat))).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            own = batch.column(0).to_numpy()
            ends = [*(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), batch.num_rows]
            first = 0
            for end in ends:
                if first < end:
                    if held and held[-1].column(0)[0] != batch.column(0)[first]:
                        yield from bucket(pa.Table.from_batches(held))
                        held = []
                    held.append(batch.slice(first, end - first))
                first = end
        if held:
            yield from bucket(pa.Table.from_batches(held))

    return run


def _dealt(x: DataFrame, columns: list[str], pairs: list[tuple[str, int]], buckets: int, shared: bool, cfg: RiskConfig) -> DataFrame:
    """x's rows with `given`, an array of the new value of each (feature, repeat)."""
    x = x.select("txn_id", "is_fraud", *[dbl(c).alias(c) for c in columns])
    parts = max(min(buckets, 2 * x.sparkSession.sparkContext.defaultParallelism), buckets // 8)  # a row grows after this: not by its bytes
    dealt = x.withColumn("pb", F.pmod(F.xxhash64("txn_id", F.lit(cfg.seed + 1)), F.lit(buckets))).repartition(parts, "pb")
    dealt = dealt.sortWithinPartitions("pb", F.col("txn_id").asc_nulls_last(), "is_fraud", *columns)
    # hashed after the rows are dealt and sorted, so that no hash is shuffled
    hashes = F.array(*[F.xxhash64("txn_id", F.lit(i), F.lit(cfg.seed)) for i in range(len(pairs))])
    schema = T.StructType([*x.schema.fields, T.StructField("given", T.ArrayType(T.DoubleType()))])
    return dealt.select("pb", hashes.alias("hashes"), *x.columns).mapInArrow(_permuted(columns, pairs, shared), schema)


def permutation_importance(model: PipelineModel, rows: DataFrame, columns=MODEL_COLUMNS, repeats: int = 3,
                           sample_fraction: float | None = None, bucket_rows: int = 20_000, most_nodes: int = 1_000,
                           cfg: RiskConfig = DEFAULT) -> DataFrame:
    """AP drop when one feature is shuffled, over all rows (sample_fraction: a hash sample of both classes, opt-in).

    A feature is permuted inside random buckets of about bucket_rows rows, by
    the order of a hash of (txn_id, feature, repeat, seed), so a retried task
    gives the same permutation.  Rows are dealt by bucket once, and a task holds
    one bucket while its rows get their new values.  A linear model, and trees
    whose changes take up to most_nodes nodes (more would not compile), are
    scored by what a new value changes: the margin by one term, the sum of
    trees by those that use the feature.  Larger forests are scored on a wide
    copy of the row for each value.
    """
    from riskframe.operators.ranking import ranking_metrics
    columns = list(columns)
    x = fill_missing(rows.select("txn_id", "is_fraud", *columns), columns)
    if sample_fraction is not None:
        x = x.where(F.pmod(F.xxhash64("txn_id", F.lit(cfg.seed)), F.lit(1_000_000)) < F.lit(int(sample_fraction * 1_000_000)))
    buckets = -(-x.count() // bucket_rows) or 1
    pairs = [(c, r) for c in columns for r in range(repeats)]
    plain = compiled(model, columns)
    by_change = changed_nodes(plain, [c for c, _ in pairs]) <= most_nodes
    met = _dealt(x, columns, pairs, buckets, by_change, cfg)
    if by_change:
        base = x.select("is_fraud", score(plain).alias("score"))
        given = {i: F.col("given")[i] for i in range(len(pairs))}
        scores = F.array(*[F.struct(F.lit(i).alias("pair"), s.alias("score")) for i, s in
                           changed_scores(plain, [(c, given[i]) for i, (c, _) in enumerate(pairs)]).items()])
        # the margin, or the trees' sums, once a row; then each score from what its one feature changes
        with_parts = met.select("is_fraud", "given", *columns, *score_parts(plain))
        scored = with_parts.select("is_fraud", F.explode(scores).alias("s")).select("is_fraud", "s.pair", "s.score")
    else:
        wide = met.select("is_fraud", *columns, F.posexplode("given").alias("pair", "v"))
        of = {c: [i for i, (f, _) in enumerate(pairs) if f == c] for c in columns}
        wide = wide.select("is_fraud", "pair", *[F.when(F.col("pair").isin(of[c]), F.col("v")).otherwise(F.col(c)).alias(c) for c in columns])
        scored = model.transform(wide).select("pair", "is_fraud", vector_to_array("probability")[1].alias("score"))
        base = model.transform(x).select("is_fraud", vector_to_array("probability")[1].alias("score"))
    base_ap = ranking_metrics(base, cfg=cfg).select(F.col("pr_auc").alias("base_ap"))
    ap = ranking_metrics(scored, group_cols=["pair"], cfg=cfg)
    name = F.element_at(F.array(*[F.lit(c) for c, _ in pairs]), F.col("pair") + 1)
    drop = ap.crossJoin(base_ap).select(name.alias("feature"), (F.col("base_ap") - F.col("pr_auc")).alias("d"))
    return drop.groupBy("feature").agg(F.avg("d").alias("pr_auc_drop_when_shuffled"), F.stddev_pop("d").alias("std"))


LEAKAGE_DEMO_COLUMNS = ["old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest", "is_flagged_fraud"]
