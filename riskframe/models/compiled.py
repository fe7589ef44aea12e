"""Fitted MLlib models as SQL expressions.

`compiled(model, columns)` reads a fitted pipeline into plain numbers: a linear
model with its scaling, or weighted trees. `score_sql` writes them as one
expression over the feature columns, valid in Spark SQL and in DuckDB, so a
model scores rows inside whole-stage code, without the Vector type, and the
same text checks it on another engine. `as_json` and `from_json` freeze it.

Numbers are written as casts of their shortest exact decimals, so both engines
read the same doubles; a missing feature counts as 0, as in `fill_missing`.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """The value a tree gives to a row: a probability, or a margin in a boosted model."""
    value: float


@dataclass(frozen=True)
class Split:
    """Rows with feature value <= threshold go left."""
    feature: str
    threshold: float
    left: Split | Leaf
    right: Split | Leaf


@dataclass(frozen=True)
class Linear:
    """sigmoid(intercept + sum of weight * (x - mean) / sd); a feature without spread counts for nothing."""
    columns: tuple[str, ...]
    means: tuple[float, ...]
    sds: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float


@dataclass(frozen=True)
class Trees:
    """Weighted sum of trees; `boosted` sums are margins and go through sigmoid(2 * sum)."""
    columns: tuple[str, ...]
    trees: tuple[Split | Leaf, ...]
    tree_weights: tuple[float, ...]
    importances: tuple[float, ...]  # impurity decrease by column, as fitted
    boosted: bool


Compiled = Linear | Trees


def number(x: float) -> str:
    """A double as SQL text that both engines read back exactly."""
    if not math.isfinite(x):
        raise ValueError(f"not a finite number: {x}")
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def value(column: str) -> str:
    """A feature as both engines read it; anything but a name is taken as it is."""
    return f"COALESCE(CAST({column} AS DOUBLE), {number(0.0)})"


def _sigmoid(sql: str) -> str:
    return f"({number(1.0)} / ({number(1.0)} + exp(-({sql}))))"


def _tree(node: Split | Leaf) -> str:
    if isinstance(node, Leaf):
        return number(node.value)
    return (f"CASE WHEN {value(node.feature)} <= {number(node.threshold)} THEN {_tree(node.left)} "
            f"ELSE {_tree(node.right)} END")


def linear_terms(model: Linear) -> dict[str, str]:
    """feature -> SQL of its part of the margin."""
    return {c: f"{number(w)} * (({value(c)} - {number(m)}) / {number(s)})"
            for c, m, s, w in zip(model.columns, model.means, model.sds, model.weights) if s and w}


def margin_sql(model: Linear) -> str:
    return " + ".join([number(model.intercept), *linear_terms(model).values()])


def score_sql(model: Compiled) -> str:
    """P(fraud) as one SQL expression over the model's columns."""
    if isinstance(model, Linear):
        return _sigmoid(margin_sql(model))
    total = " + ".join(f"{number(w)} * ({_tree(t)})" for w, t in zip(model.tree_weights, model.trees)) or number(0.0)
    return _sigmoid(f"{number(2.0)} * ({total})") if model.boosted else f"({total})"


def score(model: Compiled) -> Column:
    return F.expr(score_sql(model))


def used_columns(node: Split | Leaf) -> frozenset[str]:
    """Features that a tree splits on."""
    if isinstance(node, Leaf):
        return frozenset()
    return used_columns(node.left) | used_columns(node.right) | {node.feature}


def tree_nodes(node: Split | Leaf) -> int:
    return 1 if isinstance(node, Leaf) else 1 + tree_nodes(node.left) + tree_nodes(node.right)


def changed_nodes(model: Compiled, features: list[str]) -> int:
    """Nodes that `changed_scores` writes out for one change of each feature; 0 for a linear model."""
    if isinstance(model, Linear):
        return 0
    return sum(tree_nodes(t) * sum(f in used_columns(t) for f in features) for t in model.trees)


# ------------------------------------------------------------------ scores of rows with one feature changed


def score_parts(model: Compiled) -> list[Column]:
    """What `changed_scores` starts from: the margin `__m` of a linear model, or each tree's value `__t<i>`."""
    if isinstance(model, Linear):
        return [F.expr(margin_sql(model)).alias("__m")]
    return [F.expr(_tree(t)).alias(f"__t{i}") for i, t in enumerate(model.trees)]


def _tree_column(node: Split | Leaf, feature: str, new: Column) -> Column:
    """A tree's value with one feature replaced."""
    if isinstance(node, Leaf):
        return F.expr(number(node.value))
    tested = F.coalesce(new, F.lit(0.0)) if node.feature == feature else F.expr(value(node.feature))
    return F.when(tested <= F.expr(number(node.threshold)), _tree_column(node.left, feature, new)).otherwise(
        _tree_column(node.right, feature, new))


def changed_scores(model: Compiled, changes: list[tuple[str, Column]]) -> dict[int, Column]:
    """position -> score with one feature's value replaced, over rows that carry `score_parts`.

    A linear margin changes by weight * difference / sd. Of the trees, only those that split on the feature are
    evaluated; the sum runs over all in their order, so rows that tie in the model tie here."""
    one, out = F.lit(1.0), {}
    for i, (feature, new) in enumerate(changes):
        if isinstance(model, Linear):
            total, k = F.col("__m"), model.columns.index(feature)
            if model.sds[k] and model.weights[k]:
                total = total + F.lit(model.weights[k] / model.sds[k]) * (F.coalesce(new, F.lit(0.0)) - F.expr(value(feature)))
            out[i] = one / (one + F.exp(-total))
        else:
            total = None
            for j, (w, tree) in enumerate(zip(model.tree_weights, model.trees)):
                part = F.lit(w) * (_tree_column(tree, feature, new) if feature in used_columns(tree) else F.col(f"__t{j}"))
                total = part if total is None else total + part
            total = F.lit(0.0) if total is None else total
            out[i] = one / (one + F.exp(-F.lit(2.0) * total)) if model.boosted else total
    return out


# ------------------------------------------------------------------ from MLlib


def _node(java, columns: list[str], boosted: bool) -> Split | Leaf:
    """A tree from the JVM's nodes, depth first without recursion on the Java side."""
    if java.subtreeDepth() == 0:
        if boosted:
            return Leaf(float(java.prediction()))
        counts = list(java.impurityStats().stats())
        return Leaf(float(counts[1]) / sum(counts) if sum(counts) else 0.0)
    split = java.split()
    return Split(columns[split.featureIndex()], float(split.threshold()), _node(java.leftChild(), columns, boosted),
                 _node(java.rightChild(), columns, boosted))


def compiled(model: PipelineModel, columns) -> Compiled:
    """A fitted pipeline of this library (logistic regression, random forest or boosted trees) as plain values.

    Splits on categories and multi-class models are refused: the feature table
    has numeric columns and two classes.
    """
    columns, last = list(columns), model.stages[-1]
    if getattr(last, "numClasses", 2) != 2:
        raise ValueError("only models of two classes are compiled")
    if hasattr(last, "coefficients"):
        weights = tuple(map(float, last.coefficients.toArray()))
        scaler = next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)
        means, sds = ((0.0,) * len(columns), (1.0,) * len(columns)) if scaler is None else (
            tuple(map(float, v.toArray())) for v in (scaler.mean, scaler.std))
        return Linear(tuple(columns), means, sds, weights, float(last.intercept))
    if not hasattr(last, "trees"):
        raise ValueError(f"no compiled form for {type(last).__name__}")
    boosted = type(last).__name__.startswith("GBT")
    trees = tuple(_node(t._java_obj.rootNode(), columns, boosted) for t in last.trees)
    weights = tuple(map(float, last.treeWeights)) if boosted else (1.0 / len(trees),) * len(trees)
    return Trees(tuple(columns), trees, weights, tuple(map(float, last.featureImportances.toArray())), boosted)


# ------------------------------------------------------------------ frozen form


def _plain(node: Split | Leaf):
    return node.value if isinstance(node, Leaf) else [node.feature, node.threshold, _plain(node.left), _plain(node.right)]


def _thawed(x) -> Split | Leaf:
    return Split(x[0], x[1], _thawed(x[2]), _thawed(x[3])) if isinstance(x, list) else Leaf(float(x))


def as_json(model: Compiled) -> str:
    if isinstance(model, Linear):
        return json.dumps({"kind": "linear", "columns": model.columns, "means": model.means, "sds": model.sds,
                           "weights": model.weights, "intercept": model.intercept})
    return json.dumps({"kind": "boosted" if model.boosted else "forest", "columns": model.columns,
                       "trees": [_plain(t) for t in model.trees], "tree_weights": model.tree_weights,
                       "importances": model.importances})


def from_json(text: str) -> Compiled:
    d = json.loads(text)
    if d["kind"] == "linear":
        return Linear(*(tuple(d[k]) for k in ("columns", "means", "sds", "weights")), d["intercept"])
    return Trees(tuple(d["columns"]), tuple(map(_thawed, d["trees"])), tuple(d["tree_weights"]), tuple(d["importances"]),
                 d["kind"] == "boosted")


def score_rows(model: Compiled, rows: DataFrame, score_col: str = "score") -> DataFrame:
    """M12 without MLlib: rows plus P(fraud)."""
    return rows.withColumn(score_col, score(model))


def importance(model: Compiled) -> dict[str, float]:
    """I1 of plain values: |standardised coefficient| of a linear model, impurity decrease of trees."""
    values = map(abs, model.weights) if isinstance(model, Linear) else model.importances
    return dict(zip(model.columns, values))


def importance_table(spark, model: Compiled) -> DataFrame:
    """I1 as a table of one row a feature, in the form of `operators.model.builtin_importance`."""
    kind = "absolute_standardised_coefficient" if isinstance(model, Linear) else "impurity_decrease"
    return spark.createDataFrame([(c, float(v), kind) for c, v in importance(model).items()],
                                 "feature string, importance double, importance_type string")
