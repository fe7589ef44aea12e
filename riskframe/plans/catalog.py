"""Query catalog: name -> (Spark builder(spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskframe.session import release_cached

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Builder, str | None]] = {}


def _owning(fn: Builder) -> Builder:
    """fn that first releases the frames persisted for the query built before it."""
    @wraps(fn)
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        release_cached()
        return fn(spark, sf_dir)
    return build


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in CATALOG:
            raise KeyError(f"duplicate query {name}")
        CATALOG[name] = (_owning(fn), sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the query modules fills CATALOG
    from riskframe.plans import q_sources, q_features  # noqa: F401
    for mod in ("q_audit", "q_analysis", "q_ranking", "q_cost", "q_dashboard", "q_model", "q_scale", "q_streaming"):
        try:
            __import__(f"riskframe.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"riskframe.plans.{mod}":
                raise
    return CATALOG
