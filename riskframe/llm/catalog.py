"""The queries of this subpackage: name -> (Spark builder(spark, sf_dir), DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    from riskframe.llm import queries  # noqa: F401  (fills QUERIES)
    import corpus_pipeline
    if "pipeline" not in QUERIES:
        register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
    return QUERIES
