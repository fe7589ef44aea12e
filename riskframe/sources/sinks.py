"""Sinks (S8, S9): Parquet by default, CSV on request; always overwrite-idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """One flat table per result; idempotent overwrite so a retried job is safe."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_features(features: DataFrame, path: str) -> str:
    """Feature table partitioned by simulated day (prunable by step range)."""
    return write_table(features, path, "parquet", ["sim_day"])
