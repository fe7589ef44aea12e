"""Plan inspection: what reaches the scans and how many exchanges a plan has."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def scan_summary(df: DataFrame) -> list[dict]:
    """One entry per file scan in the physical plan: pushed filters and the pruned read schema."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if "FileScan" not in line and "Scan parquet" not in line:
            continue
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        schema = re.search(r"ReadSchema: struct<([^>]*)>", line)
        out.append({"pushed_filters": pushed.group(1) if pushed else "",
                    "read_columns": [c.split(":")[0] for c in schema.group(1).split(",")] if schema else []})
    return out


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges in the (pre-AQE) physical plan, as printed."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning\([^\n]*|Exchange SinglePartition[^\n]*", plan)


def plan_text(df: DataFrame) -> str:
    """The (pre-AQE) physical plan as printed."""
    return df._jdf.queryExecution().executedPlan().toString()
