"""SparkSession helpers: local test sessions and a cluster-safe checkpoint dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskframe") -> SparkSession:
    """A local[N] session for tests and benchmarks (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared `spark.checkpoint.dir`.

    Where it is unset, a scratch folder stands in, on a local master only: on a
    cluster every executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


# Frames persisted for one query: its builder's caller owns them and releases them when the next one is built.
_HELD: list[DataFrame] = []


def cached(df: DataFrame) -> DataFrame:
    """df persisted until `release_cached`; blocks lost with an executor are computed again from lineage."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _HELD.append(out)
    return out


def release_cached() -> None:
    """Unpersist what `cached` holds.  A plan that still reads a released frame computes it again."""
    while _HELD:
        df = _HELD.pop()
        if df.sparkSession.sparkContext._jsc is not None:  # a stopped session has nothing to release
            df.unpersist(blocking=False)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet under the shared checkpoint folder and read back: for small tables that several plans
    read, so that none computes them again and none depends on an executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SMALL_TABLE = 1 << 18  # rows of a control table that may be broadcast


def small_table(df: DataFrame, weight: Column | None = None) -> tuple[DataFrame, int]:
    """df with a broadcast hint if its counted size allows one, and its rows (one small job); weight: values in a row."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight if weight is not None else F.lit(1)), F.lit(0))).first()
    return (F.broadcast(df) if size <= _SMALL_TABLE else df), n
