"""The raw 11-column transaction contract.

The raw files are read with an explicit schema (never inferred); the header is
checked against the contract; columns are renamed to snake_case once and money
is cast to DECIMAL(18,2).  A surrogate `txn_id` that preserves file order is
built from per-split offsets (a small table of one row per file split), so no
step needs a global single-task row_number.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import CANONICAL_NAMES, RAW_COLUMNS

log = logging.getLogger(__name__)


class ContractError(ValueError):
    """Raised when input does not carry every required raw column."""


_MONEY = T.DecimalType(18, 2)
RAW_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("amount", _MONEY, True),
    T.StructField("nameOrig", T.StringType(), False),
    T.StructField("oldbalanceOrg", _MONEY, True),
    T.StructField("newbalanceOrig", _MONEY, True),
    T.StructField("nameDest", T.StringType(), False),
    T.StructField("oldbalanceDest", _MONEY, True),
    T.StructField("newbalanceDest", _MONEY, True),
    T.StructField("isFraud", T.IntegerType(), False),
    T.StructField("isFlaggedFraud", T.IntegerType(), False),
])


def validate_columns(columns, required=RAW_COLUMNS) -> list[str]:
    """Missing columns raise, extra columns only warn; returns the required list."""
    present = set(columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    extra = [c for c in columns if c not in set(required)]
    if extra:
        log.warning("ignoring extra columns: %s", extra)
    return list(required)


def first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, value): the first line of each file that has one.

    Each file is a limit of its own, so a task opens it and stops after a line.
    A session of its own keeps files from being split, as every split would be
    opened for a first line."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    session.conf.set("spark.sql.files.openCostInBytes", "1t")
    lines = [session.read.text(f).limit(1).select(F.lit(f).alias("file"), "value") for f in files]
    return reduce(DataFrame.unionAll, lines)


_FILES_A_JOB = 64
_JOBS = 4  # at a time


def files_by_header(spark: SparkSession, path: str, sep: str = ",", required=RAW_COLUMNS) -> dict[str, list[str]]:
    """Header line -> files under `path` that begin with it, for headers that hold every required column.

    The driver gets one path and header per file, as any read of a list of
    files needs; the data is not read.  Other files are skipped.
    """
    files = sorted(map(unquote, spark.read.text(path).inputFiles()))  # the listing gives escaped names
    parts = [files[i:i + _FILES_A_JOB] for i in range(0, len(files), _FILES_A_JOB)]
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(_JOBS) as pool:
        for rows in pool.map(lambda part: first_lines(spark, part).collect(), parts):
            for r in rows:
                names = {c.strip().replace('"', "") for c in r["value"].split(sep)}
                if names.issuperset(required):
                    out.setdefault(r["value"], []).append(r["file"])
    if not out:
        raise ContractError(f"no file under {path} carries all required columns {list(required)}")
    return {header: sorted(out[header]) for header in sorted(out)}


def scan_contract(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The contract columns of every CSV under `path` whose header satisfies the contract.

    Column order and extra columns may differ from file to file: files are
    grouped by header, each group is read with the explicit schema in its own
    order (no inference; Spark checks each header against it), and the contract
    columns are put together by name.
    """
    out = None
    for header, files in files_by_header(spark, path, sep).items():
        columns = [c.strip().strip('"') for c in header.split(sep)]
        validate_columns(columns)
        df = (spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
              .schema(_schema_for(columns)).csv(files).select(*RAW_COLUMNS))
        out = df if out is None else out.unionByName(df)
    return out


def load_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Raw CSV files -> canonical transactions, ids 1.. in order of file and line.

    Chronological order needs no sort: it is carried by (step, txn_id)."""
    return sequential_ids(rename_and_cast(scan_contract(spark, path, sep))).select("txn_id", *CANONICAL_NAMES.values())


def _schema_for(header: list[str]) -> T.StructType:
    by_name = {f.name: f for f in RAW_SCHEMA.fields}
    return T.StructType([by_name.get(c, T.StructField(c, T.StringType(), True)) for c in header])


def rename_and_cast(raw: DataFrame) -> DataFrame:
    """snake_case names, DECIMAL(18,2) money, INT step and labels."""
    validate_columns(raw.columns)
    money = {"amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"}
    cols = []
    for src in RAW_COLUMNS:
        c = F.col(src)
        if src in money:
            c = c.cast(_MONEY)
        elif src in ("step", "isFraud", "isFlaggedFraud"):
            c = c.cast("int")
        cols.append(c.alias(CANONICAL_NAMES[src]))
    extra = [c for c in raw.columns if c not in RAW_COLUMNS and c == "txn_id"]
    return raw.select(*extra, *cols)


def sequential_ids(df: DataFrame, base: int = 0, id_col: str = "txn_id") -> DataFrame:
    """Load-order ids base+1.. for rows fresh from a file read (also inside a streaming micro-batch).

    Groups are (scan partition, file): within one, monotonically_increasing_id
    is consecutive; the group table (one row per split/file) gets a prefix sum
    and is joined back, so no step orders the whole batch in one task.
    """
    tagged = df.select("*", F.spark_partition_id().alias("_p"), F.input_file_name().alias("_f"),
                       F.monotonically_increasing_id().alias("_mono"))
    groups = tagged.groupBy("_p", "_f").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_m0"))
    groups = groups.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.orderBy("_f", "_m0").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = tagged.join(groups.select("_p", "_f", "_m0", "_off"), ["_p", "_f"]) \
        .withColumn(id_col, (F.lit(base) + F.col("_off") + F.col("_mono") - F.col("_m0") + 1).cast("bigint"))
    return out.drop("_p", "_f", "_mono", "_m0", "_off")


def early_window(txns: DataFrame, n_rows: int | None = None, max_step: int | None = None, first_id: int = 1) -> DataFrame:
    """The first N rows as an early *time window* on the dense id (never a bare limit)."""
    out = txns
    if n_rows is not None:
        out = out.where(F.col("txn_id") < F.lit(first_id + n_rows))
    if max_step is not None:
        out = out.where(F.col("step") <= F.lit(max_step))
    return out


def load_summary(txns: DataFrame) -> DataFrame:
    """One-row load summary in a single aggregation pass."""
    return txns.agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count_distinct("step").alias("distinct_steps"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.count_distinct("txn_type").alias("distinct_types"),
        F.sum("is_fraud").cast("bigint").alias("fraud_rows"),
        (F.sum("is_fraud").cast("double") / F.count(F.lit(1)).cast("double")).alias("fraud_rate"),
    )


def raw_from_canonical(txns: DataFrame) -> DataFrame:
    """Inverse naming (canonical -> raw contract names); used to feed S1/S4 from the fixtures."""
    return txns.select(*[F.col(c).alias(raw) for raw, c in CANONICAL_NAMES.items()])
