"""Structured Streaming form of the raw-contract source (S1/S3) and the Parquet sink.

The reference is batch-only; this is the same contract read and rename/cast,
driven incrementally: new raw CSV files are picked up with the explicit
schema, every micro-batch is validated, renamed, typed and written to the sink.

A sink is a folder of attempts (`batches/batch_id=<n>/attempt=<id>`), each a
set of Parquet files, and of manifests (`commits/<n>.json`), which name the one
attempt that counts. A manifest appears by a rename when its attempt is
complete, so a reader, `ingested`, sees whole batches only, whatever was being
written. The folder also names its writer, the checkpoint: another one is
refused, as source files would be written twice. The checkpoint lies under the
shared `spark.checkpoint.dir`, in a folder named by a digest of the sink's path,
so a restarted query finds it; a sink whose checkpoint is gone is refused.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import CANONICAL_NAMES
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.contract import RAW_SCHEMA, rename_and_cast, sequential_ids

CANONICAL = [T.StructField("txn_id", T.LongType()),
             *(T.StructField(CANONICAL_NAMES[f.name], f.dataType) for f in RAW_SCHEMA.fields)]


def raw_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New CSV files under `src_dir`, read with the contract schema (never inferred).

    Spark checks every file's header against the schema, so a file with other
    or reordered columns stops the query instead of being read by position."""
    r = spark.readStream.option("header", True).option("enforceSchema", False).schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(src_dir)


def _at(spark: SparkSession, path: str):
    """(file system, path) on the JVM: sinks lie wherever Spark can write."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def _write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this text; False if there is one already. Creation is exclusive on every file system."""
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def _commit(spark: SparkSession, out_path: str, batch_id: int, manifest: dict) -> None:
    """Make an attempt the batch: the manifest is written beside its place and renamed to it."""
    folder = f"{out_path}/commits"
    fs, done = _at(spark, f"{folder}/{batch_id}.json")
    _, part = _at(spark, f"{folder}/.{batch_id}.{uuid.uuid4().hex}")
    _write_new(spark, part.toString(), json.dumps(manifest))
    if not fs.rename(part, done):
        raise OSError(f"batch {batch_id} of {out_path} could not be committed")


def _manifest(spark: SparkSession, out_path: str, batch_id: int) -> dict | None:
    path = f"{out_path}/commits/{batch_id}.json"
    return json.loads(_read(spark, path)) if _exists(spark, path) else None


def ingested(spark: SparkSession, out_path: str) -> DataFrame:
    """The committed rows of a sink, with their batch_id. A sink without a committed batch has no rows."""
    out_path = out_path.rstrip("/")
    fs, commits = _at(spark, f"{out_path}/commits")
    names = [f.getPath().toString() for f in fs.listStatus(commits)] if fs.exists(commits) else []
    names = [n for n in names if n.endswith(".json")]
    if not names:
        return spark.createDataFrame([], T.StructType([*CANONICAL, T.StructField("batch_id", T.IntegerType())]))
    # one path per batch comes to the driver, as any read of a list of folders needs
    paths = [r["path"] for r in spark.read.schema("batch_id long, path string").json(names).orderBy("batch_id").collect()]
    rows = spark.read.option("basePath", f"{out_path}/batches").schema(
        T.StructType([*CANONICAL, T.StructField("batch_id", T.IntegerType()), T.StructField("attempt", T.StringType())])).parquet(*paths)
    return rows.drop("attempt")


def ingest(spark: SparkSession, src_dir: str, out_path: str, checkpoint: str | None = None,
           available_now: bool = True, max_files_per_trigger: int | None = None):
    """Write canonical rows for every new raw file, one committed batch per micro-batch (a retried one is written anew
    beside the old attempt); returns the (finished or running) StreamingQuery.

    Streamed rows carry no id, so each micro-batch gets load-order ids after
    the last one of the batch before it, which its manifest holds.
    """
    out_path = out_path.rstrip("/")
    digest = hashlib.sha256(out_path.encode()).hexdigest()[:16]
    checkpoint = (checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{digest}").rstrip("/")
    if not _write_new(spark, f"{out_path}/writer", checkpoint):
        writer = _read(spark, f"{out_path}/writer")
        if writer != checkpoint:
            raise ValueError(f"{out_path} is written from {writer}, not from {checkpoint}")
        if _exists(spark, f"{out_path}/commits") and not _exists(spark, checkpoint):
            raise ValueError(f"{out_path} holds rows but {checkpoint} does not exist: its files would be read again")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if _manifest(spark, out_path, batch_id):
            return  # committed, but the query ended before it could note so
        before = _manifest(spark, out_path, batch_id - 1) if batch_id else {"last_id": 0}
        path = f"{out_path}/batches/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
        sequential_ids(rename_and_cast(batch), before["last_id"]).select(*[f.name for f in CANONICAL]).write.parquet(path)
        rows, last = spark.read.parquet(path).agg(F.count(F.lit(1)), F.max("txn_id")).first()
        _commit(spark, out_path, batch_id, {"batch_id": batch_id, "path": path, "rows": rows, "last_id": last or before["last_id"]})

    q = raw_stream(spark, src_dir, max_files_per_trigger).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
