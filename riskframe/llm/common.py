"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

BatchFn = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df once as Parquet in the cluster's shared checkpoint folder and read it back.

    This cuts the lineage with files that every executor sees, so a lost
    executor costs a reread, and later jobs see one fixed set of rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskframe-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, raw): the id and the whole text as UTF-8 bytes; every other column, whatever its name, is left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def chunks(values: list, weight: Callable, most: int) -> Iterator[tuple[int, list]]:
    """(first position, values) runs of at most `most` total weight, one value at least: bounds what a task holds."""
    first, run, total = 0, [], 0
    for i, v in enumerate(values):
        w = weight(v)
        if run and total + w > most:
            yield first, run
            first, run, total = i, [], 0
        run.append(v)
        total += w
    if run:
        yield first, run


def small_batches(batches: Iterator[pa.RecordBatch], column: int = 1, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices of about `most` bytes of a column, one row at least: bounds the Python objects that a
    worker holds besides a batch."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.column(column).nbytes))
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


_HASHES = 1 << 40


def _hash(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(_HASHES))


def least_hashed(rows: DataFrame, k: int, *cols: str, by: str | None = None) -> DataFrame:
    """The k rows of least hash of `cols`, of each value of `by` if given (a column of few values).

    The rows are counted first, and a cut by hash leaves about 4k of them
    however many there are, so that no task merges k rows of every other task.
    """
    share = lambda n: min(_HASHES, -(-_HASHES * 4 * k // max(n, 1)))
    if by is None:
        return rows.where(_hash(*cols) < F.lit(share(rows.count()))).orderBy(_hash(*cols), *cols).limit(k)
    cut = F.lit(0)
    for value, n in rows.groupBy(by).count().collect():
        cut = F.when(F.col(by) == value, F.lit(share(n))).otherwise(cut)
    nth = F.row_number().over(Window.partitionBy(by).orderBy(_hash(*cols), *cols))
    return rows.where(_hash(*cols) < cut).withColumn("__nth", nth).where(F.col("__nth") <= k).drop("__nth")


def spark_hash(column: str) -> Column:
    """The order of LeastHashed, in Spark."""
    return F.md5(F.col(column).cast("binary"))


class LeastHashed:
    """The k distinct strings of least hash of each kind, of all that a task adds."""

    def __init__(self, k: int):
        self.k = k
        self.held: dict[str, dict[str, str]] = {}   # kind -> string -> hash
        self.most: dict[str, str] = {}              # kind -> hash above which nothing is kept

    def add(self, kind: str, text: str) -> None:
        held = self.held.setdefault(kind, {})
        if text in held:
            return
        h = hashlib.md5(text.encode()).hexdigest()
        if h <= self.most.get(kind, "g"):
            held[text] = h
            if len(held) >= 4 * self.k:
                kept = sorted(held.items(), key=lambda x: (x[1], x[0]))[:self.k]
                self.held[kind], self.most[kind] = dict(kept), kept[-1][1]

    def rows(self) -> list[tuple[str, str]]:
        return [(kind, text) for kind, held in self.held.items()
                for text, _ in sorted(held.items(), key=lambda x: (x[1], x[0]))[:self.k]]
