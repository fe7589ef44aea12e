"""Exact order statistics of many columns by radix histograms.

A double has an order-preserving 64-bit key: its bits, with all but the sign
flipped for negative numbers. One pass over the rows counts, for every column
at once, how many keys share each prefix; the running counts give the prefix
that holds a wanted position. The next pass counts longer prefixes, of the rows
in wanted prefixes alone. A pass goes straight to whole keys when few rows are
left, so a table takes two passes as a rule and five at most.

Nothing is unpivoted, shuffled whole or persisted: tasks send (column, group,
prefix) counts, at most 2^16 prefixes a column and group in the first pass. The
driver gets a pass's counts if they are few, else those at wanted positions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cached

_FIRST_BITS = 16
_STEP_BITS = 16
_WHOLE_ROWS = 4_000_000   # rows in wanted prefixes, over all columns, that one pass may count by whole key
_HELD = 1 << 18           # counts that a task keeps apart before it adds them up
_DRIVER_COUNTS = 1 << 18  # counts of one pass that the driver may search itself
_MOST_TARGETS = 100_000   # (column, group, position) control values on the driver

COUNTS = "col int, grp string, prefix long, n long, lo long, hi long, total double, zeros long"
_NAMES = [c.split()[0] for c in COUNTS.split(", ")]
_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
_SIGN = np.int64(np.iinfo(np.int64).max)


def keys_of(values: np.ndarray) -> np.ndarray:
    """int64 keys in the order of the doubles; -0.0 is 0.0, NaN above all, as Spark orders them."""
    bits = np.where(np.isnan(values), np.int64(0x7FF8000000000000), (values + 0.0).view(np.int64))
    return bits ^ ((bits >> 63) & _SIGN)


def value_of(key: int) -> float:
    bits = key if key >= 0 else key ^ int(_SIGN)
    return float(np.array([bits], np.int64).view(np.float64)[0])


@dataclass(frozen=True)
class Wanted:
    """Positions still open: sorted prefixes of (column, group) whose rows the next pass counts."""
    bits: int                                   # of the prefixes
    prefixes: dict[tuple[int, str], np.ndarray]


class _Counts:
    """Counts of one (column, group), added up now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, prefix, n, lo, hi, total, zeros) -> None:
        self.parts.append((prefix, n, lo, hi, total, zeros))
        self.size += len(prefix)
        if self.size > _HELD and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, ...]:
        prefix, n, lo, hi, total, zeros = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(prefix, kind="stable")
        prefix = prefix[order]
        at = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        return (prefix[at], np.add.reduceat(n[order], at), np.minimum.reduceat(lo[order], at),
                np.maximum.reduceat(hi[order], at), np.add.reduceat(total[order], at), np.add.reduceat(zeros[order], at))


def _counted(values: np.ndarray, shift: int):
    keys = np.sort(keys_of(values))
    prefix = keys >> shift
    at = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
    n = np.diff(np.append(at, len(keys)))
    bits = np.where(keys < 0, keys ^ _SIGN, keys)
    zero = (keys == 0).astype(np.int64)
    return prefix[at], n, keys[at], keys[at + n - 1], np.add.reduceat(bits.view(np.float64), at), np.add.reduceat(zero, at)


def _histogram(df: DataFrame, columns: list[str], group: Column | None, bits: int, wanted: Wanted | None) -> DataFrame:
    """COUNTS of the prefixes of `bits` bits, summed over all tasks; NULL values count nowhere."""
    shift = 64 - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], _Counts] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(len(columns)).dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            for c in range(len(columns)):
                column = batch.column(c)
                valid = np.asarray(column.is_valid())
                values = np.asarray(column.fill_null(0.0))
                for g, name in enumerate(names):
                    mine = values[valid & (codes == g)] if len(names) > 1 else values[valid]
                    if wanted is not None and len(mine):
                        open_ = wanted.prefixes.get((c, name))
                        if open_ is None:
                            continue
                        own = keys_of(mine) >> (64 - wanted.bits)
                        place = np.minimum(np.searchsorted(open_, own), len(open_) - 1)
                        mine = mine[open_[place] == own]
                    if len(mine):
                        held.setdefault((c, name), _Counts()).add(*_counted(mine, shift))
        for (c, name), counts in held.items():
            parts = counts.merged()
            k = len(parts[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, c), pa.int32()), pa.array([name] * k, pa.string()),
                                              *(pa.array(p, t) for p, t in zip(parts, _TYPES[2:]))], names=_NAMES)

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)],
                     (group if group is not None else F.lit("")).alias("grp"))
    return rows.mapInArrow(run, COUNTS).groupBy("col", "grp", "prefix").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"),
        F.sum("zeros").alias("zeros"))


Found = tuple[int, str, int, int, int, int, int, int]  # column, group, position, rows before the prefix, prefix, n, lo, hi


def _positions(hist: DataFrame, parent_shift: int | None, open_: dict[tuple[int, str, int], tuple[int, int]]) -> list[Found]:
    """For each (column, group, position) -> (parent, rows before it): the prefix that holds the position.

    Counts run inside a parent, the prefix wanted by the pass before. A small
    histogram is searched on the driver, a large one by a join."""
    held = _small(hist)
    if held is not None:
        return _in_memory(held, parent_shift, open_)
    targets = hist.sparkSession.createDataFrame([(c, g, parent, at, base) for (c, g, at), (parent, base) in open_.items()],
                                                "t_col int, t_grp string, t_parent long, at long, base long")
    parent = F.lit(0).cast("long") if parent_shift is None else F.shiftright("prefix", parent_shift)
    before = Window.partitionBy("col", "grp", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    run = hist.withColumn("parent", parent).withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
    same = [F.col(c) == F.col(f"t_{c}") for c in ("col", "grp", "parent")]
    place = F.col("at") - F.col("base") - F.col("off")
    met = run.join(F.broadcast(targets), [*same, place >= 0, place < F.col("n")])  # at most _MOST_TARGETS targets
    return [tuple(r) for r in met.select("col", "grp", "at", F.col("off") + F.col("base"), "prefix", "n", "lo", "hi").collect()]


def _small(hist: DataFrame) -> pd.DataFrame | None:
    """The histogram on the driver if it has at most _DRIVER_COUNTS counts."""
    rows = hist.limit(_DRIVER_COUNTS + 1).toPandas()
    return rows if len(rows) <= _DRIVER_COUNTS else None


def _in_memory(held: pd.DataFrame, parent_shift: int | None, open_) -> list[Found]:
    held = held.assign(parent=0 if parent_shift is None else held["prefix"].to_numpy(np.int64) >> parent_shift)
    by = {key: part.sort_values("prefix") for key, part in held.groupby(["col", "grp", "parent"], sort=False)}
    out = []
    for (c, g, at), (parent, base) in open_.items():
        part = by[c, g, parent]
        upto = part["n"].to_numpy().cumsum()
        k = int(np.searchsorted(upto, at - base, "right"))
        row = part.iloc[k]
        out.append((c, g, at, base + int(upto[k] - row["n"]), int(row["prefix"]), int(row["n"]), int(row["lo"]), int(row["hi"])))
    return out


@dataclass(frozen=True)
class Profile:
    """Of one column in one group: defined values, zeros among them, their sum, and the quantiles asked for."""
    n: int
    zeros: int
    total: float
    quantiles: dict[float, float]


class TooManyTargets(ValueError):
    """More (column, group, quantile) values than the driver may hold."""


def profiles(df: DataFrame, columns: list[str], qs: list[float], group: Column | None = None) -> dict[tuple[str, str], Profile]:
    """(column, group) -> Profile, exact: quantiles are lo + (hi - lo) * d at position q * (n - 1), as numpy's 'linear'.

    `group` is a string column of few values; rows where it is NULL are left
    out, and without it the group is ''. A column without a value in a group
    has no entry. NULL values are dropped, NaN sorts above every number.
    """
    spark = df.sparkSession
    rows = df.where(group.isNotNull()) if group is not None else df
    hist = _histogram(rows, columns, group, _FIRST_BITS, None)  # at most 2^16 counts a column and group
    held = _small(hist)
    if held is None:
        hist = cached(hist)  # read for the totals and for the wanted prefixes
        sums = hist.groupBy("col", "grp").agg(*[F.sum(c).alias(c) for c in ("n", "total", "zeros")])
        held_totals = sums.limit(_MOST_TARGETS + 1).toPandas()
    else:
        held_totals = held.groupby(["col", "grp"], as_index=False)[["n", "total", "zeros"]].sum()
    totals = {(int(r.col), r.grp): r for r in held_totals.itertuples()}
    if len(totals) * max(1, 2 * len(qs)) > _MOST_TARGETS:
        raise TooManyTargets(f"{len(totals)} columns and groups with {len(qs)} quantiles")
    # (column, group, position) -> (wanted prefix, rows before it)
    open_ = {(*key, at): (0, 0) for key, r in totals.items() for q in qs
             for at in (math.floor(q * (int(r.n) - 1)), math.ceil(q * (int(r.n) - 1)))}
    found: dict[tuple[int, str, int], int] = {}
    bits, shift, first = _FIRST_BITS, None, held
    while open_:
        places = _in_memory(first, shift, open_) if first is not None else _positions(hist, shift, open_)
        open_, sizes, first = {}, {}, None
        for c, g, at, base, prefix, n, lo, hi in places:
            if lo == hi:
                found[c, g, at] = lo
            else:
                open_[c, g, at] = (prefix, base)
                sizes.setdefault((c, g), {})[prefix] = n
        if open_:
            wanted = Wanted(bits, {k: np.array(sorted(p), np.int64) for k, p in sizes.items()})
            few = sum(sum(p.values()) for p in sizes.values()) <= _WHOLE_ROWS
            bits = 64 if few else min(64, bits + _STEP_BITS)
            shift = bits - wanted.bits
            hist = _histogram(rows, columns, group, bits, wanted)
    out = {}
    for (c, g), r in totals.items():
        of = {}
        for q in qs:
            pos = q * (int(r.n) - 1)
            lo, hi = (value_of(found[c, g, at]) for at in (math.floor(pos), math.ceil(pos)))
            d = pos - math.floor(pos)
            of[q] = lo if d == 0 else lo + (hi - lo) * d
        out[columns[c], g] = Profile(int(r.n), int(r.zeros), float(r.total), of)
    return out


def quantile_rows(df: DataFrame, columns: list[str], qs: list[float], group: str | None = None) -> DataFrame:
    """(column, [group,] q, value) as a table; `group` names a column of few values, which keeps its type.

    Eager: it runs the passes and holds at most _MOST_TARGETS values."""
    spark = df.sparkSession
    found = profiles(df, columns, qs, F.col(group).cast("string") if group else None)
    rows = [(c, g, q, v) for (c, g), p in found.items() for q, v in p.quantiles.items()]
    out = spark.createDataFrame(rows, "column string, grp string, q double, value double")
    return out.drop("grp") if group is None else out.select(
        "column", F.col("grp").cast(df.schema[group].dataType).alias(group), "q", "value")
