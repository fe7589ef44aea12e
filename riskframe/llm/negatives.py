"""Hard negatives by angular triangle filtering.

Every vector keeps its norm and its angles to a few reference directions. For
an anchor and a row, the angle between them lies between the largest
difference and the smallest sum of their angles to a reference, so the cosine
lies in an interval and, times both norms, so does the score. The interval is
widened by more than the rounding error. Only rows whose interval meets a
window of wanted scores get integer scoring.

How it runs:

* Rows belong to the cell of their nearest reference, cells are cut by hash
  into stripes of a bounded number of rows. A stripe stays in one task; the
  anchors are streamed past it, so a task holds one stripe.
* Anchors meet their own stripe first. The best scores found there narrow
  their windows, so the other stripes return little.
* An anchor is not sent to cells whose ranges of angles and norms rule out
  its windows.
* Positives (same label, best scores) come first; their scores give the
  windows of the negatives, which take the same two passes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import least_hashed, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3

_REFERENCES = 16
_SAMPLE = 2048          # rows the reference directions are fitted on; they decide the cost, never a result
_STRIPE_ROWS = 1 << 12
_MOST_PARTITIONS = 1 << 15
_ANGLE_SLACK = 1e-6     # arccos is off by 3e-8 at most, near 0 and pi
_COSINE_SLACK = 1e-9
_LONG = (1 << 63) - 1

_WINDOWS = "array<struct<p:bigint,lo:bigint,hi:bigint>>"
VECTORS = "id long, label long, copies long, key binary, q binary, norm double, angles array<double>, cell int"
FOUND = "key binary, p long, score long, other long"


def _components(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, sizes) of a list column; shorter rows are filled with zeros."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width), sizes
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out, sizes


def _narrow(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows cut or filled with zeros to a width."""
    return np.pad(rows[:, :width], ((0, 0), (0, max(0, width - rows.shape[1]))))


def references(sample: np.ndarray, most: int = _REFERENCES, steps: int = 5) -> np.ndarray:
    """Unit directions for a sample of vectors: far apart at first, then moved to the means of their cells."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(most, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    out = unit[chosen]
    for _ in range(steps):
        cell = (unit @ out.T).argmax(axis=1)
        for c in range(len(out)):
            mean = unit[cell == c].sum(axis=0)
            if (length := np.linalg.norm(mean)) > 1e-9:
                out[c] = mean / length
    return out


def angles_to(rows: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(angles, norms). A zero vector scores 0 with everything, whatever angles stand for it."""
    top = np.abs(rows).max(axis=1, initial=0)
    unit = rows / np.where(top > 0, top, 1)[:, None]
    length = np.linalg.norm(unit, axis=1)
    unit /= np.where(length > 0, length, 1)[:, None]
    return np.arccos(np.clip(_narrow(unit, refs.shape[1]) @ refs.T, -1, 1)), length * top


def _usable(vec: Column) -> Column:
    """Not null, and all components times the scale finite."""
    finite = lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < F.lit(math.inf), F.lit(False))
    return vec.isNotNull() & F.forall(vec, finite)


def indexed(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """VECTORS of (id, label, vec, copies): floored components, norm, angles and cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, sizes = _components(batch.column(2))
            q = np.floor(matrix * SCALE) + 0.0  # no negative zero
            angles, norms = angles_to(q, refs)
            raw = [r[:n].astype("<f8").tobytes() for r, n in zip(q, sizes)]
            keys = [hashlib.blake2b(b"%d %d " % (i, l) + r, digest_size=16).digest()
                    for i, l, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw)]
            cells = angles.argmin(axis=1) if len(refs) else np.zeros(len(q))
            listed = pa.ListArray.from_arrays(np.arange(len(q) + 1, dtype=np.int32) * len(refs), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(keys, pa.binary()), pa.array(raw, pa.binary()),
                 pa.array(norms), listed, pa.array(cells.astype(np.int32))], names=[c.split()[0] for c in VECTORS.split(", ")])

    return rows.select("id", "label", "vec", "copies").mapInArrow(run, VECTORS)


@dataclass(frozen=True)
class Cells:
    """What is known of each cell, one row a reference at most: rows, norms and angles to all references."""
    ids: list[int]
    first_stripe: list[int]
    stripes: list[int]
    norms: np.ndarray   # (cell, 2): least and greatest
    low: np.ndarray     # (cell, reference): least angle
    high: np.ndarray

    @classmethod
    def of(cls, vectors: DataFrame, n_refs: int, stripe_rows: int) -> Cells:
        ranges = [f(F.col("angles")[j]).alias(f"{name}{j}") for j in range(n_refs) for name, f in (("lo", F.min), ("hi", F.max))]
        found = sorted(vectors.groupBy("cell").agg(F.count("*").alias("n"), F.min("norm").alias("a"), F.max("norm").alias("b"),
                                                   *ranges).collect(), key=lambda r: r["cell"])
        stripes = [-(-r["n"] // stripe_rows) for r in found]
        part = lambda name: np.array([[r[f"{name}{j}"] for j in range(n_refs)] for r in found]).reshape(len(found), n_refs)
        return cls([r["cell"] for r in found], [sum(stripes[:i]) for i in range(len(stripes))], stripes,
                   np.array([[r["a"], r["b"]] for r in found]).reshape(-1, 2), part("lo"), part("hi"))

    def stripe_column(self) -> Column:
        out = F.lit(None).cast("long")
        for cell, first, n in zip(self.ids, self.first_stripe, self.stripes):
            out = F.when(F.col("cell") == cell, F.lit(first) + F.pmod(F.xxhash64("key"), F.lit(n))).otherwise(out)
        return out

    def reached(self, angles: np.ndarray, norm: float, lo: int, hi: int) -> list[int]:
        """Stripes of the cells that can hold a score from lo to hi."""
        apart = np.maximum(np.maximum(self.low - angles, angles - self.high), 0).max(axis=1, initial=0)
        far = np.minimum(angles + self.high, 2 * np.pi - angles - self.low).min(axis=1, initial=np.pi)
        near_cos = np.cos(np.maximum(apart - _ANGLE_SLACK, 0)) + _COSINE_SLACK
        far_cos = np.cos(np.minimum(far + _ANGLE_SLACK, np.pi)) - _COSINE_SLACK
        most = norm * np.maximum(near_cos * self.norms[:, 0], near_cos * self.norms[:, 1])
        least = norm * np.minimum(far_cos * self.norms[:, 0], far_cos * self.norms[:, 1])
        keep = ~((most < lo) | (least > hi))
        return [s for k, f, n in zip(keep, self.first_stripe, self.stripes) if k for s in range(f, f + n)]


def bounds(angles: np.ndarray, norms: np.ndarray, own: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of each row (angles: reference x row) with an anchor, both certain."""
    apart = np.abs(angles - own[:, None]).max(axis=0, initial=0)
    both = angles + own[:, None]
    far = np.minimum(both, 2 * np.pi - both).min(axis=0, initial=np.pi)
    scale = norms * norm
    return (scale * (np.cos(np.minimum(far + _ANGLE_SLACK, np.pi)) - _COSINE_SLACK),
            scale * (np.cos(np.maximum(apart - _ANGLE_SLACK, 0)) + _COSINE_SLACK))


def scores(rows: np.ndarray, anchor: np.ndarray, exact_in_doubles: bool) -> np.ndarray:
    """Integer inner products. Beyond the whole numbers of doubles they are made of Python's, and kept to a long."""
    if exact_in_doubles:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    made = (sum(int(x) * y for x, y in zip(r, whole)) for r in rows)
    return np.array([max(-_LONG, min(_LONG, s)) for s in made], np.int64)


class _Stripe:
    """The rows of a stripe, sorted by the angle to one reference, so that a limit on the angle is a slice."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches)
        self.n_refs = len(t["angles"][0])
        angles = np.concatenate([_components(c)[0] for c in t["angles"].chunks])
        order = np.argsort(angles[:, 0], kind="stable") if self.n_refs else np.arange(len(t))
        self.angles = np.ascontiguousarray(angles[order].T)
        raw = t["q"].to_pylist()
        width = max(len(r) for r in raw) // 8
        q = np.zeros((len(raw), width))
        for i, at in enumerate(order):
            v = np.frombuffer(raw[at], "<f8")
            q[i, :len(v)] = v
        self.q = q
        self.norms, self.ids, self.labels, self.copies = (t[c].to_numpy()[order] for c in ("norm", "id", "label", "copies"))
        keys = t["key"].to_pylist()
        self.keys = [keys[i] for i in order]
        self.most = float(self.norms.max())

    def wanted(self, own: np.ndarray, norm: float, label: int, same: bool, lo: int, hi: int) -> np.ndarray:
        """Positions of the rows whose bounds meet the window."""
        first, end = 0, len(self.ids)
        if self.n_refs and lo > 0 and norm * self.most > 0:
            reach = np.arccos(min(1.0, max(-1.0, lo / (norm * self.most)))) + 2 * _ANGLE_SLACK
            first = int(np.searchsorted(self.angles[0], own[0] - reach))
            end = int(np.searchsorted(self.angles[0], own[0] + reach, "right"))
        of = first + np.flatnonzero((self.labels[first:end] == label) == same)
        least, most = bounds(self.angles[:, of], self.norms[of], own, norm)
        return of[~((most < lo) | (least > hi))]

    def best(self, key: bytes, q: np.ndarray, own: np.ndarray, norm: float, label: int, same: bool, windows: list[dict],
             k: int) -> Iterator[tuple[int, int, int]]:
        """(p, score, id) of the k best rows in each window; copies of a row are rows, the anchor is none of its own."""
        at = self.wanted(own, norm, label, same, min(w["lo"] for w in windows), max(w["hi"] for w in windows))
        if not len(at):
            return
        anchor = _narrow(q[None], self.q.shape[1])[0]
        got = scores(self.q[at], anchor, norm * self.most < 1 << 52)
        by = np.lexsort((self.ids[at], -got))
        at, got = at[by], got[by]
        for w in windows:
            inside = np.flatnonzero((got >= w["lo"]) & (got <= w["hi"]))
            left = k
            for j in inside[:k + 1]:
                row = at[j]
                n = int(self.copies[row]) - (same and self.keys[row] == key)
                for _ in range(min(n, left)):
                    yield w["p"], int(got[j]), int(self.ids[row])
                left -= min(n, left)
                if not left:
                    break


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(stripe, kind, rows) of neighbouring rows of one stripe and kind."""
    for batch in batches:
        mark = np.asarray(batch.column("stripe")) * 2 + np.asarray(batch.column("kind"))
        cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield int(mark[a]) // 2, int(mark[a]) % 2, batch.slice(a, b - a)


def _meet(same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, rows = None, None
        for stripe, kind, batch in _runs(batches):
            if stripe != at:
                at, held, rows = stripe, [], None
            if not kind:
                held.append(batch)
                continue
            if not held:
                continue
            rows = rows or _Stripe(held)
            angles = _components(batch.column("angles"))[0]
            out = []
            for i, (key, label, q, norm, windows) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("key", "label", "q", "norm", "windows")))):
                out += [(key, *f) for f in rows.best(key, np.frombuffer(q, "<f8"), angles[i], norm, label, same, windows, k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=[c.split()[0] for c in FOUND.split(", ")])

    return run


def _targets(cells: Cells):
    """Arrow map: anchors with windows -> the stripes besides their own that may hold what they want."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _components(batch.column("angles"))[0]
            out = []
            for a, norm, own, windows in zip(angles, *(batch.column(c).to_pylist() for c in ("norm", "stripe", "windows"))):
                to = cells.reached(a, norm, min(w["lo"] for w in windows), max(w["hi"] for w in windows))
                out.append([s for s in to if s != own])
            yield batch.append_column("targets", pa.array(out, pa.list_(pa.int64())))

    return run


_CARRIED = ["key", "id", "label", "copies", "q", "norm", "angles"]


def _met(vectors: DataFrame, anchors: DataFrame, cells: Cells, same: bool, k: int, home: bool) -> DataFrame:
    """FOUND of anchors (with windows) against their own stripe or all others: secondary sort, rows before anchors."""
    rows = vectors.select("stripe", F.lit(0).alias("kind"), *_CARRIED, F.lit(None).cast(_WINDOWS).alias("windows"))
    if home:
        sent = anchors.withColumn("target", F.col("stripe"))
    else:
        schema = T.StructType([*anchors.schema.fields, T.StructField("targets", T.ArrayType(T.LongType()))])
        sent = anchors.mapInArrow(_targets(cells), schema).withColumn("target", F.explode("targets"))
    sent = sent.select(F.col("target").alias("stripe"), F.lit(1).alias("kind"), *_CARRIED, "windows")
    n = max(1, min(sum(cells.stripes), _MOST_PARTITIONS))
    return rows.unionAll(sent).repartition(n, "stripe").sortWithinPartitions("stripe", "kind").mapInArrow(_meet(same, k), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("key", "p").orderBy(F.desc("score"), "other"))
    return found.withColumn("nth", nth).where(F.col("nth") <= k)


def _searched(vectors: DataFrame, anchors: DataFrame, cells: Cells, same: bool, k: int, name: str) -> DataFrame:
    """The k best of every window of every anchor: own stripe, then the rest with the windows narrowed by what it gave."""
    home = stored(_best(_met(vectors, anchors, cells, same, k, True), k), f"{name}-own")
    full = home.where(F.col("nth") == k).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("p", "score"))).alias("least"))
    narrowed = F.transform("windows", lambda w: F.struct(
        w["p"].alias("p"), F.greatest(w["lo"], F.coalesce(F.element_at("least", w["p"]), w["lo"])).alias("lo"), w["hi"].alias("hi")))
    rest = anchors.join(full, "key", "left").withColumn("windows", narrowed).drop("least").select(*anchors.columns)
    more = _met(vectors, rest, cells, same, k, False)
    return stored(_best(home.drop("nth").unionAll(more), k), name)


def hard_negatives(vectors: DataFrame, anchor: Column, low: int = 50, high: int = 95, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   stripe_rows: int = _STRIPE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor and positive.

    anchor: which rows are anchors, over a column `id`. A score is the inner
    product of the components times 256, floored; missing components of the
    shorter vector are 0. Positives are the best other rows of the label,
    negatives the best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score;
    ties go to the smaller id. Rows with a null id, label or vector or a null
    or non-finite component take no part. Equal rows are rows of their own: an
    anchor that occurs twice is answered twice and is a positive of itself.
    Scores beyond a long are kept to its ends. Other columns are not read.
    Empty table, or no anchor with a positive of score 0 or more: no row.
    """
    clean = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vec_col).alias("vec"))
    clean = clean.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vec")))
    rows = clean.groupBy("id", "label", "vec").agg(F.count("*").alias("copies"))
    sample = [r["vec"] for r in least_hashed(clean, _SAMPLE, "id").select("vec").collect()]  # at most _SAMPLE rows
    refs = references(_components(pa.array(sample, pa.list_(pa.float64())))[0])
    index = stored(indexed(rows, refs), "vectors")
    cells = Cells.of(index, len(refs), stripe_rows)
    striped = index.withColumn("stripe", cells.stripe_column())
    asked = striped.where(anchor)

    everything = F.array(F.struct(F.lit(0).cast("long").alias("p"), F.lit(-_LONG).alias("lo"), F.lit(_LONG).alias("hi")))
    best = _searched(striped, asked.withColumn("windows", everything), cells, True, positives, "positives")
    pairs = best.select("key", F.col("other").alias("positive_id"), F.col("score").alias("p"), F.col("nth").alias("positive_rank"))

    # whole N with low * P <= 100 * N <= high * P, without overflow; empty for P < 0
    whole, rest = F.expr("p div 100L"), F.expr("p % 100L")
    lo = whole * low + F.ceil(rest * low / 100).cast("long")
    hi = whole * high + F.floor(rest * high / 100).cast("long")
    windows = pairs.where("p >= 0").select("key", F.struct("p", lo.alias("lo"), hi.alias("hi")).alias("w")).groupBy("key").agg(
        F.collect_set("w").alias("windows"))
    worst = _searched(striped, asked.join(windows, "key"), cells, False, negatives, "negatives")
    out = pairs.join(worst.select("key", "p", F.col("nth").alias("rank"), F.col("other").alias("negative_id"),
                                  F.col("score").alias("negative_score")), ["key", "p"])
    out = out.join(asked.select("key", F.col("id").alias("anchor_id"), F.col("copies").alias("times")), "key")
    return out.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("p").alias("positive_score"), "negative_score")


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS r FROM s WHERE same),
n AS (SELECT p.anchor, p.other AS positive, p.score AS ps, s.other AS negative, s.score AS ns,
        row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS r
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
      WHERE p.r <= 5)
SELECT anchor AS anchor_id, positive AS positive_id, r::INTEGER AS rank, negative AS negative_id, ps AS positive_score,
  ns AS negative_score FROM n WHERE r <= 3
"""
