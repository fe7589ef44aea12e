"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled text train a small network by the
non-negative unbiased PU risk: prior * loss(P, +) + max(0, loss(U, -) - prior *
loss(P, -)). Labels 0 are not used. The class prior is estimated from the same
two samples by best bin estimation on scores of held-back rows.

Fitting reads at most `fit_rows` positives and `fit_rows` unlabelled documents,
those with the least hash of their id (a documented bound); scoring reads every
whole text of the table in one map.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_and_bytes, least_hashed, small_batches

_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]^~\\_=+@", np.uint8)
_PAUSES = np.frombuffer(b".,;:'\"()-", np.uint8)
N_FEATURES = 18
LEAST_ROWS = 20
SPLITS = 5


def features(raw: bytes | None) -> np.ndarray:
    """Shape of a whole text: character classes, word lengths, repetition of words and lines, size. Zeros if empty."""
    raw = raw or b""
    out = np.zeros(N_FEATURES)
    words = raw.split()
    if not words:
        return out
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    distinct = len(set(words))
    out[:] = (
        count[_SYMBOLS].sum(), count[_PAUSES].sum(), count[33] + count[63], count[65:91].sum(), count[97:123].sum(),
        count[48:58].sum(), count[128:].sum(), count[10], count[_SYMBOLS].max(), np.sqrt(count[_SYMBOLS].sum()),
        np.sqrt(count[33] + count[63]), len(raw) / n, np.log1p(n), distinct / n, np.log(n / distinct),
        sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)))
    return out


@dataclass
class Model:
    """Standardised features -> tanh layer -> score."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


DECAY = 1e-3  # of the weights


def risk(params: list[np.ndarray], p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, list[np.ndarray]]:
    """(risk, gradients of a step) of a batch of positives and one of unlabelled rows, with the logistic loss.

    The risk is prior * loss(positives as such) + max(0, loss(unlabelled as
    negatives) - prior * loss(positives as negatives)). Where the second part
    is below zero, the step goes up on that part alone, as in the published
    rule, so that it can't be driven negative."""
    z = np.vstack([p, u])
    h = np.tanh(z @ params[0] + params[1])
    f = h @ params[2] + params[3][0]
    fp, fu = f[:len(p)], f[len(p):]
    neg = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    gp_pos = -prior * (1 - _sigmoid(fp)) / len(p)
    gp_neg, gu_neg = -prior * _sigmoid(fp) / len(p), _sigmoid(fu) / len(u)
    g = np.concatenate([gp_pos + gp_neg, gu_neg] if neg >= 0 else [-gp_neg, -gu_neg])
    back = np.outer(g, params[2]) * (1 - h * h)
    decay = DECAY / 2 * ((params[0] ** 2).sum() + (params[2] ** 2).sum())
    return (float(prior * np.logaddexp(0, -fp).mean() + max(0.0, neg) + decay),
            [z.T @ back + DECAY * params[0], back.sum(0), h.T @ g + DECAY * params[2], np.array([g.sum()])])


def train(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 12, epochs: int = 80, batch: int = 256,
          rate: float = 0.01, seed: int = 7) -> Model:
    """Minimise the non-negative PU risk by Adam, one mixed batch of both samples a step."""
    rng = np.random.default_rng(seed)
    m = Model(unl.mean(0), unl.std(0) + 1e-6, rng.normal(0, 0.3, (unl.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 0.3, hidden), 0.0, prior)
    zp, zu = (np.clip((x - m.mean) / m.scale, -6, 6) for x in (pos, unl))
    params = [m.w1, m.b1, m.w2, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = max(1, len(zu) // batch)
    t = 0
    for _ in range(epochs):
        op, ou = rng.permutation(len(zp)), rng.permutation(len(zu))
        for k in range(steps):
            p = zp[op[k * len(zp) // steps:(k + 1) * len(zp) // steps]]
            u = zu[ou[k * len(zu) // steps:(k + 1) * len(zu) // steps]]
            if not len(p) or not len(u):
                continue
            grads = risk(params, p, u, prior)[1]
            t += 1
            for i, gr in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * gr
                second[i] = 0.999 * second[i] + 0.001 * gr * gr
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3][0])
    return m


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 7) -> float:
    """Share of positives in the unlabelled sample: best bin estimation, over SPLITS random halves.

    A first network tells the samples apart on half of each; over the other
    halves, the least ratio of the unlabelled to the positive share above a
    score, with a confidence margin, bounds the prior from above. So the least
    of the bounds is taken.
    """
    hp, hu = len(pos) // 2, len(unl) // 2
    if not hp or not hu:
        return 0.5
    found = []
    for k in range(SPLITS):
        rng = np.random.default_rng(seed + k)
        p, u = rng.permutation(pos), rng.permutation(unl)
        m = train(p[:hp], u[:hu], 0.5, epochs=30, seed=seed + k)
        sp, su = np.sort(m.logit(p[hp:])), np.sort(m.logit(u[hu:]))
        best = (np.inf, 1.0)
        margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
        for q in np.arange(0.05, 1.0, 0.05):
            t = np.quantile(sp, 1 - q)
            top_p, top_u = (sp >= t).mean(), (su >= t).mean()
            best = min(best, ((top_u + margin) / top_p, top_u / top_p))
        found.append(best[1])
    return float(np.clip(min(found), 0.05, 0.98))


def committee(pos: np.ndarray, unl: np.ndarray, prior: float, seed: int = 7) -> Model:
    """One network that averages the scores (before the logistic function) of SPLITS networks from different starts."""
    nets = [train(pos, unl, prior, seed=seed + k) for k in range(SPLITS)]
    return Model(nets[0].mean, nets[0].scale, np.hstack([m.w1 for m in nets]), np.concatenate([m.b1 for m in nets]),
                 np.concatenate([m.w2 for m in nets]) / SPLITS, float(np.mean([m.b2 for m in nets])), prior)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, fit_rows: int = 6000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """Train on the documents for which `learn_from` (a condition on doc_id) holds.

    At most fit_rows positives and fit_rows unlabelled documents are read.
    Of several texts with one id, the one of least features is read. With
    fewer than LEAST_ROWS of either, nothing is learned and the model scores
    everything 0.5.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).where(learn_from & F.col("doc_id").isNotNull())
    good = (labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("doc_id"))
            .where(learn_from).distinct())
    ids = ids.distinct()
    unl = [r[0] for r in least_hashed(ids, fit_rows, "doc_id").collect()]
    pos = [r[0] for r in least_hashed(ids.join(good, "doc_id", "left_semi"), fit_rows, "doc_id").collect()]
    if min(len(unl), len(pos)) < LEAST_ROWS:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), 0.0, 0.5)
    wanted = sorted({*unl, *pos})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.array(wanted, np.int64)
        for batch in batches:
            part = batch.filter(pa.array(np.isin(batch.column(0).to_numpy(zero_copy_only=False), keep)))
            x = [features(raw).tolist() for raw in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    # at most 2 * fit_rows ids go out with the task and as many rows of 18 numbers come back
    rows = id_and_bytes(docs, id_col, text_col).where(F.col("doc_id").isNotNull() & learn_from).mapInArrow(
        run, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x")).collect()
    x = {r["doc_id"]: np.array(r["x"]) for r in rows}
    p, u = (np.array([x[i] for i in own]) for own in (pos, unl))
    return committee(p, u, estimate_prior(p, u))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row per input row; score in 0..1, higher for text like the trusted positives.

    Null, empty and blank texts are scored like a text without words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            x = np.array([features(raw) for raw in batch.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score at or above the threshold. Null, empty and blank texts are scored like a
    text without words, repeated rows like any; an empty table stays empty."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at):
            raws = batch.column(at).cast(pa.binary()).to_pylist()
            x = np.array([features(raw) for raw in raws]).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
