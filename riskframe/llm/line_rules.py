"""Quality rules by line labelling: counts over the text, and a linear-chain CRF over its lines.

Each line with a word is content or boilerplate. A CRF scores the labels from
features of the line and the change of label from line to line; Viterbi decodes
the best labelling of the whole text, and the share of words on content lines
decides whether the document stays. The CRF is trained on a bounded sample of
labelled documents, with weak line labels: lines of good documents are content
unless they repeat an earlier line, lines of bad ones are boilerplate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import chunks, id_and_bytes, least_hashed

_SPACE = b" \t\n\x0b\x0c\r"
_RULE_SYMBOLS = b"#*$%&|<>"
_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_HIGH = bytes(range(128, 256))
_CONTINUED = bytes(range(128, 192))  # UTF-8 bytes that don't begin a code point
N_FEATURES = 12
_BATCH_BYTES = 1 << 24
CHANGE_DECAY = 0.1  # of the label changes: evidence of a line weighs more than its neighbours' labels


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text, the first finding included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((count[w] > 1 for w in windows), bool, len(windows)))
    covered[at] += 1
    np.add.at(covered, np.minimum(at + 3, len(words)), -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def line_features(line: bytes, words: list[bytes], seen: bool) -> tuple:
    """Shape of one line with a word: symbol, case, digit and repetition shares, length, and whether it came before."""
    size, n = len(line), len(words)
    less = lambda drop: (size - len(line.translate(None, drop))) / size
    distinct = len(set(words)) / n
    return (1.0, less(_RULE_SYMBOLS), min(1.0, 5 * less(_RULE_SYMBOLS)), less(_UPPER), less(_DIGITS), less(b"!?"),
            float(seen), min(n, 40) / 40, distinct, sum(map(eq, words, words[1:])) / n,
            float(line.rstrip()[-1:] in (b".", b"!", b"?", b":")), less(_LOWER + _HIGH))


@dataclass
class Text:
    """Counts of a whole text, and the features and words of its lines that have a word."""
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: list[tuple]
    line_words: list[int]


def measure(raw: bytes | None) -> Text:
    """Words are runs of bytes other than ASCII white space; null counts as empty."""
    raw = raw or b""
    words = raw.split()
    solid = raw.translate(None, _SPACE)
    lines, sizes, seen, dup = [], [], set(), 0
    for line in raw.split(b"\n"):
        if own := line.split():
            again = line in seen
            dup += again
            seen.add(line)
            lines.append(line_features(line, own, again))
            sizes.append(len(own))
    return Text(len(words), len(solid.translate(None, _CONTINUED)), len(raw) - len(raw.translate(None, _RULE_SYMBOLS)),
                dup, repeated_words(words), lines, sizes)


@dataclass
class Crf:
    """Two labels, 0 boilerplate and 1 content: weight[label] of the line features, change[from, to]."""
    weight: np.ndarray
    change: np.ndarray

    def viterbi(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each text's lines. All texts step together, longest first, so each step works on a prefix."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        size = np.array([len(texts[i]) for i in order], np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(texts)
        if not len(size) or not size[0]:
            return out
        first = np.cumsum(size) - size
        score = np.concatenate([texts[i] for i in order if len(texts[i])]) @ self.weight.T
        live = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]  # texts with more than t lines
        best = score[first[:live[0]]].copy()
        back = []
        for t in range(1, int(size[0])):
            k = live[t]
            via = best[:k, :, None] + self.change
            back.append(via.argmax(1).astype(np.int8))
            best[:k] = via.max(1) + score[first[:k] + t]
        label = best.argmax(1).astype(np.int8)  # of the last line of each text
        labels = np.empty(len(score), np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            k = live[t]
            if t + 1 < size[0]:
                go = live[t + 1]
                label[:go] = back[t][np.arange(go), label[:go]]
            labels[first[:k] + t] = label[:k]
        for j, i in enumerate(order):
            out[i] = labels[first[j]:first[j] + size[j]]
        return out


def train(lines: list[np.ndarray], labels: list[np.ndarray], steps: int = 150, rate: float = 0.1, cut: int = 32) -> Crf:
    """Maximum likelihood by Adam on forward-backward; long texts are cut into runs of `cut` lines, all of which count."""
    parts = [(x[i:i + cut], y[i:i + cut]) for x, y in zip(lines, labels) for i in range(0, len(x), cut)]
    if not parts:
        return Crf(np.array([[0.0] * N_FEATURES, [1.0] + [0.0] * (N_FEATURES - 1)]), np.zeros((2, 2)))
    n, m = len(parts), max(len(x) for x, _ in parts)
    feats, truth, mask = np.zeros((n, m, N_FEATURES)), np.zeros((n, m), np.int64), np.zeros((n, m), bool)
    for i, (x, y) in enumerate(parts):
        feats[i, :len(x)], truth[i, :len(x)], mask[i, :len(x)] = x, y, True
    pair = mask[:, 1:]
    params = [np.zeros((2, N_FEATURES)), np.zeros((2, 2))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    onehot = np.eye(2)[truth] * mask[..., None]
    true_pairs = np.einsum("nti,ntj->ij", onehot[:, :-1] * pair[..., None], onehot[:, 1:])
    total = mask.sum()
    for step in range(1, steps + 1):
        emit = feats @ params[0].T
        fwd, bwd = np.zeros((n, m, 2)), np.zeros((n, m, 2))
        fwd[:, 0] = emit[:, 0]
        for t in range(1, m):
            new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + params[1], axis=1) + emit[:, t]
            fwd[:, t] = np.where(mask[:, t, None], new, fwd[:, t - 1])
        for t in range(m - 2, -1, -1):
            new = np.logaddexp.reduce(params[1] + (emit[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        z = np.logaddexp.reduce(fwd[:, -1], axis=1)
        node = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
        edge = np.exp(fwd[:, :-1, :, None] + params[1] + (emit + bwd)[:, 1:, None, :] - z[:, None, None, None]) * pair[..., None, None]
        grads = [np.einsum("nti,ntf->if", node - onehot, feats) / total + 1e-3 * params[0],
                 (edge.sum((0, 1)) - true_pairs) / total + CHANGE_DECAY * params[1]]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Crf(*params)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 1500, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Crf:
    """CRF from at most fit_rows labelled documents of each label, those of least hash of the id."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("good"))
    wanted: dict[int, int] = {}
    for good in (0, 1):
        rows = least_hashed(known.where(F.col("good") == good).select("doc_id").distinct(), fit_rows, "doc_id")
        wanted |= {r[0]: good for r in rows.collect() if r[0] is not None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.array(sorted(wanted), np.int64)
        for batch in batches:
            part = batch.filter(pa.array(np.isin(batch.column(0).to_numpy(zero_copy_only=False), keep)))
            x = [[list(f) for f in measure(raw).lines] for raw in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.list_(pa.list_(pa.float64())))], names=["doc_id", "x"])

    # at most 2 * fit_rows documents' line features come to the driver
    rows = (id_and_bytes(docs, id_col, text_col).where("doc_id is not null")
            .mapInArrow(run, "doc_id long, x array<array<double>>").groupBy("doc_id").agg(F.min("x").alias("x")).orderBy("doc_id").collect()) if wanted else []
    lines, tags = [], []
    for r in rows:
        x = np.array(r["x"]).reshape(-1, N_FEATURES)
        lines.append(x)
        tags.append((x[:, 6] == 0) * wanted[r["doc_id"]])
    return train(lines, tags)


RULED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "base_failed boolean, content_share double, kept boolean")


def ruled(docs: DataFrame, crf: Crf, least_share: float = 0.5, least_words: int = 50, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, content_share, kept): one row per input row, over the whole text.

    base_failed: fewer than least_words words, or over half of the words in
    repeated 3-word windows. kept: not base_failed and at least least_share of
    the words on content lines. Null and blank texts have no word and fail.
    """
    names = [f.split()[0] for f in RULED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            raws = batch.column(1).to_pylist()
            for first, part in chunks(raws, lambda r: len(r or b""), _BATCH_BYTES):
                texts = [measure(raw) for raw in part]
                tags = crf.viterbi([np.array(t.lines).reshape(-1, N_FEATURES) for t in texts])
                rows = []
                for t, tag in zip(texts, tags):
                    failed = t.n_words < least_words or 100 * t.n_repeat_words > 50 * t.n_words
                    share = float(np.dot(tag, t.line_words)) / t.n_words if t.n_words else 0.0
                    rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, share,
                                 not failed and share >= least_share))
                types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(part)), *cols], names=names)

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, RULED)
