"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Benchmark items are the query set and are held in slices of bounded size; every
document is scanned against every slice.

1. A first scan counts in how many documents each n-gram of an item occurs.
2. The seeds of a document and an item are the rarest of the item's n-grams
   that the document really holds. A seed points at a passage: where the item
   would start, with room for edits on both sides.
3. A passage with too few words of the item to reach the threshold is left out;
   no alignment matches more words than that, so this is exact.
4. Passage and item are aligned word by word (local alignment, linear gaps).
   The score is the share of the best possible one, so edited, cut or
   paraphrased copies score between 0 and 1.
5. Where the rarest n-grams lead to no such passage, all n-grams that the
   document holds of the item are seeds: rarity decides the order, not the
   result.

Letters of scripts that are written without spaces are words of their own, so
items in them are met by n-grams of characters. Items of fewer words than an
n-gram are seeds as a whole and must be held as they stand.

The scans are maps over the documents; one row per n-gram is shuffled, so a hot
source or a copied document is only more rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_and_bytes, small_batches

#: letters of scripts without spaces between words (fixed values: Thai, Lao, Myanmar, Khmer, kana, Han)
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_LONG_BYTES = re.compile(rb"[\xe0-\xf4]")  # first bytes of characters that can be among them

#: ASCII letters and digits kept, other ASCII to a space; bytes of other scripts are kept
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

MATCH, MISMATCH, GAP = 2, -1, -1
RAREST = 4  # seeds of a document and an item that are tried first


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, lower-cased: runs of ASCII letters, digits and any non-ASCII characters, letters of unspaced
    scripts one by one."""
    if not raw:
        return []
    text = raw.decode("utf-8", "replace").lower()
    if _LONG_BYTES.search(raw):
        text = _UNSPACED.sub(r" \1 ", text)
    return text.encode().translate(_FOLD).split()


@dataclass
class Index:
    """A slice of the benchmark: word numbers, the items as numbers, and where each n-gram occurs."""
    n: int
    vocab: dict[bytes, int]
    items: list[tuple[int, np.ndarray]]
    grams: np.ndarray                       # distinct n-gram keys, sorted
    places: np.ndarray = field(repr=False)  # rows (gram, item, offset) by gram
    first: np.ndarray = field(repr=False)   # of each gram in places, one more at the end
    held: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64), repr=False)  # documents that hold each gram
    threshold: float = 0.4                  # least share of the best score

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of n-grams made of benchmark words only, and their keys."""
        m = len(ids) - self.n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        known = ids > 0
        run = known[:m].copy()
        for j in range(1, self.n):
            run &= known[j:j + m]
        at = np.flatnonzero(run)
        key = np.zeros(len(at), np.uint64)
        for j in range(self.n):
            key = key * np.uint64(len(self.vocab) + 1) + ids[at + j].astype(np.uint64)
        return at, key

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in the text, gram number) of every n-gram of the benchmark found in a text."""
        at, key = self.keys(ids)
        if not len(at) or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = np.minimum(np.searchsorted(self.grams, key), len(self.grams) - 1)
        ok = self.grams[g] == key
        return at[ok], g[ok]


LEAST_LETTERS = 8  # of an item of fewer words than an n-gram: shorter ones can't be told from chance


def build_indexes(rows: list[tuple[int, bytes | None]], n: int = 3, threshold: float = 0.4) -> list[Index]:
    """Indexes of benchmark items given as (item_id, UTF-8 text): one of all items of n words or more, and one for each
    smaller number of words, whose items must be matched whole. Items without a word and short ones of fewer than
    LEAST_LETTERS characters are left out."""
    by_size: dict[int, list] = {}
    for i, raw in rows:
        words = words_of(raw)
        if words and (len(words) >= n or len(b"".join(words).decode()) >= LEAST_LETTERS):
            by_size.setdefault(min(n, len(words)), []).append((i, words))
    return [build_index(texts, m, threshold if m == n else 1.0) for m, texts in sorted(by_size.items(), reverse=True)]


def build_index(texts: list[tuple[int, list[bytes]]], n: int = 3, threshold: float = 0.4) -> Index:
    """Index of items given as (item_id, words)."""
    vocab = {w: k for k, w in enumerate(sorted({w for _, ws in texts for w in ws}), 1)}
    if (len(vocab) + 1) ** n >= 1 << 64:
        raise ValueError("slice too large for 64-bit n-gram keys; use smaller slices")
    index = Index(n, vocab, [], np.zeros(0, np.uint64), np.zeros((0, 3), np.int64), np.zeros(1, np.int64), threshold=threshold)
    index.items = [(i, index.numbers(ws)) for i, ws in texts]
    parts = [(key, k, at) for k, (_, ids) in enumerate(index.items) for at, key in [index.keys(ids)]]
    if parts:
        key = np.concatenate([p[0] for p in parts])
        item = np.concatenate([np.full(len(p[0]), p[1]) for p in parts])
        at = np.concatenate([p[2] for p in parts])
        index.grams, gram = np.unique(key, return_inverse=True)
        order = np.lexsort((at, item, gram))
        index.places = np.stack([gram, item, at], 1)[order]
        index.first = np.searchsorted(index.places[:, 0], np.arange(len(index.grams) + 1))
    index.held = np.zeros(len(index.grams), np.int64)
    return index


def places_of(index: Index, at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, where it would start, documents that hold the n-gram) of every hit, by item and start."""
    count = index.first[gram + 1] - index.first[gram]
    rows = np.repeat(index.first[gram], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item, start = index.places[rows, 1], np.repeat(at, count) - index.places[rows, 2]
    order = np.lexsort((start, item))
    return item[order], start[order], np.repeat(index.held[gram], count)[order]


def rarest(item: np.ndarray, held: np.ndarray, k: int = RAREST) -> np.ndarray:
    """Mask of the hits of each item whose n-gram is among the k rarest hits of it (all that are as rare as the last)."""
    order = np.lexsort((held, item))
    first = np.flatnonzero(np.append(True, np.diff(item[order]) > 0))
    size = np.diff(np.append(first, len(item)))
    last = held[order][first + np.minimum(size, k) - 1]
    out = np.zeros(len(item), bool)
    out[order] = held[order] <= np.repeat(last, size)
    return out


def passages(index: Index, item: np.ndarray, start: np.ndarray, n_words: int) -> list[tuple[int, int, int]]:
    """(item, start, end) stretches of a text to align, from seeds by item and start: seeds of one item that lie close
    together make one passage. A stretch longer than six items is cut into overlapping ones, each wide enough for a whole
    alignment."""
    out = []
    edges = np.flatnonzero(np.diff(item)) + 1
    for part in np.split(np.arange(len(item)), edges) if len(item) else ():
        k = int(item[part[0]])
        size = len(index.items[k][1])
        room = size // 2 + 4
        s = start[part]
        for group in np.split(s, np.flatnonzero(np.diff(s) > 2 * room + size) + 1):
            lo, hi = max(0, int(group[0]) - room), min(n_words, int(group[-1]) + size + room)
            step, wide = 3 * size, 6 * size
            while hi - lo > wide:
                out.append((k, lo, lo + wide))
                lo += step
            out.append((k, lo, hi))
    return out


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and the text position where it ends; all pairs at once, row by row.

    Word 0 stands for words outside the benchmark and matches nothing.
    """
    n = max(map(len, items))
    m = max(map(len, texts))
    a = np.full((len(items), n), -1, np.int32)
    b = np.zeros((len(items), m), np.int32)
    for i, (x, y) in enumerate(zip(items, texts)):
        a[i, :len(x)] = x
        b[i, :len(y)] = y
    # a step to the right costs a gap: a running maximum of scores with the gaps so far taken out
    ramp = (np.arange(m + 1) * -GAP).astype(np.int32)
    last = np.zeros((len(items), m + 1), np.int32)
    best = np.zeros(len(items), np.int32)
    end = np.zeros(len(items), np.int64)
    for i in range(n):
        here = np.zeros_like(last)
        here[:, 1:] = np.maximum(last[:, :-1] + np.where(a[:, i, None] == b, MATCH, MISMATCH), last[:, 1:] + GAP)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + ramp, axis=1) - ramp
        here[a[:, i] < 0] = 0  # past the item's end
        top = here.max(axis=1)
        better = top > best
        end[better] = here[better].argmax(axis=1)
        best = np.maximum(best, top)
        last = here
    return best, end


def may_reach(item: np.ndarray, text: np.ndarray, threshold: float) -> bool:
    """Whether the words of the item in a text, all matched, would reach the threshold: exact, as no alignment has more."""
    return np.count_nonzero(np.isin(text, item)) / len(item) >= threshold


def _aligned(index: Index, numbers: list[np.ndarray], todo: list[tuple[int, int, int, int]], found: dict, pairs_at_once: int) -> None:
    """Align (text, item, start, end) passages; `found` keeps the best of each text and item at or above the threshold."""
    todo = sorted((p for p in todo if may_reach(index.items[p[1]][1], numbers[p[0]][p[2]:p[3]], index.threshold)),
                  key=lambda p: p[3] - p[2])
    for at in range(0, len(todo), pairs_at_once):
        part = todo[at:at + pairs_at_once]
        items = [index.items[k][1] for _, k, _, _ in part]
        best, end = align(items, [numbers[d][lo:hi] for d, _, lo, hi in part])
        for (d, k, lo, _), x, score, e in zip(part, items, best.tolist(), end.tolist()):
            share = score / (MATCH * len(x))
            if share >= index.threshold and share > found.get((d, k), (0.0,))[0]:
                found[d, k] = (share, max(lo, lo + e - len(x)), lo + e)


def matches(index: Index, numbers: list[np.ndarray], pairs_at_once: int = 512) -> list[tuple]:
    """(text, item_id, score, start word, end word) of the best passage of each text and item at or above the threshold:
    of those that the rarest n-grams lead to, and of all passages where these fall short."""
    first, hits = [], {}
    for d, ids in enumerate(numbers):
        at, gram = index.hits(ids)
        if len(at):
            item, start, held = places_of(index, at, gram)
            rare = rarest(item, held)
            first += [(d, *p) for p in passages(index, item[rare], start[rare], len(ids))]
            if not rare.all():
                hits[d] = (item, start, np.unique(item[~rare]))
    found: dict[tuple[int, int], tuple] = {}
    _aligned(index, numbers, first, found, pairs_at_once)
    tried, rest = set(first), []
    for d, (item, start, more) in hits.items():
        more = [k for k in more.tolist() if (d, k) not in found]
        left = np.isin(item, more)
        rest += [p for p in ((d, *p) for p in passages(index, item[left], start[left], len(numbers[d]))) if p not in tried]
    _aligned(index, numbers, rest, found, pairs_at_once)
    return [(d, index.items[k][0], *v) for (d, k), v in sorted(found.items())]


def count_held(index: Index, docs: DataFrame, id_col: str, text_col: str) -> None:
    """Fill in how many documents hold each n-gram of the index: partial sums of each task, one row an n-gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(index.grams), np.int64)
        for batch in small_batches(batches):
            for raw in batch.column(1).to_pylist():
                held[np.unique(index.hits(index.numbers(words_of(raw)))[1])] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["gram", "n"])

    counts = id_and_bytes(docs, id_col, text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in counts.collect():  # n-grams of one slice at most
        index.held[r["gram"]] = r["n"]


def slices(benchmark: DataFrame, item_col: str, text_col: str, slice_mb: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in slices of about slice_mb of text: one slice for any usual benchmark, as many as it takes else."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("raw"))
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n = total // (slice_mb << 20) + 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(n)) == k)
        got = [(r["item_id"], bytes(r["raw"]) if r["raw"] is not None else None) for r in part.collect()]
        yield sorted(got, key=lambda r: (r[0] is None, r[0], r[1] or b""))


FOUND = "doc_id long, item_id long, score double, start_word long, end_word long"


def _indexes(docs: DataFrame, benchmark: DataFrame, threshold: float, n: int, slice_mb: int, id_col: str, text_col: str,
             item_col: str, item_text: str) -> Iterator[list[Index]]:
    """Of one slice after the other, with the counts."""
    for rows in slices(benchmark, item_col, item_text, slice_mb):
        indexes = build_indexes(rows, n, threshold)
        for index in indexes:
            count_held(index, docs, id_col, text_col)
        yield indexes


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, n: int = 3, slice_mb: int = 8,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): documents that hold a copy of a benchmark item.

    score is the alignment score as a share of the item's best, the words are
    counted as in words_of. Null and empty texts on either side match nothing.
    Items of fewer than n words match where they stand whole, with score 1, and
    are no evidence below LEAST_LETTERS characters. Repeated documents and
    items each give their rows. No item or no document: no row.
    """
    out = docs.sparkSession.createDataFrame([], FOUND)
    for index in chain.from_iterable(
            _indexes(docs, benchmark, threshold, n, slice_mb, id_col, text_col, item_col, item_text)):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = matches(index, [index.numbers(words_of(raw)) for raw in batch.column(1).to_pylist()])
                cols = list(zip(*((ids[d], *rest) for d, *rest in found))) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", "item_id", "score", "start_word", "end_word"])

        out = out.unionAll(id_and_bytes(docs, id_col, text_col).mapInArrow(run, FOUND))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.4, n: int = 3, slice_mb: int = 8,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all columns, that hold no copy of a benchmark item at or above the threshold.

    Documents with a null or empty text, repeated ones and ones without an id stay or go like any other, by their text;
    an empty benchmark or table changes nothing."""
    kept, at = docs, docs.columns.index(text_col)
    for indexes in _indexes(docs, benchmark, threshold, n, slice_mb, id_col, text_col, item_col, item_text):
        if not indexes:
            continue

        # one map for all indexes of a slice: each map of a chain would keep a Python worker of its own at every core
        def run(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, at):
                words = [words_of(raw) for raw in batch.column(at).cast(pa.binary()).to_pylist()]
                bad = {f[0] for index in indexes for f in matches(index, [index.numbers(ws) for ws in words])}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
