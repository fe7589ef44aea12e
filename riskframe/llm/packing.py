"""Packing token sequences with minimum bin slack over the multiset of lengths.

Every document is tokenised once, closed by an end id and cut into full windows
and one remainder. Full windows are sequences already. Remainders matter only
through their lengths, so the plan works on a histogram of at most
capacity - 1 lengths whatever the number of documents:

* Minimum bin slack: a bitset subset-sum over the remaining multiset (each
  length with its count, binary-split) gives all reachable fills at once; the
  largest one up to the capacity is taken and its counts are backtracked.
* A fill found is used as often as the counts allow before the next search, so
  the plan has a few thousand patterns at most, not one per sequence.
* When no fill reaches the capacity any more, what is left is laid end to end
  and cut at window ends; the last window is cut into powers of two, which need
  no padding.

Each remainder gets a dense rank within its length (counts per partition and
length, prefix sums, then a join), and the rank alone decides its pattern,
sequence and offset.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import chunks, small_batches, stored

_BATCH_CHARS = 1 << 20
_CACHE_ROWS = 250_000   # of each half of the token cache in one worker: speed only
_CACHE_WORD = 48

# the byte-level pre-tokens, of the characters that Python and the tokenizer class alike: see _Pieces.made
# (letters first, ASCII ones apart: a set of few characters is tested faster than a class)
_PIECE = re.compile(r" ?(?:[A-Za-z]++|[^\W\d_]++)++|'(?:[stmd]|re|ve|ll)| ?\d++| ?(?:[^\w\s]|_)++|\s+(?!\S)|\s+")
_UNSURE = {"Nl", "No", "Cn"}  # numerals that are no digits, and what this Python's Unicode does not know


class _Whole(Exception):
    """A text with characters that Python may class differently: it goes through the whole tokenizer."""


class _Pieces(dict):
    """Pre-token -> its ids as little-endian uint32 bytes, from the tokenizer's model.

    A cache of two halves of at most _CACHE_ROWS pre-tokens: a full one becomes
    the old one, and what is met again moves back, so frequent pre-tokens stay
    however many rare ones a worker meets.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.old: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        # the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

    def made(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable() and (first := piece.lstrip(" ")):
            text = self.alphabet[32] * (len(piece) - len(first)) + first  # printable ASCII stands for itself
        else:
            if not piece.lstrip(" ").isalpha() and (piece.isspace() and piece.strip(" \n") or not piece.isascii() and any(
                    unicodedata.category(c) in _UNSURE for c in piece)):
                raise _Whole
            text = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.made(piece)
            if len(piece) > _CACHE_WORD:
                return ids
        if len(self) >= _CACHE_ROWS:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        get, found, whole = self.__getitem__, [], []
        for i, text in enumerate(texts):
            try:
                found.append(b"".join(map(get, _PIECE.findall(text))))
            except _Whole:
                found.append(b"")
                whole.append(i)
        if whole:
            for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
                found[i] = array("I", e.ids).tobytes()
        return found


_LOADED: dict[str, _Pieces] = {}


def encoder(path: str) -> _Pieces:
    """The tokenizer of a vocabulary file, kept for the life of a worker process."""
    if path not in _LOADED:
        _LOADED[path] = _Pieces(path)
    return _LOADED[path]


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("part", T.LongType()), T.StructField("nth", T.LongType())])


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per window of a document: ids (little-endian uint32), start, length, and (part, nth): its place among the
    pieces of that length written by one task. Null text counts as empty: the end id alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        words, seen = encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in small_batches(batches):
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, run_of in chunks(texts, len, _BATCH_CHARS):
                cols: list[list] = [[], [], [], [], [], []]
                for i, ids in enumerate(words.encode(run_of)):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        k = min(capacity, n - s)
                        for col, v in zip(cols, (doc_ids[first + i], s, k, ids[4 * s:4 * (s + k)], n, int(seen[k]))):
                            col.append(v)
                        seen[k] += 1
                types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types)]
                arrays.insert(5, pa.array(np.full(len(cols[0]), part, np.int64)))
                yield pa.RecordBatch.from_arrays(arrays, names=PIECES.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Slot:
    """Where pieces of one length go, by rank from `first` on.

    per > 0: ranks in runs of `per`, one run per sequence from `bin0` on, each
    run laid end to end from offset `at`. per = 0: laid end to end on a line of
    windows that starts at sequence `bin0`; `at` is the first one's place on
    that line, which may cross window ends, so pieces are cut there.
    """
    first: int
    count: int
    per: int
    bin0: int
    at: int


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length fill a window closest to the capacity: bitset subset sums, then backtracking.

    Lengths are taken longest first, each with its count split into powers of
    two, so a window is met with few long pieces where sums tie.
    """
    full = (1 << capacity + 1) - 1
    items, reach, before = [], 1, []
    for length in sorted(counts, reverse=True):
        left, k = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(k, left)
            before.append(reach)
            items.append((length, take))
            reach |= reach << length * take & full
            left -= take
            k *= 2
    total, used = reach.bit_length() - 1, {}
    for (length, take), was in zip(reversed(items), reversed(before)):
        if not was >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


@dataclass(frozen=True)
class Plan:
    """Slots of each length in rank order, the number of sequences, and the window ends on the line of cut pieces."""
    slots: dict[int, list[Slot]]
    sequences: int
    line_end: int
    capacity: int

    def window(self, at: int) -> tuple[int, int, int]:
        """(window number, its first place, its end) of a place on the line: full windows, then powers of two."""
        whole = self.line_end // self.capacity
        if at < whole * self.capacity:
            w = at // self.capacity
            return w, w * self.capacity, (w + 1) * self.capacity
        first, w = whole * self.capacity, whole
        while True:
            size = 1 << (self.line_end - first).bit_length() - 1
            if at < first + size:
                return w, first, first + size
            first, w = first + size, w + 1

    def parts(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, sequence, offset) of each part of a piece; one part unless the piece is cut."""
        slots = self.slots[length]
        slot = slots[bisect_right(slots, rank, key=lambda s: s.first) - 1]
        i = rank - slot.first
        if slot.per:
            return [(length, slot.bin0 + i // slot.per, slot.at + length * (i % slot.per))]
        at, out, need = slot.at + i * length, [], length
        while need:
            w, first, end = self.window(at)
            take = min(need, end - at)
            out.append((take, slot.bin0 + w, at - first))
            at += take
            need -= take
        return out


def plan(histogram: dict[int, int], capacity: int = 1024) -> Plan:
    """Places for every piece of a histogram of lengths (length -> count). Empty histogram: no sequence."""
    left = {k: v for k, v in histogram.items() if v > 0}
    done = dict.fromkeys(left, 0)
    slots: dict[int, list[Slot]] = {k: [] for k in left}
    bins = 0

    def place(length: int, count: int, per: int, at: int) -> None:
        slots[length].append(Slot(done[length], count, per, bins, at))
        done[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]

    while left:
        used = best_fill(left, capacity)
        if sum(k * n for k, n in used.items()) < capacity:
            break
        times = min(left[k] // n for k, n in used.items())
        at = 0
        for k in sorted(used, reverse=True):
            place(k, used[k] * times, used[k], at)
            at += k * used[k]
        bins += times
    # no window can be filled exactly any more: the rest goes on one line, cut at window ends
    at = 0
    for k in sorted(left, reverse=True):
        n = left[k]
        place(k, n, 0, at)
        at += k * n
    return Plan(slots, bins + at // capacity + bin(at % capacity).count("1"), at, capacity)


PARTS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("at", "size", "sequence_id", "offset")]))


def _parts_of(how: Plan):
    """A function of (length, rank) that gives a piece's parts; the ids themselves stay in the JVM."""
    def run(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        cols, ends = ([], [], [], []), [0]
        for length, rank in zip(lengths.to_pylist(), ranks.to_pylist()):
            at = 0
            for size, seq, offset in how.parts(length, rank):
                for col, v in zip(cols, (at, size, seq, offset)):
                    col.append(v)
                at += size
            ends.append(len(cols[0]))
        names = PARTS.elementType.names
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names))

    return F.arrow_udf(run, PARTS)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece, each token in exactly one.

    ids are little-endian unsigned 32-bit token ids, the end id last in each
    document. Sequences hold at most `capacity` tokens, gapless from offset 0;
    all but at most log2(capacity) of them are full, those are powers of two.
    Null and empty texts are one end id. Repeated rows and null ids are packed
    like any other row; other columns are not read. Empty table: no row.
    """
    pieces = stored(tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces", "zstd")
    counts = pieces.where(F.col("length") < capacity).groupBy("length", "part").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    how = plan(histogram, capacity)  # at most capacity - 1 counts came to the driver
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("l"), F.col("part").alias("p"),
                          F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    short = pieces.where(F.col("length") < capacity).join(bases, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p")))
    placed = short.select(*PIECES.names[:5], F.explode(_parts_of(how)("length", F.col("base") + F.col("nth"))).alias("p"))
    placed = placed.select("doc_id", (F.col("start") + F.col("p.at")).alias("start"), F.col("p.size").alias("length"),
                           F.expr("substring(ids, CAST(4 * p.at + 1 AS INT), CAST(4 * p.size AS INT))").alias("ids"), "doc_tokens",
                           "p.sequence_id", "p.offset")
    full = pieces.where(F.col("length") == capacity).select(
        *PIECES.names[:5], ((F.col("part") + 1) * F.lit(1 << 33) + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionAll(placed)
