"""Best-fit packing of whole documents by patterns of few documents.

Only documents longer than a sequence are cut, into full sequences and one
rest. What is left matters through its lengths alone, so the plan works on a
histogram of at most `capacity` lengths, whatever the number of documents:

1. Patterns of two or three documents that fill a sequence up to a small slack
   are enumerated over the lengths that occur.
2. Non-negative least squares fits how often each pattern repeats, so that all
   patterns together come as near to the histogram as they can.
3. The repeats are rounded, what rounding leaves going to the next pattern, and
   kept to what the counts allow. What is left is fitted again until a round places little.
4. The residual is packed largest first, each sequence filled by the lengths
   that close it best, as often as the counts allow.

Each piece has a dense rank within its length (counts by length and task,
prefix sums, then a join on narrow rows); the rank alone gives its place.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import chunks, id_and_text, stored

_BATCH_CHARS = 1 << 21
_CACHE_PARTS = 700_000   # of each worker: speed only
_CACHE_LETTERS = 40
_MARKS = string.punctuation.replace("'", "")  # an apostrophe may open a contraction

_SLACK = 4          # tokens a pattern may leave free
_PER_LENGTH = 12    # patterns kept for each longest length, least slack first
_FIT_STEPS = 300
_SEQUENCES_OF_TASK = 1 << 33


class _Parts(dict):
    """Part between single spaces -> its ids as little-endian uint32 bytes, for a tokenizer that drops white space.

    No pre-token of such a tokenizer reaches over a space, so the parts of a
    text are independent. A new part of letters and closing marks is looked up
    as the two, which recur more often than it does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        self[""] = b""

    def one(self, run: str) -> bytes:
        """Ids of one pre-token of lower-case Latin-1 letters or of ASCII marks, which normalisation leaves as it is."""
        ids = self.get(run)
        if ids is None:
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
            if len(self) < _CACHE_PARTS and len(run) <= _CACHE_LETTERS:
                self[run] = ids
        return ids

    def learned(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of parts not met before."""
        out, rest = {}, []
        for p in parts:
            letters = p.rstrip(_MARKS)
            if (letters.isalpha() and letters.islower() or not letters) and _latin(p):
                ids = self.one(letters) if letters else b""
                out[p] = ids + self.one(p[len(letters):]) if len(letters) < len(p) else ids
            else:
                rest.append(p)
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            out[p] = array("I", e.ids).tobytes()
        for p, ids in out.items():
            if len(self) >= _CACHE_PARTS:
                break
            if len(p) <= _CACHE_LETTERS:
                self[p] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        # lower case is by letter in Latin-1, so such texts are lowered at once and share more parts
        split = [(t.lower() if _latin(t) else t).replace("\n", " ").split(" ") for t in texts]
        ids = [list(map(self.get, parts)) for parts in split]
        gaps = [_gaps(of) for of in ids]
        new = self.learned({parts[k] for parts, at in zip(split, gaps) for k in at})
        for parts, of, at in zip(split, ids, gaps):
            for k in at:
                of[k] = new[parts[k]]
        return [b"".join(of) for of in ids]


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _gaps(values: list) -> list[int]:
    """Places of None."""
    out, at = [], -1
    try:
        while True:
            at = values.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


_LOADED: dict[str, _Parts] = {}


def encoder(path: str) -> _Parts:
    """The tokenizer of a vocabulary file, kept for the life of a worker process."""
    if path not in _LOADED:
        _LOADED[path] = _Parts(path)
    return _LOADED[path]


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("part", T.LongType()), T.StructField("nth", T.LongType())])
_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece of a document, whole unless longer than `capacity`: its ids (little-endian uint32) and their
    CRC-32, and (part, nth): its place among the pieces of that length written by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        parts, seen = encoder(tokenizer), np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for first, some in chunks(texts, len, _BATCH_CHARS):
                rows = []
                for i, ids in enumerate(parts.encode(some)):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[s:s + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc_ids[first + i], k, s // 4, n, crc32(own), own, part, int(seen[n])))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=PIECES.names)

    return id_and_text(docs).mapInArrow(run, PIECES)


# ------------------------------------------------------------------ the plan: histogram -> places


def patterns(lengths: np.ndarray, capacity: int, least: int = 0) -> np.ndarray:
    """Patterns of two or three of the given lengths (ascending), as positions in them, longest first and over `least`.

    A third member of -1 stands for none. For each first and second length the
    longest third that fits is taken; patterns that leave more than a few
    tokens free are left to the residual.
    """
    members = []
    for i in range(len(lengths) - 1, np.searchsorted(lengths, least, "right") - 1, -1):
        room = capacity - lengths[i]
        second = np.arange(min(i + 1, np.searchsorted(lengths, room, "right")))
        if not len(second):
            continue
        gap = room - lengths[second]
        third = np.minimum(np.searchsorted(lengths, gap, "right") - 1, second)
        slack = np.where(third < 0, gap, gap - lengths[third])
        best = np.flatnonzero(slack <= _SLACK)
        best = best[np.argsort(slack[best], kind="stable")]
        if len(best) > _PER_LENGTH:  # spread over the second lengths among equal slack
            tight = best[slack[best] == 0]
            best = tight[np.linspace(0, len(tight) - 1, _PER_LENGTH).astype(int)] if len(tight) >= _PER_LENGTH else best[:_PER_LENGTH]
        members.append(np.column_stack([np.full(len(best), i), second[best], third[best]]))
    return np.concatenate(members) if members else np.zeros((0, 3), int)


def fitted_repeats(members: np.ndarray, counts: np.ndarray, steps: int = _FIT_STEPS) -> np.ndarray:
    """x >= 0 that minimises |A x - counts|^2, A[length, pattern] = times the length is in the pattern.

    Accelerated projected gradient; rows are scaled by 1 / sqrt(count), so that
    rare lengths weigh as much as common ones.
    """
    k, n = members.shape
    at = np.where(members < 0, len(counts), members)  # none goes to a bin of its own
    weight = np.append(1 / np.maximum(counts, 1), 0.0)
    target = np.append(counts, 0.0)
    product = lambda x: np.bincount(at.ravel(), np.repeat(x, n), len(target))
    # the largest eigenvalue of A'WA is at most the largest sum of a row of it
    step = 1 / max((weight * product(np.ones(k)))[at].sum(axis=1).max(), 1e-12)
    x = y = np.zeros(k)
    t = 1.0
    for _ in range(steps):
        slope = (weight * (product(y) - target))[at].sum(axis=1)
        new = np.maximum(y - step * slope, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_closing(have: np.ndarray, left: np.ndarray, gap: int) -> dict[int, int]:
    """Lengths (with counts) that fill `gap` as fully as few looks can: one, two, or the longest few and then two."""
    used: dict[int, int] = {}

    def take(length: int) -> None:
        used[length] = used.get(length, 0) + 1
        left[length] -= 1
        have[length] = left[length] > 0

    def pair(room: int) -> int:
        """The longest of two lengths that fill the room; 0: none."""
        half = have[(room + 1) // 2:room]  # index j: length (room + 1) // 2 + j
        other = have[1:room // 2 + 1][::-1]
        both = np.flatnonzero(half & other)
        for j in both[::-1][:4]:
            a = (room + 1) // 2 + int(j)
            if a != room - a or left[a] > 1:
                return a
        return 0

    while gap > 0:
        if have[gap]:
            take(gap)
            break
        if a := pair(gap):
            take(a)
            take(gap - a)
            break
        fitting = np.flatnonzero(have[:gap])
        if not len(fitting):
            break
        choice = int(fitting[-1])
        for length in fitting[::-1][:12].tolist():
            left[length] -= 1
            have[length] = left[length] > 0
            closes = have[gap - length] or pair(gap - length)
            left[length] += 1
            have[length] = True
            if closes:
                choice = length
                break
        take(choice)
        gap -= choice
    for length, n in used.items():
        left[length] += n
        have[length] = True
    return used


@dataclass
class Plan:
    """Slots of each length by rank: `count` pieces from rank `first` on go `per` to a sequence, from sequence `bin0` on,
    end to end from offset `at`."""
    capacity: int
    sequences: int = 0
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, first, per, bin0, at
    done: dict[int, int] = field(default_factory=dict)

    def use(self, pattern: dict[int, int], times: int) -> None:
        """`times` sequences, each with these lengths (length -> how many)."""
        at = 0
        for length, per in sorted(pattern.items(), reverse=True):
            first = self.done.get(length, 0)
            self.rows.append((length, first, per, self.sequences, at))
            self.done[length] = first + per * times
            at += per * length
        self.sequences += times

    def arrays(self) -> np.ndarray:
        """The slots as five rows, sorted by length and first rank."""
        rows = np.array(self.rows, np.int64).reshape(-1, 5)
        return rows[np.lexsort((rows[:, 1], rows[:, 0]))].T.copy()


def _by_patterns(out: Plan, left: np.ndarray, least: int) -> bool:
    """One round: patterns over the lengths that are left, fitted, rounded and used. False if it placed little."""
    lengths = np.flatnonzero(left[:out.capacity])
    members = patterns(lengths, out.capacity, least)
    if not len(members):
        return False
    repeats = fitted_repeats(members, left[lengths].astype(float))
    before, carry = int(left.sum()), 0.0
    for j in np.flatnonzero(repeats > 1e-3).tolist():  # by first length: what rounding adds or takes goes to a like pattern
        carry += repeats[j]
        pattern: dict[int, int] = {}
        for i in members[j]:
            if i >= 0:
                length = int(lengths[i])
                pattern[length] = pattern.get(length, 0) + 1
        times = min([round(carry), *(int(left[k]) // n for k, n in pattern.items())])
        if times > 0:
            out.use(pattern, times)
            carry -= times
            for k, n in pattern.items():
                left[k] -= n * times
    return (before - int(left.sum())) * 50 >= before


def _residual(out: Plan, left: np.ndarray) -> None:
    """What no pattern took: largest first, each sequence closed as well as can be, as often as the counts allow."""
    have = left > 0
    longest = out.capacity
    while longest > 0:
        if not have[longest]:
            longest -= 1
            continue
        left[longest] -= 1
        have[longest] = left[longest] > 0
        pattern = best_closing(have, left, out.capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(int(left[k]) // n for k, n in pattern.items())
        out.use(pattern, times)
        for k, n in pattern.items():
            left[k] -= n * times
            have[k] = left[k] > 0


def plan(histogram: dict[int, int], capacity: int = 4096) -> Plan:
    """Places for every piece of a histogram (length up to the capacity -> count). Empty: no sequence.

    Patterns are fitted over all first lengths, over those above half a
    sequence first, or not at all where lengths are so few or so even that the
    residual step alone wastes less; the plan of fewest sequences is kept.
    """
    start = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        start[length] = n
    plans = []
    for rounds in ((0, 0), (capacity // 2, capacity // 2, 0, 0), (capacity // 2,), ()):
        out, left = Plan(capacity), start.copy()
        for least in rounds:
            if not _by_patterns(out, left, least) and not least:
                break
        _residual(out, left)
        plans.append(out)
    return min(plans, key=lambda p: (p.sequences, len(p.rows)))


def _place(how: Plan):
    length_of, first_of, per_of, bin_of, at_of = how.arrays()
    keys = (length_of << 48) + first_of

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        slot = np.searchsorted(keys, (n << 48) + r, "right") - 1
        i = r - first_of[slot]
        return pd.DataFrame({"sequence_id": bin_of[slot] + i // per_of[slot], "offset": at_of[slot] + n * (i % per_of[slot])})

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): one row per piece, each token in exactly one.

    ids are little-endian unsigned 32-bit token ids, the end id last in each
    document; ids_crc32 is their CRC-32, so that a reader who wants no ids
    reads none. A document is cut only if it is longer than `capacity`.
    Sequences hold at most `capacity` tokens, gapless from offset 0. Their ids
    are unique, not dense. Null and empty texts are one end id. Repeated rows
    and null ids are packed like any other row; other columns are not read.
    Empty table: no row.
    """
    pieces = stored(tokenized_pieces(docs, tokenizer, capacity, end_id), "pieces", "zstd")
    counts = pieces.where(F.col("length") < capacity).groupBy("length", "part").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("l"), F.col("part").alias("p"),
                          F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    short = pieces.where(F.col("length") < capacity).join(bases, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p")))
    # the plan has slots for at most `capacity` lengths and the patterns kept for each: its size does not grow with the rows
    placed = short.withColumn("place", _place(plan(histogram, capacity))("length", F.col("base") + F.col("nth")))
    columns = PIECES.names[:6]
    full = pieces.where(F.col("length") == capacity).select(
        *columns, ((F.col("part") + 1) * F.lit(_SEQUENCES_OF_TASK) + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionAll(placed.select(*columns, "place.sequence_id", "place.offset"))
