"""SimHash near-duplicate groups.

1. Fingerprint: XXH64 of every 3-word shingle, majority bit over the hashes.
2. Pigeonhole blocks: two fingerprints that differ in at most 3 of 64 bits
   agree on at least one of 4 blocks of 16 bits. Rows meet per block value and
   the Hamming distance is verified there.
3. A block value with more than `group_rows` distinct fingerprints is not
   compared directly: the 48 other bits are cut into 4 blocks, one of which
   must agree as well, so groups share 28 bits and a fingerprint has 16 copies
   where a table is merely large. Groups that are still too large are cut by 3
   of 6 blocks of the other bits (20 choices), and once more. In that last level
   9 bits are free, so a group holds at most 512 distinct fingerprints
   whatever the data. Every pair within 3 bits is still met, no pair list of a
   group is written: a group emits one edge per member to the least member of
   its local component.
4. Connected components over these edges (components.star_forest).

Copies are collapsed first: only distinct fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_and_bytes, small_batches, stored
from riskframe.llm.components import star_forest

BITS = 64
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_SLICE = 1 << 20  # shingle hashes held at once for one text


def fingerprint(raw: bytes | None, shingle_words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII white space.

    Fewer words than a shingle: the whole sequence is the one shingle. No word
    (null, empty or blank text): zero.
    """
    words = (raw or b"").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SLICE):
        part = zip(starts[at:at + _SLICE], ends[at:at + _SLICE])
        h = np.array([digest(joined[s:e], seed) for s, e in part], np.uint64)
        by_byte = h.astype("<u8").view(np.uint8).reshape(-1, 8)
        for j in range(8):
            ones[8 * j:8 * j + 8] += np.bincount(by_byte[:, j], minlength=256) @ _BYTE_BITS
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(starts)).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                 seed: int = 42) -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            fp = [fingerprint(raw, shingle_words, seed) for raw in batch.column(1).to_pylist()]
            fps = np.array(fp, np.uint64).view(np.int64) if fp else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _bits(blocks: list[list[int]]) -> int:
    return sum(1 << b for block in blocks for b in block)


def _cut(bits: list[int], n: int) -> list[list[int]]:
    size = len(bits) // n
    return [bits[i * size:(i + 1) * size] for i in range(n)]


def _masks(max_bits: int) -> tuple[list[int], list[dict[int, list[int]]]]:
    """First-level masks, and for each level below the masks that each mask is cut into: kept bits on which a close pair
    agrees. With all differing bits among the free ones, one of max_bits + 1 blocks agrees, and max_bits of twice as many."""
    def below(mask: int, blocks: int, keep: int) -> list[int]:
        parts = _cut([b for b in range(BITS) if not mask >> b & 1], blocks)
        return [mask | _bits(list(c)) for c in combinations(parts, keep)]

    masks = first = below(0, max_bits + 1, 1)
    levels = []
    for blocks, keep in ((max_bits + 1, 1), (2 * max_bits, max_bits), (2 * max_bits, max_bits)):
        levels.append({m: below(m, blocks, keep) for m in masks})
        masks = sorted({x for ms in levels[-1].values() for x in ms})
    return first, levels


def _split_rows(masks_of: dict[int, list[int]] | None, masks: list[int], max_bits: int):
    """Rows (mask, key, fp) -> rows of the next level; masks_of None: first level from plain (fp) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column("fp"), dtype=np.int64).view(np.uint64)
            if masks_of is None:
                todo = [(masks, np.arange(len(fp)))]
            else:
                own = np.asarray(batch.column("mask"), dtype=np.int64).view(np.uint64)
                todo = [(masks_of[int(m)], np.flatnonzero(own == m)) for m in np.unique(own)]
            for ms, rows in todo:
                for m in ms:
                    v = fp[rows]
                    key = v & np.uint64(m)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), m, np.uint64).view(np.int64)), pa.array(key.view(np.int64)),
                         pa.array(v.view(np.int64))], names=["mask", "key", "fp"])

    return run


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable position of each of n positions over undirected links a-b (pointer jumping)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            return root
        root = new


def _group_edges(max_bits: int):
    """Sorted (mask, key, fp) rows -> edges (a, b) that join the members of a group within max_bits of each other.

    Groups arrive whole (the rows are partitioned by group) and are bounded by
    the caller. The d-th pass compares each row with the one d places on, for
    all groups of the buffer at once.
    """
    def edges(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        left, right, rows, d = [], [], np.arange(len(fp), dtype=np.int32), 1
        while True:
            rows = rows[rows + d < len(fp)]
            rows = rows[(mask[rows] == mask[rows + d]) & (key[rows] == key[rows + d])]
            if not len(rows):
                break
            near = rows[np.bitwise_count(fp[rows] ^ fp[rows + d]) <= max_bits]
            left.append(near)
            right.append(near + d)
            d += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (left, right))
        root = _local_roots(len(fp), a, b)
        child = np.flatnonzero(root != np.arange(len(fp)))
        s = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(s[child]), pa.array(s[root[child]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            new = [np.asarray(batch.column(i), dtype=np.int64) for i in range(3)]
            held = [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]):
                cut = int(np.argmax((held[0] == held[0][-1]) & (held[1] == held[1][-1])))  # the last group may go on
                yield edges(held[0][:cut], held[1][:cut], held[2][:cut].view(np.uint64))
                held = [x[cut:] for x in held]
        yield edges(held[0], held[1], held[2].view(np.uint64))

    return run


def near_edges(fps: DataFrame, max_bits: int = 3, group_rows: int = 1024) -> DataFrame:
    """Edges (a, b) whose connected components are those of all pairs of distinct fp within max_bits."""
    first, levels = _masks(max_bits)
    out = None
    rows = fps.select("fp").mapInArrow(_split_rows(None, first, max_bits), "mask long, key long, fp long")
    for below in (*levels, None):
        if below is None:
            here = rows
        else:
            big = rows.groupBy("mask", "key").count().where(F.col("count") > group_rows).select("mask", "key")
            here = rows.join(big, ["mask", "key"], "left_anti")
            hot = rows.join(big, ["mask", "key"], "left_semi")
        linked = (here.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
                  .mapInArrow(_group_edges(max_bits), "a long, b long"))
        out = linked if out is None else out.unionAll(linked)
        if below is None or hot.isEmpty():
            return out
        rows = hot.select("mask", "key", "fp").mapInArrow(_split_rows(below, [], max_bits), "mask long, key long, fp long")
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                max_bits: int = 3, group_rows: int = 1024) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row.

    component_id is the least doc_id of the texts reachable over links of at
    most max_bits differing bits, the row's own included. Rows without words
    share fingerprint zero and are linked like any other. Repeated rows each
    give a row; null ids take part as texts, and a group of only null ids has a
    null component_id. An empty table gives an empty result.
    """
    if max_bits != 3:
        raise ValueError("the block scheme is built for 3 differing bits")
    prints = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    forest = star_forest(near_edges(reps, max_bits, group_rows), name="near")
    labelled = reps.join(forest, reps["fp"] == forest["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    names = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = labelled.join(names, "root").select(F.col("fp").alias("own"), "component_id")
    return prints.join(of_print, F.col("fp") == F.col("own")).select("doc_id", "fp", "component_id")


def hex_print(fp: str = "fp"):
    """A signed fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                  max_bits: int = 3, group_rows: int = 1024) -> DataFrame:
    """The documents, all columns, with one row left of each near-duplicate group.

    The row with the least id stays (rows without an id last; among rows of one
    id the first as read), all other columns as they are. Null and empty
    texts are one group; an empty table stays empty. The rows are numbered and stored once, and all later
    jobs read the numbers from there: another reading of docs could be split
    over other partitions and number its rows anew.
    """
    number = "__row"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.select("*", F.monotonically_increasing_id().alias(number)), "numbered")
    rows = numbered.select(F.col(number).alias("doc_id"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    groups = near_groups(rows, shingle_words=shingle_words, max_bits=max_bits, group_rows=group_rows)
    member = groups.join(rows.select(F.col("doc_id").alias("__r"), "id"), F.col("doc_id") == F.col("__r"))
    first = member.groupBy("component_id").agg(
        F.min_by("doc_id", F.struct(F.col("id").isNull(), F.col("id"), F.col("doc_id"))).alias("kept"))
    return numbered.join(first.select(F.col("kept").alias(number)), number, "left_semi").select(*docs.columns)
