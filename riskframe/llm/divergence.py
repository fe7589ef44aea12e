"""Source divergence audit: how far the term use of a language's sources lies apart.

Terms are counted by (lang, source) in one pass over whole texts; a task adds
up its own counts before they are shuffled. A language
keeps the terms of enough documents. Each source then has a column of counts
over the kept vocabulary, long runs of which are equal once the vocabulary is
ordered by its row of counts:

1. Terms of equal rows (the same count in every source) become one entry with
   a length; the entries are ordered by their rows over range partitions.
2. In each block of entries a source's column is run-length encoded: (end of
   run, p).
3. For each pair of sources the run boundaries are intersected, and the
   divergence of the two p is multiplied by the run's length. Block sums are
   added up by Spark.

All arithmetic is on whole numbers: p = 1 + floor(SCALE * (count + 1) / (N + V))
and f = floor((p - q)^2 / q). The sum of f over a language stays below 9.2e18
for up to 3.6e9 kept terms, since p sums to at most SCALE + V.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import stored

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP_TERMS = 200

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PART = 1 << 20          # bytes of a text that are split at once
_HELD = 300_000          # counts that a task holds before it writes them
_HELD_DOCS, _HELD_BYTES = 1 << 22, 1 << 39  # and documents and bytes: one value holds both counts
_ROWS = 256              # texts that a task copies out of Arrow at once
_BLOCK = 4096            # vocabulary entries whose columns are held at once
_HELD_DOCS, _HELD_BYTES = 1 << 22, 1 << 39  # and documents and bytes: a value below holds both counts

COUNTS = T.StructType([T.StructField("grp", T.StringType()), T.StructField("term", T.StringType()),
                       T.StructField("n", T.LongType()), T.StructField("docs", T.LongType())])


def _parts(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a stretch at a time; stretches end where a term does."""
    text = raw.translate(_TERM_BYTES)
    at = 0
    while len(text) - at > _PART:
        end = text.find(b" ", at + _PART)
        if end < 0:
            break
        yield text[at:end].split()
        at = end
    yield (text[at:] if at else text).split()


_DOC = 1 << 40  # one document in a value that holds occurrences below it


def term_counts(docs: DataFrame) -> DataFrame:
    """(grp, term, n, docs): occurrences, and documents that hold the term, of stretches of each task's rows.

    grp is a language and a source as one string, which is hashed and moved
    once: the length of the language, a colon, the language, the source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], dict[bytes, int]] = {}
        held = seen = size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in counts.items():
                if found:
                    both = np.fromiter(found.values(), np.int64, len(found))
                    grp = pa.array([f"{len(lang)}:{lang}{source}"]).take(pa.array(np.zeros(len(found), np.int32)))
                    yield pa.RecordBatch.from_arrays([grp, pa.array(list(found), pa.binary()).cast(pa.string()),
                                                      pa.array(both % _DOC), pa.array(both // _DOC)], names=COUNTS.names)

        for part_of in (b.slice(at, _ROWS) for b in batches for at in range(0, b.num_rows, _ROWS)):
            for raw, lang, source in zip(*(c.to_pylist() for c in part_of.columns)):
                found, own = counts.setdefault((lang, source), {}), Counter()
                for part in _parts(raw):
                    own.update(part)
                before, get = len(found), found.get
                for term, n in own.items():
                    found[term] = get(term, 0) + n + _DOC
                held, seen, size = held + len(found) - before, seen + 1, size + len(raw)
                if held > _HELD or seen >= _HELD_DOCS or size >= _HELD_BYTES:
                    yield from rows()
                    counts, held, seen, size = {}, 0, 0, 0
        yield from rows()

    return _read(docs, F.coalesce("text", F.lit("")).cast("binary").alias("raw")).mapInArrow(run, COUNTS)


def _read(docs: DataFrame, *columns: Column) -> DataFrame:
    return docs.select(*columns, F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 1) / (total + kept)), exact in decimals."""
    top = (count.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, (total + kept).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / q): both are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def vocabulary(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, row): the kept terms, each with its row of counts, (source, n) by source, zeros left out."""
    own = counts.groupBy("grp", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    size = F.substring_index("grp", ":", 1)
    start = F.length(size) + 2
    own = own.select("term", "n", "docs", F.substr("grp", start, size.cast("int")).alias("lang"),
                     F.substr("grp", start + size.cast("int")).alias("source"))
    terms = own.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("row"))
    return terms.where(F.col("docs") >= least_docs).select("lang", "term", "total", "row")


def group_totals(groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """(lang, source, n, lang_n, kept) of every group: N of the group and of its language, and V."""
    langs = vocab.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("kept"))
    own = vocab.select("lang", F.inline("row")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", zero("n"), zero("lang_n"), zero("kept"))


COLUMNS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("sizes", T.ArrayType(T.LongType())),
    T.StructField("columns", T.ArrayType(T.StructType([
        T.StructField("source", T.StringType()), T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.LongType()))])))])
_ARROW_COLUMNS = pa.schema([("lang", pa.string()), ("sizes", pa.list_(pa.int64())), ("columns", pa.list_(pa.struct(
    [("source", pa.string()), ("ends", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])))])


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last entry, value) of each run of a column."""
    last = np.flatnonzero(np.append(values[1:] != values[:-1], True))
    return last, values[last]


def run_length_columns(vocab: DataFrame) -> DataFrame:
    """(lang, sizes, columns): blocks of the reordered vocabulary, a run-length encoded column of counts per source.

    Terms of equal rows are one entry, of their number as size, and entries are
    ordered by row, so equal counts lie side by side. A source without a column
    has count 0 all along.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lengths = np.asarray(batch.column(2), np.int64)
            start = 0
            while start < len(langs):
                end = start + 1
                while end < len(langs) and end - start < _BLOCK and langs[end] == langs[start]:
                    end += 1
                columns: dict[str, np.ndarray] = {}
                for i, row in enumerate(rows[start:end]):
                    for cell in row:
                        if cell["source"] not in columns:
                            columns[cell["source"]] = np.zeros(end - start, np.int64)
                        columns[cell["source"]][i] = cell["n"]
                coded = []
                for source, column in columns.items():
                    ends, counts = runs(column)
                    coded.append({"source": source, "ends": ends.tolist(), "counts": counts.tolist()})
                yield pa.RecordBatch.from_pylist([{"lang": langs[start], "sizes": lengths[start:end].tolist(),
                                                   "columns": coded}], _ARROW_COLUMNS)
                start = end

    entries = vocab.groupBy("lang", "row").agg(F.count("*").alias("length"))
    # ranges by the first counts of a row: the sample for their edges goes to the driver, and whole rows are long
    return entries.repartitionByRange("lang", F.slice("row", 1, 2)).sortWithinPartitions("lang", "row").mapInArrow(run, COLUMNS)


@dataclass
class Coded:
    """A run-length encoded column of p: where its runs end, and p by entry."""
    ends: np.ndarray   # whether a run ends at an entry
    p: np.ndarray

    @classmethod
    def of(cls, ends: np.ndarray, p: np.ndarray, entries: int) -> Coded:
        mask = np.zeros(entries, bool)
        mask[ends] = True
        return cls(mask, np.repeat(p, np.diff(ends, prepend=-1)))


def pair_sums(a: Coded, b: Coded, upto: np.ndarray) -> tuple[int, int]:
    """Sums of f over the terms of two columns: with b's p below the line, and with a's. upto: terms up to each entry.

    The run boundaries of both cut the column into stretches of one p each; f is made once a stretch."""
    at = np.flatnonzero(a.ends | b.ends)
    p, q = a.p[at], b.p[at]
    times, square = np.diff(upto[at], prepend=0), (p - q) ** 2
    return int((square // q * times).sum()), int((square // p * times).sum())


def _shares(counts: list[int], total: int) -> np.ndarray:
    """p of each count; counts repeat, and are divided once each."""
    of = {c: 1 + SCALE * (c + 1) // total for c in set(counts)}
    return np.array([of[c] for c in counts], np.int64)


SUMS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("item", T.StringType()), T.StructField("value", T.LongType())])


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, sizes, columns, kept, groups in zip(*(c.to_pylist() for c in batch.columns)):
            coded = {c["source"]: (c["ends"], c["counts"]) for c in columns}
            upto, shares = np.cumsum(sizes), []
            for g in groups:
                ends, counts = coded.get(g["source"], ([len(sizes) - 1], [0]))
                shares.append(Coded.of(np.array(ends, np.int64), _shares(counts, g["n"] + kept), len(sizes)))
            names = [g["source"] for g in groups]
            for i, name in enumerate(names):
                if rest := names[i + 1:]:
                    sums = [pair_sums(shares[i], shares[j], upto) for j in range(i + 1, len(names))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * 2 * len(rest), pa.string()), pa.array([name] * len(rest) + rest, pa.string()),
                         pa.array(rest + [name] * len(rest), pa.string()),
                         pa.array([s[0] for s in sums] + [s[1] for s in sums], pa.int64())], names=SUMS.names)


def pair_divergence(vocab: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of sources of a language; 0 where no term is kept."""
    langs = totals.groupBy("lang", "kept").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
    blocks = run_length_columns(vocab).join(langs, "lang").select("lang", "sizes", "columns", "kept", "groups")
    sums = blocks.mapInArrow(_block_sums, SUMS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = totals.where("kept = 0")
    pairs = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang")
    return sums.unionAll(pairs.where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def term_divergence(vocab: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each kept term that a group uses more than its language does."""
    cells = vocab.select("lang", "term", "total", F.inline("row"))
    rows = cells.join(totals.select("lang", "source", F.col("n").alias("group_n"), "lang_n", "kept"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("group_n"), F.col("kept")), share(F.col("total"), F.col("lang_n"), F.col("kept"))
    return rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q").select(
        "lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from each other source (`pair`) and of the leading terms (`term`).

    Null text, lang and source are read as ''. Every (lang, source) that occurs
    is a group, also without terms; a language of one source has no pair.
    Repeated rows count as often as they occur; ties are ranked by item in
    UTF-8 order. Other columns are not read. Empty table: no row.
    """
    vocab = stored(vocabulary(term_counts(docs), least_docs), "vocabulary", "zstd")
    totals = stored(group_totals(_read(docs).distinct(), vocab), "group-totals")  # one row a group
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_divergence(vocab, totals).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    terms = term_divergence(vocab, totals).select("lang", "source", F.lit("term").alias("part"), "item", "value", rank.alias("rank"))
    return pairs.unionAll(terms.where(F.col("rank") <= top_terms))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS kept FROM kept GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
ln AS (SELECT lang, term, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
lt AS (SELECT lang, sum(total)::HUGEINT AS lang_n FROM ln GROUP BY lang),
cell AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, ln.total,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn.n + v.kept) AS p,
           1 + (1000000000::HUGEINT * (ln.total + 1)) // (lt.lang_n + v.kept) AS lp
         FROM gn JOIN kept k USING (lang) JOIN v USING (lang) JOIN lt USING (lang) JOIN ln ON ln.lang = k.lang AND ln.term = k.term
         LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
ps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
       FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT x.lang, x.source, y.source AS item, coalesce(ps.value, 0) AS value
         FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
         LEFT JOIN ps ON ps.lang = x.lang AND ps.source = x.source AND ps.item = y.source),
r AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL
      SELECT lang, source, 'term', term, ((p - lp) * (p - lp)) // lp FROM cell WHERE n > 0 AND p > lp),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""
