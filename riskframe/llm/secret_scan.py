"""Secret scan: patterns for known forms, and automata inferred from them for the others.

Credentials that the patterns find are the labelled examples, one automaton per
kind; other candidates are the background, one automaton of those with a digit
and one of those without (long words). Every candidate of the whole corpus, any
run of 12 or more credential characters, is scored by its likelihood per
character under each kind's automaton. It becomes a span of the best kind when
that is as high as labelled strings of the kind reach themselves, held back
from the fit, with an end where some of them end, and above its background's
by LEAST_MARGIN, however many others are.
Background examples that a kind explains better than the rest of the background
does are unlabelled credentials, and the background is fitted without them.

A run that goes on beyond a hexadecimal or access key is a span beside it: the
key's stretch is only part of a credential.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.automaton import CLASSES, Automaton
from riskframe.llm.common import LeastHashed, id_and_text, small_batches, spark_hash, stored
from riskframe.llm.spans import ARROW_SPANS, SPANS, Rule, Span, found_by, masked, ordered, pattern_spans

KINDS = ["assign", "access", "hex"]
LEAST = 12
LEAST_MARGIN = 0.5  # nats a character over the background
MANY_LENGTHS = 3    # of labelled strings: others between them are of the format too
FLOOR_SLACK = 0.1   # nats a character below what labelled strings reach
GROUNDS = ["", "word"]  # backgrounds: candidates with a digit and without
FOLDS = 5
_CACHE = 200_000  # scored strings kept by one worker: speed only

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_WORDS = ("passw", "secret", "token", "api")


def _names_one(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in _WORDS)


RULES: list[Rule] = [
    ("assign", _names_one, found_by(_ASSIGN, lambda m: len(m[2]) >= LEAST)),
    ("access", lambda t: "AKIA" in t, found_by(re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 18)),
    # runs are maximal, so asking for 16 characters at once keeps the same matches
    ("hex", lambda t: True, found_by(re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}"))),
]
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}+" % LEAST)


def base_spans(text: str) -> list[Span]:
    return pattern_spans(text, RULES)


def candidates(text: str) -> list[tuple[int, int]]:
    """Maximal runs of credential characters, 12 at least; full stops at the end are punctuation."""
    out = []
    for m in _RUN.finditer(text):
        end = m.start() + len(m[0].rstrip("."))
        if end - m.start() >= LEAST:
            out.append((m.start(), end))
    return out


def beside(text: str, base: list[Span]) -> tuple[list[Span], list[tuple[int, int]]]:
    """(runs that hold a key and more, runs and parts of runs to be scored). base is in order.

    The value of an assignment ends with its run; what lies before its name is scored like a run of its own."""
    more, free, at = [], [], 0
    for s, e in candidates(text):
        while at < len(base) and base[at][2] <= s:
            at += 1
        touched, i = [], at
        while i < len(base) and base[i][1] < e:
            if s < base[i][2]:
                touched.append(base[i])
            i += 1
        if not touched:
            free.append((s, e))
        elif any(k == "assign" for k, _, _ in touched):
            for _, a, b in touched:
                end = s + len(text[s:a].rstrip("/._-"))
                if end - s >= LEAST:
                    free.append((s, end))
                s = max(s, b)
            if e - s >= LEAST:
                free.append((s, e))
        elif not any(a <= s and e <= b for _, a, b in touched):
            more.append((touched[0][0], s, e))
    return more, free


def ground_of(symbols: str) -> str:
    return "" if "9" in symbols else "word"


def examples(text: str) -> list[tuple[str, str]]:
    """(kind, string in symbols): values of credentials found by the patterns, and other candidates as background."""
    found = ordered(base_spans(text), KINDS)
    out = []
    for kind, s, e in found:
        value = _ASSIGN.match(text, s)[2] if kind == "assign" else text[s:e]
        out.append((kind, value.translate(CLASSES)))
    free = (text[s:e].translate(CLASSES) for s, e in beside(text, found)[1])
    return out + [(ground_of(x), x) for x in free]


@dataclass
class Grammar:
    """Automata by kind and by background, and the least likelihood a character that a kind's own strings have. No
    automata: patterns alone."""
    kinds: dict[str, Automaton]
    grounds: dict[str, Automaton]
    floors: dict[str, float] = field(default_factory=dict)
    lengths: dict[str, tuple[int, int]] = field(default_factory=dict)  # of kinds of many lengths: the least and the greatest
    cache: dict[str, tuple[float, str]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def best(self, symbols: str) -> tuple[float, str]:
        got = self.cache.get(symbols)
        if got is None:
            n = len(symbols) + 1
            ground = self.grounds[ground_of(symbols)].log_likelihood(symbols)
            own = {kind: self.likelihood(kind, symbols) for kind in self.kinds}
            got = max(((own[k] - ground) / n if own[k] / n >= self.floors.get(k, -inf) else -inf, k) for k in own)
            if len(symbols) < 100:
                if len(self.cache) >= _CACHE:
                    self.cache.clear()
                self.cache[symbols] = got
        return got

    def likelihood(self, kind: str, symbols: str) -> float:
        """Of a string under a kind. It ends where an example ended; a kind of many lengths may end between them."""
        automaton, (least, most) = self.kinds[kind], self.lengths.get(kind, (1, 0))
        if automaton.may_end(symbols):
            return automaton.log_likelihood(symbols)
        return automaton.log_likelihood(symbols, stops=False) if least <= len(symbols) <= most else -inf

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base, all) spans of a whole text, in order."""
        base = ordered(base_spans(text), KINDS)
        if base or self.kinds:
            more, free = beside(text, base)
            for s, e in free if self.kinds else ():
                score, kind = self.best(text[s:e].translate(CLASSES))
                if score > LEAST_MARGIN:
                    more.append((kind, s, e))
            if more:
                return base, ordered([*base, *more], KINDS)
        return base, base


_SMALL, _GREAT = str.maketrans("XU", "xl"), str.maketrans("xl", "XU")


def cased(words: list[str]) -> list[str]:
    """Words in symbols as they are, in small letters, with a capital, and in capitals: any word may be written so."""
    small = [x.translate(_SMALL) for x in words]
    return [*words, *small, *(x[:1].translate(_GREAT) + x[1:] for x in small), *(x.translate(_GREAT) for x in words)]


def background(formats: Grammar, name: str, strings: list[str]) -> Automaton:
    """Automaton of background examples, without those that a kind explains better than the examples of the other folds
    do: these are credentials as well. Without them others show, so this is repeated while any go."""
    forms = cased if name == "word" else list
    for _ in range(FOLDS):
        clean = []
        for k in range(FOLDS):
            rest = [x for i, x in enumerate(strings) if i % FOLDS != k]
            other = replace(formats, grounds={name: Automaton().fit(forms(rest) or ["l9"])}, cache={})
            clean += [x for x in strings[k::FOLDS] if other.best(x)[0] <= 0]
        if len(clean) == len(strings):
            break
        strings = sorted(clean)
    return Automaton().fit(forms(strings) or ["l9"])


def floor(strings: list[str]) -> float:
    """Likelihood a character that nearly all strings of a kind reach under an automaton fitted without them."""
    own = []
    for k in range(min(FOLDS, len(strings))):
        rest = Automaton().fit([x for i, x in enumerate(strings) if i % FOLDS != k] or strings)
        own += [rest.log_likelihood(x) / (len(x) + 1) for x in strings[k::FOLDS]]
    return sorted(own)[len(own) // 50] - FLOOR_SLACK


def learn(docs: DataFrame, fit_rows: int = 400, text_col: str = "text") -> Grammar:
    """Grammar from at most fit_rows distinct examples of each kind and of each background, those of least hash over all
    documents. Kinds without an example get no automaton. A task sends no more than that many of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = LeastHashed(fit_rows)
        for batch in small_batches(batches, 0):
            for t in batch.column(0).to_pylist():
                for kind, symbols in examples(t) if t else ():
                    least.add(kind, symbols)
        kind, symbols = zip(*least.rows()) if least.held else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(symbols, pa.string())], names=["kind", "symbols"])

    found = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(run, "kind string, symbols string").distinct(), "examples")
    strings: dict[str, list[str]] = {}
    for kind in [*KINDS, *GROUNDS]:
        rows = found.where(F.col("kind") == kind).orderBy(spark_hash("symbols"), "symbols").limit(fit_rows).collect()
        strings[kind] = sorted(r["symbols"] for r in rows)
    kinds = {k: Automaton().fit(strings[k]) for k in KINDS if strings[k]}
    sizes = {k: {len(x) for x in strings[k]} for k in kinds}
    formats = Grammar(kinds, {}, {k: floor(strings[k]) for k in kinds},
                      {k: (min(n), max(n)) for k, n in sizes.items() if len(n) >= MANY_LENGTHS})
    return replace(formats, grounds={name: background(formats, name, strings[name]) for name in GROUNDS} if kinds else {})


def scan(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): one row per input row; spans of base and method in order of start, then kind.

    Null and empty texts have no span. Repeated rows and null ids each give their row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                base, every = grammar.spans(t or "")
                known = set(base)
                out.append([{"kind": k, "start": s, "end": e, "base": (k, s, e) in known} for k, s, e in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, ARROW_SPANS)], names=["doc_id", "spans"])

    schema = f"doc_id long, spans {SPANS.simpleString()}"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def redacted(docs: DataFrame, grammar: Grammar, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents, all columns, with every secret replaced by a mark; an n_chars column follows the new text. Null and
    empty texts stay as they are; every row stays, repeated ones too; an empty table stays empty."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at):
            texts = [t if not t else masked(t, grammar.spans(t)[1], lambda kind: mark) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(
            F.length(text_col)).cast(kind))
    return out
