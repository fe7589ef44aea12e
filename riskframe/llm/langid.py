"""Language spans: script ranges narrow the candidates, Viterbi labels the words.

Each language has a character model (trigrams of its words, with word ends)
and the scripts it is written in, both learned from a bounded sample of
labelled documents. The script of a word rules out languages not written in it;
the others score the word by log likelihood. Viterbi over all words of a text
with a penalty per change of language gives spans, and the language that covers
most letters is the document's.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import chunks, id_and_text, least_hashed

UNKNOWN = "und"
SWITCH = 6.0           # nats lost where the language changes
_LONGEST = 40          # letters and marks of a word; a longer run is as many words as it takes
_UNSPACED = 8          # the same for scripts that put no space between words
UNSPACED = frozenset(("thai", "lao", "khmer", "kana", "han"))
_CACHE_WORDS = 300_000  # scored words kept by one worker: speed only
_BATCH_CHARS = 1 << 24

#: Unicode script ranges (fixed values): first and last code point, script
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0250, 0x02AF, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"), (0x0600, 0x06FF, "arabic"), (0x0750, 0x077F, "arabic"),
    (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"), (0x0A00, 0x0A7F, "gurmukhi"),
    (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"), (0x0C00, 0x0C7F, "telugu"), (0x0C80, 0x0CFF, "kannada"),
    (0x0D00, 0x0D7F, "malayalam"), (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"), (0x10A0, 0x10FF, "georgian"),
    (0x1100, 0x11FF, "hangul"), (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"), (0x1E00, 0x1EFF, "latin"),
    (0x1F00, 0x1FFF, "greek"), (0x3040, 0x309F, "kana"), (0x30A0, 0x30FF, "kana"), (0x3400, 0x4DBF, "han"),
    (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"), (0x20000, 0x2FA1F, "han"),
]


def script(char: str) -> str:
    c = ord(char)
    for first, last, name in SCRIPTS:
        if first <= c <= last:
            return name
    return "other"


def _ranges(first: int, last: int, kind: str, but: frozenset[int] = frozenset()) -> str:
    """The code points of a general category (its first letter) as ranges of a character class."""
    out, start = [], None
    for c in range(first, last + 2):
        if c <= last and c not in but and unicodedata.category(chr(c))[0] == kind:
            start = c if start is None else start
        elif start is not None:
            out.append(f"{chr(start)}-{chr(c - 1)}")
            start = None
    return "".join(out)


def _words() -> re.Pattern:
    """Runs of letters of one script with the marks on them, in pieces. Numbers and signs that look like letters are none."""
    marks = _ranges(0, sys.maxunicode, "M")
    letters: dict[str, str] = {}
    for first, last, name in SCRIPTS:
        letters[name] = letters.get(name, "") + _ranges(first, last, "L")
    named = frozenset(c for first, last, _ in SCRIPTS for c in range(first, last + 1))
    parts = [(own, _UNSPACED if name in UNSPACED else _LONGEST) for name, own in letters.items()]
    parts.append((_ranges(0, sys.maxunicode, "L", named), _LONGEST))
    # a piece ends after n letters and marks, and after the marks on its last letter
    return re.compile("|".join(f"[{own}][{own}{marks}]{{0,{n - 1}}}[{marks}]*" for own, n in parts))


_WORD = _words()


def words_of(text: str | None) -> list[str]:
    """Runs of letters (category L) of one script with their marks, lower-cased. Every letter is in one: long runs, and
    those of scripts without spaces, are cut into pieces."""
    return _WORD.findall(text.lower()) if text else []


def grams(word: str) -> list[str]:
    """Trigrams of a word between its ends."""
    w = f"^{word}$"
    return [w[i:i + 3] for i in range(len(w) - 2)]


@dataclass
class Model:
    """langs in order, and the log probability of each trigram under each of them."""
    langs: list[str]
    gram_row: dict[str, int]
    logp: np.ndarray                # a row per trigram, the last one for trigrams never seen
    scripts: dict[str, np.ndarray]  # script -> whether each language is written in it
    switch: float = SWITCH
    cache: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}, "table": None}

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row per word: sums over its trigrams, and no chance for languages not written in its script."""
        parts = [grams(w) for w in words]
        unseen, row = len(self.logp) - 1, self.gram_row.get
        flat = np.fromiter((row(g, unseen) for p in parts for g in p), np.int64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        out = np.add.reduceat(self.logp[flat], np.cumsum(size) - size, axis=0)
        if len(self.scripts) > 1 or not all(a.all() for a in self.scripts.values()):
            for name, allowed in self.scripts.items():
                own = np.fromiter((script(w[0]) == name for w in words), bool, len(words))
                out[np.ix_(own, ~allowed)] = -1e6
        return out

    def numbers(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word, score rows). Scores of words met before are kept."""
        cache = self.cache
        new = [w for w in set(words) if w not in cache]
        if new:
            rows = self.word_scores(new)
            if self.table is None or len(cache) + len(new) > _CACHE_WORDS:
                cache.clear()
                new = list(set(words))
                rows = self.word_scores(new)
                self.table = rows
                cache.update(zip(new, range(len(new))))
            else:
                at = len(self.table)
                self.table = np.concatenate([self.table, rows])
                cache.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(cache.__getitem__, words), np.int64, len(words)), self.table

    def spans(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Language number of every word of each text, by Viterbi. Texts step together, longest first."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        size = np.array([len(texts[i]) for i in order], np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(texts)
        if not len(size) or not size[0] or not self.langs:
            return out
        row, table = self.numbers([w for i in order for w in texts[i]])
        first = np.cumsum(size) - size
        live = np.searchsorted(-size, -np.arange(int(size[0])), "left").tolist()  # texts with more than t words
        best = table[row[first[:live[0]]]].copy()
        came: list[tuple[np.ndarray, np.ndarray]] = []
        for t in range(1, int(size[0])):
            k = live[t]
            own = best[:k]
            top = own.argmax(1)
            switched = own[np.arange(k), top] - self.switch
            moved = own < switched[:, None]
            came.append((moved, top.astype(np.int8)))
            best[:k] = np.where(moved, switched[:, None], own) + table[row[first[:k] + t]]
        label = best.argmax(1).astype(np.int8)  # of the last word of each text
        labels = np.empty(len(row), np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            if t + 1 < size[0]:
                k = live[t + 1]
                moved, top = came[t]
                label[:k] = np.where(moved[np.arange(k), label[:k]], top, label[:k])
            labels[first[:live[t]] + t] = label[:live[t]]
        for j, i in enumerate(order):
            out[i] = labels[first[j]:first[j] + size[j]]
        return out

    def summary(self, texts: list[list[str]], labels: list[np.ndarray]) -> list[tuple[str, float]]:
        """(language, share of the letters in its spans) of each text; und and 0 without a letter."""
        out = []
        for words, tags in zip(texts, labels):
            if not len(tags):
                out.append((UNKNOWN, 0.0))
                continue
            letters = np.bincount(tags, weights=np.fromiter(map(len, words), np.int64, len(words)), minlength=len(self.langs))
            k = int(letters.argmax())
            out.append((self.langs[k], float(letters[k] / letters.sum())))
        return out


def build(counts: dict[str, Counter], smooth: float = 0.05) -> Model:
    """Model from trigram counts per language: probability of the third character after the first two, add-`smooth`."""
    langs = sorted(counts)
    every = sorted({g for c in counts.values() for g in c})
    alphabet = max(2, len({g[2] for g in every}))
    by_pair = [Counter() for _ in langs]
    for pairs, lang in zip(by_pair, langs):
        for g, n in counts[lang].items():
            pairs[g[:2]] += n
    logp = np.full((len(every) + 1, len(langs)), -np.log(alphabet))
    for i, g in enumerate(every):
        logp[i] = np.log([(counts[lang].get(g, 0) + smooth) / (pairs[g[:2]] + smooth * alphabet)
                          for pairs, lang in zip(by_pair, langs)])
    scripts: dict[str, np.ndarray] = {}
    for k, lang in enumerate(langs):
        total, own = 0, Counter()
        for g, n in counts[lang].items():
            if g[1] not in "^$":
                own[script(g[1])] += n
                total += n
        for name, n in own.items():
            if n >= 0.01 * total:
                scripts.setdefault(name, np.zeros(len(langs), bool))[k] = True
    return Model(langs, {g: i for i, g in enumerate(every)}, logp, scripts)


def fit(docs: DataFrame, learn_from: Column, fit_rows: int = 1000, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Model from at most fit_rows documents of each language, those of least hash of the id among the rows for which
    `learn_from` (a condition on doc_id) holds. Rows without a language are not used."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang")).where(
        learn_from & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    chosen: dict[int, str] = {}
    for r in least_hashed(known.distinct(), fit_rows, "doc_id", by="lang").orderBy("doc_id", "lang").collect():
        chosen.setdefault(r["doc_id"], r["lang"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i in chosen:
                    own = counts.setdefault(chosen[i], Counter())
                    for w in words_of(text):
                        own.update(grams(w))
        rows = [(lang, g, n) for lang, own in counts.items() for g, n in own.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        types = [pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["lang", "gram", "n"])

    found = id_and_text(docs, id_col, text_col).mapInArrow(run, "lang string, gram string, n long")
    counts: dict[str, Counter] = {}
    for r in found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect():  # distinct trigrams of the sample
        counts.setdefault(r["lang"], Counter())[r["gram"]] = r["n"]
    return build(counts)


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, spans): one row per input row, over the whole text.

    spans: runs of words of one language (lang, first word, words), words as in
    words_of. Null texts and texts without a letter are `und` with score
    0, and so is every text if no language was learned.
    """
    kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.int64()), ("words", pa.int64())]))

    def runs(tags: np.ndarray) -> list[dict]:
        if not len(tags):
            return []
        at = np.concatenate([[0], np.flatnonzero(np.diff(tags)) + 1, [len(tags)]]).tolist()
        return [{"lang": model.langs[tags[a]], "word": a, "words": b - a} for a, b in zip(at, at[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column(1).to_pylist(), lambda t: len(t or ""), _BATCH_CHARS):
                texts = [words_of(t) for t in part]
                tags = model.spans(texts)
                said = model.summary(texts, tags)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array([s[0] for s in said], pa.string()),
                     pa.array([s[1] for s in said], pa.float64()), pa.array([runs(t) for t in tags], kind)],
                    names=["doc_id", "lang_pred", "score", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,word:long,words:long>>")
