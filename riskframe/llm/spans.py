"""Spans found by patterns, shared by the personal-data and the secret scan.

All positions are code points, ends exclusive. A kind's pattern is applied to
the whole text; matches that fail the kind's check are dropped, not retried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = tuple[str, int, int]
Find = Callable[[str], Iterable[tuple[int, int]]]
Rule = tuple[str, Callable[[str], bool], Find]

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def found_by(pattern: re.Pattern, check: Callable[[re.Match], bool] = lambda m: True) -> Find:
    """Leftmost non-overlapping matches that pass a check."""
    return lambda text: [m.span() for m in pattern.finditer(text) if check(m)]


def pattern_spans(text: str, rules: Iterable[Rule]) -> list[Span]:
    """Spans of all rules. A rule is (kind, quick test on the text, finder)."""
    return [(kind, s, e) for kind, may, find in rules if may(text) for s, e in find(text)]


def ordered(spans: Iterable[Span], kinds: list[str]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def joined_column(spans, only_base: bool = False):
    """The same as joined, over a spans column that is in order."""
    part = F.filter(spans, lambda s: s["base"]) if only_base else spans
    return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def count_column(spans, kind: str):
    """Base spans of a kind."""
    return F.size(F.filter(spans, lambda s: (s["kind"] == kind) & s["base"])).cast("long")


def masked(text: str, spans: Iterable[Span], mark: Callable[[str], str]) -> str:
    """The text with every stretch covered by spans replaced by the mark of its first span; overlaps become one."""
    out, at = [], 0
    run: list | None = None
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if run and s < run[2]:
            run[2] = max(run[2], e)
            continue
        if run:
            out += [text[at:run[1]], mark(run[0])]
            at = run[2]
        run = [kind, s, e]
    if run:
        out += [text[at:run[1]], mark(run[0])]
        at = run[2]
    return "".join(out) + text[at:]
