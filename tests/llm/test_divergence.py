import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, top=200):
    groups, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang, source].update(found)
        docs[lang].update(set(found))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        counts = {s: {t: groups[lang, s][t] for t in kept} for s in sources}
        counts[None] = {t: sum(groups[lang, s][t] for s in sources) for t in kept}
        total = {s: sum(c.values()) for s, c in counts.items()}
        p = {s: {t: 1 + 10 ** 9 * (n + 1) // (total[s] + len(kept)) for t, n in c.items()} for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > p[None][t])
            for part, found in (("pair", pairs), ("term", terms[:top])):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def audited(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "1 AS term", "'x' AS n", "2 AS docs", "'y' AS item", "3 AS kept", "4 AS sizes")
    return sorted(tuple(r) for r in divergence.audit(df, **kwargs).collect())


def texts(seed, n, words, sources, langs=("en", "de")):
    rng = np.random.default_rng(seed)
    own = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)]
    return [(" ".join(own[min(words - 1, int(rng.zipf(1.5)) - 1 + int(rng.integers(3)))] for _ in range(int(rng.integers(0, 30)))),
             langs[int(rng.integers(len(langs)))], f"s{int(rng.integers(sources))}") for _ in range(n)]


@pytest.mark.parametrize("block", [4096, 5])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "_BLOCK", block)
    rows = texts(block, 300, 120, 5)
    assert audited(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = texts(1, 40, 10, 3, ("en",)) + [
        (None, "en", "s0"), (None, None, None), ("", "fr", "lone"), ("one word", "xx", "a"), ("Other Words", "xx", "b"), ("x", "xx", None),
        ("Ünïcode 日本 語 ÀB àB É É É \x7f[^]`{}~ it's", "uu", "a"), ("ÀB é 日本", "uu", "b"), ("àb ÀB 日本 É", "uu", "c"),
        ("ab CD " * 200_000, "long", "a"), ("ab", "long", "b"), ("ab cd", "long", "b"), ("ab", "3:x", "7:é"), ("ab", "3:x", ""), ("ab", "日本:", "é"), ("ab", "日本:", ":")]
    rows += rows[:5]
    found = audited(spark, rows)
    assert found == plain(rows)
    assert ("xx", "a", "pair", "b", 0, 2) in found and not any(r[0] == "fr" for r in found)
    assert audited(spark, []) == []


def test_top_terms_are_cut_by_rank(spark):
    rows = texts(7, 200, 60, 3)
    assert audited(spark, rows, top_terms=4) == plain(rows, top=4)


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "_PART", 7)
    raw = "Alpha betaGamma  délta-x ÀÀ9zz".encode()
    assert [t.decode() for p in divergence._parts(raw) for t in p] == TERM.findall(raw.decode().translate(LOWER))


def test_tasks_write_counts_before_they_hold_too_many(spark, monkeypatch):
    rows = texts(2, 60, 30, 3)
    for name in ("_HELD", "_HELD_DOCS", "_HELD_BYTES", "_ROWS"):
        with monkeypatch.context() as m:
            m.setattr(divergence, name, 3)
            assert audited(spark, rows) == plain(rows)


def test_pair_sums_equal_the_sum_over_terms():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 6, 40)
    for _ in range(20):
        a, b = rng.integers(1, 5, 40) * 1000, rng.integers(1, 5, 40) * 999
        p, q = np.repeat(a, lengths), np.repeat(b, lengths)
        coded = [divergence.Coded.of(*divergence.runs(x), 40) for x in (a, b)]
        assert (coded[0].p == a).all() and coded[0].ends.sum() == 1 + (np.diff(a) != 0).sum()
        assert divergence.pair_sums(*coded, np.cumsum(lengths)) == (int(((p - q) ** 2 // q).sum()), int(((p - q) ** 2 // p).sum()))


def test_large_counts_stay_exact(spark):
    counts = [0, 1, 10 ** 12, 10 ** 17]
    assert divergence._shares(counts, 10 ** 18).tolist() == [1 + 10 ** 9 * (c + 1) // 10 ** 18 for c in counts]
    from pyspark.sql import functions as F
    row = spark.sql("SELECT 100000000000000000L AS n, 999999999999999000L AS total, 1000L AS kept").select(
        divergence.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (10 ** 17 + 1) // 10 ** 18
