import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pytest

from riskframe.llm import pattern_packing as pp
from riskframe.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TRICKY = ["it's İSTANBUL ΣΑΣ, Ὀδυσσεύς. áb é, <|endoftext|> <|endoftext|>x", "a \t x\x1cy 1234 naïve x y 'tis don't. !'s",
          "̈a a ̈b 日本語テスト。한국 한 x\x85y    z", "", " ", "\n\n", "word...' 's's ''", "ﬁ ẞ ŐŰ\r\nfoo\rbar",
          "a\x00b \x0b c﻿d", "ÀÉ, ßü. µm ª º ÿŸ «x» 1½", "word, " * 3000, "(a) \"b\" c;d e-f _g_ #h"]


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cached_parts_give_the_tokenizers_ids():
    random.seed(0)
    made = ["".join(random.choice(["a", "The", " ", " ", "\n", "É", "1", ".", "'s", " ", "\x1c", "Z", "ß", "İ", "́", ",", "ς", "Σ"])
                    for _ in range(30)) for _ in range(2000)]
    words = pp.encoder(PATH)
    for _ in range(2):  # cold and warm
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(TRICKY + made)] == reference_ids(TRICKY + made)


def test_ids_are_the_same_when_the_cache_is_full(monkeypatch):
    monkeypatch.setattr(pp, "_CACHE_PARTS", 3)
    words = pp._Parts(PATH)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(TRICKY)] == reference_ids(TRICKY)


def best_fit_decreasing(counts, capacity):
    rooms, bins = [], 0
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            at = bisect_left(rooms, n)
            if at == len(rooms):
                bins += 1
                insort(rooms, capacity - n)
            else:
                insort(rooms, rooms.pop(at) - n)
    return bins


def sequences(plan, histogram):
    length, first, per, bin0, at = plan.arrays()
    out = {}
    for n, count in histogram.items():
        mine = np.flatnonzero(length == n)
        assert first[mine].tolist() == sorted(set(first[mine].tolist()))
        for rank in range(count):
            s = mine[np.searchsorted(first[mine], rank, "right") - 1]
            i = rank - first[s]
            out.setdefault(int(bin0[s] + i // per[s]), []).append((int(at[s] + n * (i % per[s])), n))
    return out


CASES = {"even": lambda g: g.integers(1, 256, 800), "middle": lambda g: g.integers(60, 180, 800),
         "long": lambda g: g.integers(90, 256, 500), "few": lambda g: g.choice([94, 82, 81, 175, 56, 44], 600),
         "thirds": lambda g: g.integers(44, 125, 900), "one": lambda g: np.full(50, 100), "short": lambda g: g.integers(1, 9, 900),
         "full": lambda g: np.full(7, 256), "none": lambda g: g.integers(1, 2, 0)}


@pytest.mark.parametrize("case", CASES)
def test_plan_places_every_piece_once_and_no_worse_than_best_fit_decreasing(case):
    histogram = Counter(CASES[case](np.random.default_rng(0)).tolist())
    plan = pp.plan(histogram, 256)
    found = sequences(plan, histogram)
    for placed in found.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 256
    assert sorted(found) == list(range(plan.sequences))
    assert plan.sequences <= best_fit_decreasing(histogram, 256)


def test_patterns_close_thirds_better_than_the_residual_alone():
    histogram = Counter(np.random.default_rng(1).integers(700, 2000, 20_000).tolist())
    alone = pp.Plan(4096)
    pp._residual(alone, np.bincount(np.repeat(list(histogram), list(histogram.values())), minlength=4097))
    assert pp.plan(histogram).sequences < 0.985 * alone.sequences


def test_fitted_repeats_meet_the_conditions_of_the_minimum():
    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(30, 120, 40))
    counts = rng.integers(1, 50, len(lengths)).astype(float)
    members = pp.patterns(lengths, 256)
    x = pp.fitted_repeats(members, counts, 20_000)
    a = np.zeros((len(lengths), len(members)))
    for j, of in enumerate(members):
        for i in of:
            if i >= 0:
                a[i, j] += 1
    slope = a.T @ ((a @ x - counts) / counts)
    assert (x >= 0).all() and slope.min() > -1e-3 and np.abs(slope[x > 1e-3]).max() < 1e-3


def test_patterns_leave_little_free():
    lengths = np.arange(50, 130)
    found = pp.patterns(lengths, 256)
    sums = np.where(found < 0, 0, lengths[found]).sum(axis=1)
    assert len(found) and (sums <= 256).all() and (sums >= 256 - 4).all()


def packed(df, **kwargs):
    return pp.pack(df, PATH, **kwargs).collect()


def check(rows, texts, capacity):
    """texts: [(doc_id, text)] with repeats; every document's ids come back, whole if they fit."""
    from tokenizers import Tokenizer  # noqa: F401
    ids = [x + [1] for x in reference_ids([t or "" for _, t in texts])]
    want = Counter()
    for (doc, _), own in zip(texts, ids):
        for k in range(0, len(own), capacity):
            want[doc, k // capacity, k, tuple(own[k:k + capacity])] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in rows)
    assert got == want
    by = {}
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_pack_is_a_round_trip(spark):
    random.seed(1)
    texts = [(i, " ".join(random.choice(["alpha", "beta,", "Gamma.", "naïve", "x9"]) for _ in range(random.randint(0, 60))))
             for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    n = check(packed(df, capacity=64), texts, 64)
    tokens = sum(len(x) + 1 for x in reference_ids([t for _, t in texts]))
    assert n <= 1.06 * tokens / 64


def test_odd_rows(spark, odd):
    clash = odd.selectExpr("*", "1 AS piece", "2 AS ids", "3 AS nth", "4 AS place", "5 AS l", "6 AS p", "7 AS base")
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    check(packed(clash), texts, 4096)
    assert packed(odd.where("false")) == []
