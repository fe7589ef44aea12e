import random
import zlib

import numpy as np
import pytest

from riskframe.llm import packing
from riskframe.llm.queries import tokenizer_path

TRICKY = ["a  b", " a", "a ", "a\n b", "a \n", "  a", "x\x1c y z", "<|endoftext|> hi <|endoftext|>", "it's we 'll  go",
          "日本 語 テスト", "a　 b", "12 345 a1b2", "", "  ", "\t", "é à", "a b  c", "x\x85 y", "word " * 3000,
          "p\n\nq r", "p\n\n\nq", "p\n\n", "p.\n\nq\nr ! s?! ...", "a !\n? b\n", "w%%% x.### q_-_ (y) \"z\" it's don't. a*$' b'll,",
          "é%%% ü.\nß!! ²³ x² ½. a1. ⅷ"]


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_cached_parts_give_the_tokenizers_ids():
    random.seed(0)
    made = ["".join(random.choice(["a", "the", " ", " ", "\n", "é", "1", ".", "'s", " ", "\x1c", "Z"]) for _ in range(30))
            for _ in range(2000)]
    texts = TRICKY + made
    words = packing.encoder(tokenizer_path())
    for _ in range(2):  # cold and warm
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == reference_ids(texts)


def test_the_token_cache_is_bounded_and_keeps_what_is_frequent(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE_ROWS", 50)
    random.seed(1)
    rare = lambda: "".join(random.choice("abcdefghij") for _ in range(9))
    texts = [" ".join([*(rare() for _ in range(20)), "often,\nand again"]) for _ in range(40)]
    texts += ["a\u00a0often", "often\u2171 x", "x \u00b2often", "often \U000e0fff often"]  # classes that Python may not share
    words = type(packing.encoder(tokenizer_path()))(tokenizer_path())
    assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(texts)] == reference_ids(texts)
    assert len(words) <= 50 and len(words.old) <= 50
    assert " again" in {**words, **words.old}  # rare words that came first do not fill the cache for good


def test_placement_keeps_the_ids_out_of_python(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    plan = packing.pack(docs, tokenizer_path())._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def best_sum(counts, capacity):
    reach = {0}
    for k, n in counts.items():
        for _ in range(n):
            reach |= {r + k for r in reach if r + k <= capacity}
    return max(reach)


def test_best_fill_is_the_closest_sum():
    for seed in range(60):
        random.seed(seed)
        counts = {random.randint(1, 60): random.randint(1, 4) for _ in range(random.randint(1, 6))}
        used = packing.best_fill(counts, 64)
        assert all(n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == best_sum(counts, 64)


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_token_once(seed):
    random.seed(seed)
    h = {random.randint(1, 63): random.randint(1, 30) for _ in range(random.randint(1, 40))}
    how = packing.plan(h, 64)
    seqs = {}
    for k, n in h.items():
        for rank in range(n):
            parts = how.parts(k, rank)
            assert sum(p[0] for p in parts) == k
            for size, seq, offset in parts:
                seqs.setdefault(seq, []).append((offset, size))
    for parts in seqs.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 64 or at & at - 1 == 0
    assert sorted(seqs) == list(range(how.sequences))


def test_plan_does_not_grow_with_the_counts():
    h = {k: 10**9 + k for k in range(1, 1024)}
    assert sum(map(len, packing.plan(h).slots.values())) < 20_000
    assert packing.plan({700: 10**9}).parts(700, 10**9 - 1)


def check_round_trip(rows, docs, capacity):
    """docs: (doc_id, text) with distinct texts per id."""
    pieces, seqs = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == capacity or at & at - 1 == 0
    got = sorted((d or -1, zlib.crc32(b"".join(x for _, x in sorted(p)))) for (d, _), p in pieces.items())
    want = sorted((d or -1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for (d, _), ids in
                  zip(docs, reference_ids([t or "" for _, t in docs])))
    assert got == want


def test_round_trip(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in rows.collect()] + [(10**6 + i, t) for i, t in enumerate(TRICKY)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check_round_trip(packing.pack(df, tokenizer_path()).collect(), docs, 1024)


def test_odd_rows(spark, odd):
    rows = packing.pack(odd, tokenizer_path(), capacity=256).collect()
    total = sum(len(i) + 1 for i in reference_ids([r.text or "" for r in odd.collect()]))
    assert sum(r.length for r in rows) == total
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert [(r.length, r.doc_tokens) for r in rows if r.doc_id == 3] == [(1, 1)]
    assert packing.pack(odd.where("false"), tokenizer_path()).collect() == []


def test_one_length_holds_most_rows(spark):
    df = spark.createDataFrame([(i, "same words here") for i in range(3000)] + [(5000 + i, "w " * i) for i in range(300)],
                               "doc_id long, text string").repartition(7)
    check_round_trip(packing.pack(df, tokenizer_path()).collect(), [tuple(r) for r in df.collect()], 1024)
