import random

import numpy as np

from riskframe.llm import decontam


def plain_alignment(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = decontam.MATCH if a[i - 1] == b[j - 1] and b[j - 1] else decontam.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] + decontam.GAP, h[i][j - 1] + decontam.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_matches_the_plain_recurrence():
    rng = np.random.default_rng(0)
    items = [rng.integers(1, 6, rng.integers(1, 15)) for _ in range(200)]
    texts = [rng.integers(0, 6, rng.integers(1, 30)) for _ in range(200)]
    best, end = decontam.align(items, texts)
    assert best.tolist() == [plain_alignment(a, b) for a, b in zip(items, texts)]
    assert all(e <= len(t) for e, t in zip(end.tolist(), texts))


def edited(words, rate, rng):
    out = []
    for w in words:
        x = rng.random()
        if x < rate / 3:
            continue
        out.append("other%d" % rng.randrange(9) if x < 2 * rate / 3 else w)
        if x > 1 - rate / 3:
            out.append("added")
    return out


def test_copies_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(15, 50)))) for k in range(20)]
    docs, want = [], set()
    for d in range(300):
        words = rng.choices(vocab, k=rng.randint(30, 200))
        if d % 3 == 0:
            k = d // 3 % 20
            at = rng.randrange(len(words))
            words[at:at] = edited(items[k][1].split(), rng.choice([0, 0.1, 0.2]), rng)
            want.add((d, k))
        text = " ".join(words)
        docs.append((d, text.upper() if d % 6 == 0 else text.replace(" ", ", ")))
    docs += [(1000 + i, "x y z " + items[3][1]) for i in range(200)]  # an item that a large share of documents holds
    want |= {(1000 + i, 3) for i in range(200)}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0.4 <= r.score <= 1 for r in got)
    clean = {r.doc_id for r in decontam.without_leaks(df, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in want}


def test_table_against_all_pairs(spark):
    """Every document against every item by the plain recurrence, on a small table."""
    import duckdb
    p = "/root/testdata/sf0.001"
    docs = [(i, t) for i, t in duckdb.sql(f"select doc_id, text from '{p}/documents.parquet'").fetchall() if len(t) < 1500]
    items = duckdb.sql(f"select item_id, text from '{p}/benchmark.parquet'").fetchall()
    han = ["光合作用把光能变成化学能", "北京是中华人民共和国的首都", "ภาษาไทยไม่มีเว้นวรรค"]
    items += [(9001, han[0]), (9002, han[1]), (9003, han[2]), (9004, "Photosynthesis equation"), (9005, "Kilimanjaro"), (9006, "a b"),
              (9007, "水")]
    docs += [(8000, "前言" + han[0] + "后记"), (8001, han[1].replace("中华", "")), (8002, "x " + han[2] + " y"),
             (8003, "the PHOTOSYNTHESIS, equation is"), (8004, "photosynthesis is an equation"), (8005, "on kilimanjaro."),
             (8006, "北京的天气很好 a b 水"), (8007, "光合 作用 把 光能 变成 化学能")]
    want = set()
    for index in decontam.build_indexes([(i, t.encode()) for i, t in items]):
        numbers = [index.numbers(decontam.words_of(t.encode())) for _, t in docs]
        for (d, _), y in zip(docs, numbers):
            for i, x in index.items:
                if len(y) and decontam.align([x], [y])[0][0] / (decontam.MATCH * len(x)) >= index.threshold:
                    want.add((d, i))
    assert {(8000, 9001), (8001, 9002), (8002, 9003), (8003, 9004), (8005, 9005), (8007, 9001)} == {w for w in want if w[0] >= 8000}
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_many_slices_give_the_same(spark, monkeypatch, benchmark, odd):
    text = benchmark.first().text
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(50, "pre " + text + " post")], "doc_id long, text string"))
    one = decontam.leaks(docs, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in one] == [(50, 1, 1.0)]
    many = decontam.leaks(docs, benchmark, slice_mb=0 or 1).collect()
    assert one == many
    monkeypatch.setattr(decontam, "slices", lambda *a: iter([[(1, text.encode())], [(2, None)], [(3, b"")]]))
    assert decontam.leaks(docs, benchmark).collect() == one


def test_odd_and_empty_tables(spark, odd, benchmark):
    assert decontam.leaks(odd, benchmark).collect() == []
    kept = decontam.without_leaks(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontam.leaks(odd.where("false"), benchmark).collect() == []
    assert decontam.leaks(odd, benchmark.where("false")).collect() == []
    assert decontam.without_leaks(odd, benchmark.where("false")).count() == odd.count()


def test_edited_copies_beside_a_verbatim_one(spark):
    """The n-grams that the copies share are common, those of the one verbatim copy alone are rare: all are found."""
    item = [f"w{i}" for i in range(40)]
    verbatim, copy = " ".join(item), " ".join("new" if i % 4 == 3 else w for i, w in enumerate(item))
    bench = spark.createDataFrame([(7, verbatim)], "item_id long, text string")
    for others, score in ((20 * [copy], 51 / 80), (6 * [" ".join(item[:18])], 36 / 80)):
        docs = [(0, f"a b {verbatim} c")] + [(i, f"x{i} y {t} z") for i, t in enumerate(others, 1)]
        docs += [(200, "w0 w1 w2 alone w9 w9 w9")]
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.score for r in decontam.leaks(df, bench).collect()}
        assert got == {0: 1.0, **{i: score for i in range(1, len(others) + 1)}}
        assert [r.doc_id for r in decontam.without_leaks(df, bench).collect()] == [200]


def test_rarest_hits_come_first_and_all_where_they_fail():
    item = np.array([0, 0, 0, 0, 0, 0, 1, 1])
    held = np.array([9, 1, 5, 2, 2, 7, 3, 3])
    assert decontam.rarest(item, held, 2).tolist() == [False, True, False, True, True, False, True, True]
    words = [b"w%d" % i for i in range(30)]
    index = decontam.build_index([(1, words)])
    index.held[:] = 100
    stray = index.hits(index.numbers(words[20:23]))[1]
    index.held[stray] = 1  # the rarest n-gram stands far from the copy, which holds common ones alone
    text = [b"w0", b"x", *words[:15], *[b"y"] * 300, *words[20:23], b"z"]
    (found,) = decontam.matches(index, [index.numbers(text)])
    assert found[1:3] == (1, 0.5) and found[4] == 17


def test_held_counts_every_document_once(spark):
    docs = spark.createDataFrame([(i, "a b c d a b c" if i % 3 else "b c d") for i in range(30)], "doc_id long, text string").repartition(4)
    (index,) = decontam.build_indexes([(1, b"a b c d")])
    decontam.count_held(index, docs, "doc_id", "text")
    assert sorted(index.held.tolist()) == [20, 30]


def test_the_bound_is_above_every_alignment():
    rng = np.random.default_rng(3)
    for _ in range(500):
        x, y = rng.integers(1, 9, rng.integers(3, 15)), rng.integers(0, 9, rng.integers(1, 30))
        share = decontam.align([x], [y])[0][0] / (decontam.MATCH * len(x))
        assert decontam.may_reach(x, y, share)


def test_indexes_of_one_slice_share_a_map(spark):
    """Items of several sizes: one Python map drops what any of them finds."""
    docs = spark.createDataFrame([(1, "x photosynthesis y"), (2, "one two three four five"), (3, "other words"), (4, None)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "photosynthesis"), (2, "one two three four five"), (3, "quantum entanglement")],
                                  "item_id long, text string")
    kept = decontam.without_leaks(docs, items)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4]


def test_small_batches_keep_all_rows_in_order():
    import pyarrow as pa

    from riskframe.llm.common import small_batches
    texts = ["x" * n for n in (0, 5, 3000, 0, 7, 900)] + [None]
    batch = pa.RecordBatch.from_pydict({"i": list(range(7)), "t": texts})
    parts = list(small_batches(iter([batch, batch.slice(0, 0)]), 1, 1000))
    assert len(parts) > 3 and [t for p in parts for t in p.column(1).to_pylist()] == texts and parts[-1].num_rows == 0
