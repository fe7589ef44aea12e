import itertools
import random

import pytest
import xxhash

from riskframe.llm import simhash
from riskframe.llm.components import star_forest


def plain_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(prints):
    """Least id reachable over links of at most 3 bits, by union-find over all pairs. prints: (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        k = find(i)
        ids = [x for x in (least.get(k), d) if x is not None]
        least[k] = min(ids) if ids else None
    return [least[find(i)] for i in range(len(prints))]


@pytest.mark.parametrize("text", ["a", "a b", "A b C", "x y z w", "É é A", "a\x85b c d e", "", None, " \n", "w " * 5000])
def test_fingerprint(text):
    raw = None if text is None else text.encode()
    assert simhash.fingerprint(raw) == plain_print(text)


def test_xxh64_is_the_one_of_spark(spark):
    row = spark.sql("select xxhash64('the quick brown') h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64(b"the quick brown", seed=42).intdigest()


@pytest.mark.parametrize("group_rows", [1024, 6, 1])
def test_links_of_every_level(spark, group_rows):
    """A tight cluster, chains and far fingerprints; small groups force the second and third level."""
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(40)]
    prints = list(base)
    for b in base[:10]:
        prints += [b ^ sum(1 << k for k in random.sample(range(64), random.randint(1, 5))) for _ in range(12)]
    hub = base[0]
    prints += [hub ^ (1 << i) ^ (1 << j) for i, j in itertools.combinations(range(20), 2)]
    prints = list(dict.fromkeys(prints))
    rows = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    df = spark.createDataFrame(rows, "fp long")
    forest = {r.node: r.root for r in star_forest(simhash.near_edges(df, group_rows=group_rows)).collect()}
    want = classes([(i, p) for i, p in enumerate(prints)])
    got_root = [forest.get(r[0], r[0]) for r in rows]
    same = {}
    for g, w in zip(got_root, want):
        assert same.setdefault(g, w) == w
    assert len(set(got_root)) == len(set(want))


def test_copies_of_a_fingerprint_by_level(spark):
    """4 copies, 16 where first blocks are full, 320 and 6400 below; the last groups are bounded by their free bits."""
    first, levels = simhash._masks(3)
    assert [len(first)] + [sum(map(len, m.values())) // len(m) for m in levels] == [4, 4, 20, 20]
    kept = [{m.bit_count() for m in first}] + [{x.bit_count() for ms in level.values() for x in ms} for level in levels]
    assert kept == [{16}, {28}, {46}, {55}]
    random.seed(5)
    prints = [random.getrandbits(48) << 16 for _ in range(60)]  # one full block, all else random
    rows = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "fp long")
    one = rows.mapInArrow(simhash._split_rows(None, first, 3), "mask long, key long, fp long")
    two = one.mapInArrow(simhash._split_rows(levels[0], [], 3), "mask long, key long, fp long")
    assert one.count() == 4 * 60 and two.count() == 16 * 60
    full = two.groupBy("mask", "key").count().where("count > 20").count()
    assert full == 0 and one.groupBy("mask", "key").count().where("count > 20").count() == 1


def test_stars_are_told_exactly(spark):
    from riskframe.llm.components import _is_stars
    of = lambda rows: _is_stars(spark.createDataFrame(rows, "a long, b long"))
    assert of([(3, 1), (2, 1), (9, 8)]) and of([]) and not of([(3, 2), (2, 1)]) and not of([(3, 1), (3, 2)])
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(260)]
    root = list(range(300))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, y in edges:
        x, y = sorted((find(x), find(y)))
        root[y] = x
    got = {r.node: r.root for r in star_forest(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in range(300) if find(i) != i}


def test_groups_match_brute_force(spark, odd):
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_groups(odd).collect()), key=str)
    prints = [(r.doc_id, plain_print(r.text)) for r in odd.collect()]
    assert got == sorted(((d, p, c) for (d, p), c in zip(prints, classes(prints))), key=str)


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_groups(docs).collect()}
    prints = [(r.doc_id, plain_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    assert got == {d: (p, c) for (d, p), c in zip(prints, classes(prints))}


def test_one_row_stays_of_each_group(spark, odd):
    odd = odd.selectExpr("*", "7 AS __row", "9 AS id")
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns and {r["__row"] for r in kept.collect()} == {7}
    rows = kept.collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in odd.collect()]
    assert len(rows) == len(set(zip(classes(prints), [p == 0 for _, p in prints])))
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 3, 6, 7, 8, 9]  # 3, 4, 5 are wordless
    assert [r.text for r in rows if r.doc_id is None] == ["null id text with some words in it"]


def test_rows_keep_their_numbers_when_files_are_split_anew(spark, tmp_path, monkeypatch):
    """Other file splits between the fingerprints and the last read, as after the loss of an executor."""
    random.seed(8)
    texts = [" ".join(random.choices("abcdefghij", k=30)) for _ in range(60)]
    rows = [(i, texts[i % 60]) for i in range(240)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(path)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = simhash.near_groups

    def split_anew(*args, **kw):
        out = whole(*args, **kw)
        spark.conf.set(key, "6000000")
        return out

    monkeypatch.setattr(simhash, "near_groups", split_anew)
    try:
        spark.conf.set(key, "1k")
        kept = simhash.one_per_group(spark.read.parquet(path)).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(tuple(r) for r in kept) == rows[:60]


def test_empty_table(spark, odd):
    assert simhash.near_groups(odd.where("false")).collect() == []
    assert simhash.one_per_group(odd.where("false")).collect() == []


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (None, 3), (2, None)]
    got = {r.node: r.root for r in star_forest(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 50)}}
