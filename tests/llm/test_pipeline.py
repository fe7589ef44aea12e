"""The pipeline against its stages in plain Python on a small table, and every stage on odd rows."""
import itertools
import re
import zlib

import numpy as np

import corpus_pipeline
from riskframe.llm import decontam, packing, quality, secret_scan, simhash
from riskframe.llm.queries import quality_model, table, tokenizer_path
from riskframe.llm.spans import masked

SF = "/root/testdata/sf0.001"


def test_rows_match_the_plain_stages(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    model = quality_model(table(spark, SF, "documents"), table(spark, SF, "labels"))
    docs = [(i, t) for i, t in docs if model.score(quality.features(t.encode())[None])[0] >= 0.3]
    prints = {i: simhash.fingerprint(t.encode()) for i, t in docs}
    root = {i: i for i, _ in docs}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    docs = [(i, t) for i, t in docs if root[i] == i]
    index = decontam.build_index([(r.item_id, decontam.words_of(r.text.encode())) for r in table(spark, SF, "benchmark").collect()])
    numbers = {i: index.numbers(decontam.words_of(t.encode())) for i, t in docs}
    leaked = {i for i, y in numbers.items() for _, x in index.items
              if len(set(x) & set(y)) > 4 and decontam.align([x], [y])[0][0] / (2 * len(x)) >= 0.4}
    docs = [(i, t) for i, t in docs if i not in leaked]
    grammar = secret_scan.learn(spark.createDataFrame(docs, "doc_id long, text string"))
    docs = [(i, masked(t, grammar.spans(t)[1], lambda k: "[SECRET]")) for i, t in docs]
    ids = packing.encoder(tokenizer_path()).encode([t for _, t in docs])
    want = {(i, len(x) // 4 + 1): x + b"\0\0\0\0" for (i, _), x in zip(docs, ids)}

    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.doc_tokens) for r in got} == set(want)
    for r in got:
        piece = want[r.doc_id, r.doc_tokens][4 * r.start:4 * (r.start + r.length)]
        assert zlib.crc32(piece) == r.ids_crc32
    assert sum(r.length for r in got) == sum(len(x) // 4 for x in want.values())
    assert leaked and len(want) < 200


def test_stages_keep_the_columns_and_stand_odd_rows(spark, odd, labels, benchmark, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, source in enumerate((odd, odd.where("false"))):
        docs = source
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            path = str(tmp_path / f"{k}-{i}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            if i < 4:
                assert docs.columns == odd.columns
        assert (docs.count() > 0) == (k == 0)


def test_registry():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d", n)} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
    assert np.all([callable(f) for _, f in corpus_pipeline.STAGES])
