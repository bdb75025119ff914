"""The pipeline against its stages' plain versions, and its hand-over."""

from collections import Counter

import pytest

import data
from test_jaccard import brute as components
from test_rules import cleaned
from parity.llm import common, op02_toxicity, op10_secrets

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def sf_dir(spark, some, labels):
    d = common.shared_path(spark, "pipeline-test")
    data.docs(spark, some).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def corpus():
    text = " ".join(f"word{i}" for i in range(60))
    some = [(i, f"{text} {i}" if i < 6 else " ".join(f"d{i}w{k}" for k in range(50)), "en", "s", None) for i in range(30)]
    some += [(200 + i, " ".join(f"p{i}w{k}" for k in range(50)) + "\nAll rights reserved by the site", "en", "s", None) for i in range(9)]
    some += [(100, "too short", "en", "s", 9), (101, "again and again " * 20, "en", "s", 1), (102, None, None, None, None),
             (103, " ".join(f"z{k}" for k in range(40)) + " password=hunter2abc", "en", None, 7), (None, text, None, None, 1)]
    return some


def test_stages(spark):
    some = corpus()
    d = sf_dir(spark, some, [])
    docs = common.read(spark, d, "documents")
    schema = docs.schema
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "jaccard_join", "secret_scans", "packing"]
    kept = some
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, d), name)
        assert docs.schema == schema
        if name == "quality_rules":
            kept = cleaned(kept)
        if name == "jaccard_join":
            kept = [r for r, (i, _, c) in zip(kept, components(kept)) if i is None or i == c]
        if name == "secret_scans":
            kept = [(*r[:1], op10_secrets.mask(r[1]), *r[2:]) for r in kept]
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter((r[0], r[1]) for r in kept), name
    packed = corpus_pipeline.run(spark, d).collect()
    assert Counter(r.doc_id for r in packed) == Counter(r[0] for r in kept)
    assert sum("All rights" in r[1] for r in kept) == 1      # the footer is left in its first document
    assert any("[SECRET]" in r[1] for r in kept) and len(kept) < len(some) - 5


def test_empty_corpus(spark):
    assert corpus_pipeline.run(spark, sf_dir(spark, [], [])).count() == 0


def test_toxic_documents_go(spark):
    from conftest_paths import SF
    d = f"{SF}/sf0.01"
    docs = common.read(spark, d, "documents")
    out = corpus_pipeline.toxicity(spark, docs, d)
    gone = {r.doc_id for r in op02_toxicity.classify(docs, common.read(spark, d, "labels")).collect() if r.predicted}
    assert gone and {r.doc_id for r in docs.collect()} - {r.doc_id for r in out.collect()} == gone


def test_intermediate_tables_go_with_one_call(spark):
    common.drop_written(spark)
    made = [common.written(spark.range(3).toDF("id"), "drop-test") for _ in range(2)]
    paths = [m.inputFiles()[0].rsplit("/", 1)[0] for m in made]
    assert [m.count() for m in made] == [3, 3]
    assert common.drop_written(spark) == 2 and common.drop_written(spark) == 0
    import os
    assert not any(os.path.exists(p.removeprefix("file:").replace("///", "/")) for p in paths)
