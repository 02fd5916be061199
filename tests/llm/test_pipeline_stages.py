"""The pipeline against plain versions of its stages."""

import re

import numpy as np
from brute import kept_copies, near_classes

import corpus_pipeline
from tierflow import storage
from tierflow.llm import packing, queries, stages, toxicity

DIRECTORY = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "decontamination", "packing",
    ]


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    labels = spark.read.parquet(f"{DIRECTORY}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    clean = {r.doc_id for r in scored if not r.predicted}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in clean}
    texts = {i: texts[i] for i in kept_copies(texts)}
    classes, _ = near_classes(texts)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    items = [r.text for r in spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()]
    plain = [re.sub(r"\W+", " ", i).lower() for i in items]
    texts = {i: t for i, t in texts.items() if not any(p in re.sub(r"\W+", " ", t).lower() for p in plain)}
    encoder = packing.load_encoder(queries.tokenizer_path())
    rows = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for doc, text in texts.items():
        pieces = sorted((r.start, r.ids) for r in rows if r.doc_id == doc)
        got = np.concatenate([np.frombuffer(p, "<u4") for _, p in pieces]).tolist()
        assert got == encoder.encode_ordinary(text) + [packing.END_ID]


def test_run_leaves_the_stages_only(spark):
    home = storage._staging_home(spark)
    before = set(storage.names_in(spark, home))
    corpus_pipeline.run(spark, DIRECTORY)
    left = sorted(name.rsplit("-", 1)[0] for name in set(storage.names_in(spark, home)) - before)
    assert [n for n in left if n.startswith("pipeline-")] == sorted(f"pipeline-{n}" for n, _ in corpus_pipeline.STAGES[:-1])
    assert not [n for n in left if n.startswith("scope")]


def test_stages_keep_the_columns_and_take_edge_cases(spark, edge_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_docs, DIRECTORY).columns == edge_docs.columns
        empty = stage(spark, no_docs, DIRECTORY)
        assert empty.columns == no_docs.columns and empty.count() == 0
    assert stages.pack(spark, no_docs, DIRECTORY).count() == 0
    assert stages.drop_copies(spark, edge_docs, DIRECTORY).filter("doc_id is null").count() == 1
