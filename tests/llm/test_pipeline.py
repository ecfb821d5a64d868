import os

import corpus_pipeline
from helpers import FOLDER, documents, odd_docs

from ledgerlark.llm import bpe, lines, minhash, mixing, quality
from ledgerlark.llm.common import stage
from ledgerlark.llm.queries import tokenizer_path
from ledgerlark.session import read_table


def test_every_stage_does_its_operator(spark):
    docs, labels = documents(spark), read_table(spark, FOLDER, "labels")
    kinds = dict(docs.dtypes)
    predicted = {r.doc_id for r in quality.scored(docs, labels).where("predicted = 1").collect()}
    for k, (name, apply) in enumerate(corpus_pipeline.STAGES):
        out = stage(apply(spark, docs, FOLDER), "test-stage")
        if k < 4:
            assert dict(out.dtypes) == kinds and out.columns == docs.columns
        if name == "quality":
            assert {r.doc_id for r in out.select("doc_id").collect()} == predicted
        if name == "line dedup":
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in lines.drop_recurring_lines(docs).collect())
        if name == "near dedup":
            assert sorted(r.doc_id for r in out.collect()) == sorted({r.class_id for r in minhash.near_duplicates(docs).collect()})
        if name == "mixing":
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.copies))
        docs = out
    assert docs.columns == ["doc_id", *[c.split()[0] for c in bpe.COLUMNS.split(", ")]] and docs.count()


def test_odd_documents_pass(spark, tmp_path):
    docs = odd_docs(spark)
    for name, apply in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(apply(spark, docs, FOLDER), "test-odd")
        assert name == "encoding" or docs.columns == before
    assert os.path.exists(tokenizer_path())
