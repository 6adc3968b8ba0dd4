import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from goldrec.llm import bpe
from goldrec.llm.common import table, written
from llm.conftest import found


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "stage")
        out.append(docs)
    return out


def test_stages_hand_on_documents(stages, documents):
    assert all(s.columns == documents.columns for s in stages[:-1])
    judged, single, cut, mixed, encoded = stages
    assert 0 < single.count() < judged.count() < documents.count()
    assert cut.count() == single.count() and encoded.count() == mixed.count()
    assert cut.agg(F.sum(F.octet_length("text"))).first()[0] < single.agg(F.sum(F.octet_length("text"))).first()[0]
    words = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in d.collect())
    assert words(mixed) == pytest.approx(1.5 * words(cut), rel=0.01)


def test_last_stage_equals_the_library(stages):
    encoding = bpe._encoding(corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    wanted = sorted((r["doc_id"], len(encoding.encode_ordinary(r["text"]))) for r in stages[3].collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in stages[4].collect()) == wanted


def test_run_equals_its_stages(spark, sf, stages):
    assert found(corpus_pipeline.run(spark, sf)) == found(stages[-1])


def test_stages_take_odd_and_empty_documents(spark, sf, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf), "stage")


def test_repeated_rows_become_one(spark, odd):
    rows = corpus_pipeline.near_duplicates(spark, odd, "").collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"]) == [1, 2, 3, 4, 7, 8, 9, 10] and len(rows) == 10


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
