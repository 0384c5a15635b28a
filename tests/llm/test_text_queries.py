"""The registered queries: against SQL where there is some, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from seqtables.llm.common import documents
from seqtables.llm.registry import ORACLES, QUERIES
from tests.compare import compare, connection

CONTRACT = {
    "op3_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_tokenfiles": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_bytepairs": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op10_syncmers": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, sf, name):
    assert compare(spark, connection(sf), name, sf) == ""


@pytest.mark.parametrize("name", list(CONTRACT))
def test_contract_columns(spark, sf, name):
    got = QUERIES[name](spark, sf)
    assert got.columns[:len(CONTRACT[name])] == CONTRACT[name]


def test_pipeline_stages(spark, sf):
    docs = documents(spark, sf)
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == documents(spark, sf).columns
        if name != "mixture":
            assert docs.count() <= rows
            rows = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
