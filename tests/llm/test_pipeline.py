"""The corpus pipeline, stage by stage, and the queries' columns."""

import pytest
from brute import contained, simhash
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm.common import materialize, table
from daybook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF), name))
    assert all(d.columns == columns for d in seen[:-1])
    raw, clean, lined, one, safe, packed = seen
    assert clean.join(raw, columns, "left_anti").count() == 0
    assert sorted(r.doc_id for r in lined.collect()) == sorted(r.doc_id for r in clean.collect())
    pairs = [(r.doc_id, r.text) for r in lined.collect()]
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in simhash(pairs)})
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    left = [(r.doc_id, r.text) for r in one.collect()]
    bad = {d for d, _, _, _ in contained(left, items)}
    assert sorted(r.doc_id for r in safe.collect()) == sorted(d for d, _ in left if d not in bad)
    total = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert total.count() == safe.count() and total.where("n != t").count() == 0
    assert sorted(r.bucket for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.bucket for r in packed.collect())


CONTRACTS = {
    "op1": ["doc_id", "held_out", "score", "predicted"],
    "op2": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op3": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4": ["query_id", "rank", "vec_id", "score"],
    "op5": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op9": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op10": ["doc_id", "fingerprint", "component_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    want = CONTRACTS.get(name.split("_")[0])
    if want:
        assert QUERIES[name](spark, SF).columns == want
