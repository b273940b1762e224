"""Extra columns of any name pass every operator unchanged."""

import pytest

from daybook.llm import chat, clusters, decontaminate, extract, knn, lines, packing, phrases, pii, simhash, substring, toxicity
from daybook.llm.tokens import vocabulary_path
from pyspark.sql import functions as F

ODD = ["__host", "__keys", "__site", "__keep", "__doc", "__mark", "__n", "__id", "__spans", "fp", "doc", "mark", "root", "host", "keys", "id", "n", "h", "item",
       "term", "start", "kind", "score", "label", "vector", "cluster", "slot", "lang", "system", "__Keep", "___n"]
TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.fixture(scope="module")
def docs(spark):
    odd = [c for c in ODD if c.lower() not in {x.lower() for x in ODD[: ODD.index(c)]}]
    base = spark.createDataFrame([(1, TEXT), (2, TEXT + " x"), (3, "mail a@b.example now"), (4, None)], "doc_id long, text string")
    return base.select("*", *[F.lit(f"{c}!").alias(c) for c in odd])


ITEMS = "item_id long, text string"

FILTERS = {
    "lines": lambda s, d: lines.drop_boilerplate(d, F.lit("site")),
    "simhash": lambda s, d: simhash.drop_near_duplicates(d),
    "decontaminate": lambda s, d: decontaminate.drop_contaminated(d, s.createDataFrame([(1, "not in any of these documents at all")], ITEMS)),
    "pii": lambda s, d: pii.sanitise(d),
    "toxicity": lambda s, d: toxicity.drop_toxic(d, s.createDataFrame([(1, 0)], "doc_id long, toxic int")),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters(spark, docs, name):
    out = FILTERS[name](spark, docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} >= {1, 3, 4} and all(r[c] == f"{c}!" for r in rows for c in docs.columns[2:])
    assert next(r.text for r in rows if r.doc_id == 1) == TEXT


OTHERS = {
    "substring": lambda s, d: substring.kept_digest(substring.substring_dedup(d, window=13)),
    "simhash": lambda s, d: simhash.simhash_components(d),
    "pii": lambda s, d: pii.digest(pii.detect(d)),
    "toxicity": lambda s, d: toxicity.scored(d, s.createDataFrame([(1, 0)], "doc_id long, toxic int")),
    "packing": lambda s, d: packing.pack(d, vocabulary_path("byte_bpe_50k.json")),
    "phrases": lambda s, d: phrases.collocations(d, least=1),
    "contaminations": lambda s, d: decontaminate.contaminations(d, s.createDataFrame([(1, TEXT)], ITEMS)),
    "extract": lambda s, d: extract.extract(d.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", F.lit("http://a.b/c"))),
    "clusters": lambda s, d: clusters.clusters(clusters.grid(d.selectExpr("*", "doc_id AS vec_id", "array(0.5D, 1D) AS embedding"), dims=2), k=2),
    "knn": lambda s, d: knn.knn_join(d.drop("vector").selectExpr("*", "doc_id AS vec_id", "array(1L, doc_id) AS vector"), F.col("vec_id") == 1, k=2),
    "chat": lambda s, d: chat.canonical(d.drop("system").selectExpr("*", "doc_id AS conv_id", "1L AS turn", "'user' AS role")),
}


@pytest.mark.parametrize("name", OTHERS)
def test_others_ignore_them(spark, docs, name):
    assert OTHERS[name](spark, docs).count() >= 1


@pytest.mark.parametrize("name", ["fp", "id", "doc", "root", "least"])
def test_simhash_ids_of_any_name(spark, name):
    out = simhash.simhash_components(spark.createDataFrame([(1, TEXT), (2, TEXT)], f"{name} long, text string"), id_col=name)
    assert [(r[0], r.component_id) for r in out.collect()] == [(1, 1), (2, 1)] or out.columns[0] == name and out.count() == 2
