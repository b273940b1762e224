"""Top-k search and benchmark decontamination against plain versions."""

import random

import pytest
from brute import contained, knn, rows
from pyspark.sql import functions as F

from daybook.llm import decontaminate as D
from daybook.llm.knn import knn_join

IS_QUERY = lambda: F.col("vec_id") % 20 == 0
VECTORS = "vec_id long, vector array<long>, id string, v int"


@pytest.mark.parametrize("options", [{}, {"group_rows": 7, "block_rows": 50, "pivots": 5}, {"sample_rows": 20, "pivots": 20}])
def test_knn_equals_brute_force(spark, options):
    r = random.Random(5)
    vectors = [(i, [r.randint(-2, 2) for _ in range(3)]) for i in range(300)]
    vectors += [(500, None), (501, [1, None, 2]), (None, [1, 1, 1]), (505, []), (506, [2]), (507, [1, 2, 3, 4]), (20, [9, 9, 9]), (20, [9, 9, 9])]
    vectors += [(1000 + i, [1, 1, 1]) for i in range(200)]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], VECTORS).repartition(5)
    assert rows(knn_join(df, IS_QUERY(), **options)) == sorted(knn(vectors), key=repr)


def test_knn_of_large_components_and_of_nothing(spark):
    r = random.Random(2)
    vectors = [(i, [r.randint(-(2**30), 2**30) for _ in range(5)]) for i in range(60)]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], VECTORS)
    assert rows(knn_join(df, IS_QUERY())) == sorted(knn(vectors), key=repr)
    assert knn_join(df.limit(0), IS_QUERY()).count() == 0
    assert knn_join(df.where("vec_id % 20 = 1"), IS_QUERY()).count() == 0


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_contaminations_equal_brute_force(spark, broadcast_rows):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(3, 70)))) for i in range(40)]
    items += [(90, items[0][1]), (91, None), (92, ""), (None, items[1][1])]
    docs = []
    for i in range(80):
        text = r.choices(vocabulary, k=r.randint(0, 300))
        for _ in range(r.randint(0, 2)):
            part = r.choice(items[:40])[1].split()
            cut = part[: max(1, int(len(part) * r.choice([1, 0.9, 0.8, 0.6])))]
            text[r.randint(0, len(text)) : 0] = [w.upper() + "," for w in cut]
        docs.append((i, " ".join(text)))
    docs += [docs[3], docs[3], (3, docs[4][1]), (None, docs[5][1]), (500, None), (501, ""), (502, "  ".join(r.choices(vocabulary, k=20000)) + " " + items[9][1])]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, mark int, item string").repartition(4)
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = D.contaminations(df, tests, broadcast_rows=broadcast_rows)
    got = sorted({tuple(x) for x in found.select("doc", "item", "matched", "n_shingles").collect()}, key=repr)
    want = contained(docs, items)
    assert got == want and len(want) > 10
    bad = {(d, i) for d, i, _, _ in want}
    clean = D.drop_contaminated(df, tests, broadcast_rows=broadcast_rows)
    assert clean.columns == df.columns
    assert clean.count() == sum(1 for d in docs if not any(contained([d], items)))
    assert bad
    assert D.drop_contaminated(df.limit(0), tests).count() == 0
    assert D.contaminations(df, tests.limit(0)).count() == 0
