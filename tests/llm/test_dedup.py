"""Substring, SimHash and line deduplication against plain versions."""

import random

import numpy as np
import pytest
from brute import lines as plain_lines
from brute import rows, simhash, substring
from pyspark.sql import functions as F

from daybook.llm import lines
from daybook.llm import simhash as S
from daybook.llm import substring as D

DOCS = "doc_id long, text string, fp string, h long"


@pytest.fixture(scope="module")
def passages():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "zz,"]
    return vocabulary, [r.choices(vocabulary, k=r.randint(5, 80)) for _ in range(30)]


def frame(spark, docs, schema=DOCS):
    return spark.createDataFrame([(*d, "x", 7) for d in docs], schema).repartition(5)


def test_substring_equals_brute_force(spark, passages):
    vocabulary, base = passages
    r, docs = random.Random(5), []
    for _ in range(120):
        text = []
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            a = r.randint(0, len(b) - 1)
            text += b[a : a + r.randint(1, 60)] + r.choices(vocabulary, k=r.randint(0, 6))
        docs.append((r.randint(-50, 400), r.choice([" ", "\n", "  \t"]).join(text)))
    long = " ".join(r.choices(vocabulary, k=20000))
    docs += [docs[3], docs[3], (None, docs[5][1]), (7, None), (8, ""), (9, "a b"), (500, long), (501, "start " + long)]
    got = D.kept_digest(D.substring_dedup(frame(spark, docs)))
    assert rows(got) == substring(docs)


def test_substring_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert D.kept_digest(D.substring_dedup(empty)).collect() == []


def test_anchors_of_any_two_places_meet():
    for a in range(D.PERIOD):
        for b in range(D.PERIOD):
            assert any(D.COVER[(a + s) % D.PERIOD] and D.COVER[(b + s) % D.PERIOD] for s in range(D.PERIOD))


@pytest.mark.parametrize("tile_rows", [65_536, 3])
def test_simhash_equals_brute_force(spark, passages, tile_rows):
    vocabulary, base = passages
    r, docs = random.Random(9), []
    for i in range(250):
        b = list(base[i % 30])
        if i % 3:
            b[r.randrange(len(b))] = r.choice(vocabulary)
        docs.append((i * 7 % 251, " ".join(b * 3)))
    docs += [(None, docs[0][1]), (None, "no other text like this one"), (900, ""), (901, None), (902, "One two"), (903, "one  two"), docs[4], docs[4]]
    assert rows(S.simhash_components(frame(spark, docs), tile_rows=tile_rows)) == simhash(docs)


def test_one_of_each_group_stays(spark, passages):
    _, base = passages
    docs = [(i, " ".join(base[i % 10])) for i in range(40)] + [(3, " ".join(base[3])), (None, " ".join(base[0])), (None, None)]
    kept = S.drop_near_duplicates(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "fp", "h"]
    names = {c for _, _, c in simhash(docs) if c is not None}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([*names, None, None], key=repr)
    assert S.drop_near_duplicates(frame(spark, docs).limit(0)).count() == 0


def test_ids_shared_by_groups_cost_no_group_its_row(spark, passages):
    _, base = passages
    a, b, c = (" ".join(base[i]) for i in (0, 1, 2))
    for docs, groups in (
        ([(5, a), (5, b), (7, a), (8, b)], {a, b}),
        ([(5, a), (5, b), (5, c)], {a, b, c}),
        ([(5, a), (5, a), (6, a), (6, b)], {a, b}),
        ([(1, a), (2, b), (1, b), (2, a), (1, c)], {a, b, c}),
    ):
        kept = [r.text for r in S.drop_near_duplicates(frame(spark, docs)).collect()]
        assert sorted(kept) == sorted(groups)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 160)]
    got = dict(rows(S.components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long").repartition(4))))
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_lines_equal_brute_force(spark):
    r = random.Random(1)
    common = ["Home | About", "(c) site", "", "  ", "All rights"]
    pages = []
    for i in range(150):
        host = r.choice(["a", "a", "a", "b", "c", None])
        body = [r.choice(common) for _ in range(r.randint(0, 3))] + [f"line {r.randint(0, 400)}" for _ in range(r.randint(0, 4))]
        pages.append((i, host, None if i % 37 == 0 else "\n".join(body)))
    pages += [(900, "rare", "Home | About\nx"), (901, "long", "\n".join(["same"] * 20000)), pages[1], pages[1]]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, host string, text string, keys string")
    got = lines.drop_boilerplate(df, F.col("host"))
    assert got.columns == df.columns
    assert rows(got.drop("keys")) == plain_lines(pages)
    counted = lines.drop_boilerplate(df, F.col("host"), counts=True)
    assert counted.where("n_dropped > 0").count() > 0 and counted.where("n_dropped > n_lines").count() == 0
    assert lines.drop_boilerplate(df.limit(0), F.col("host")).count() == 0


def _near_random(n, seed):
    """Random fingerprints, a third of them within six bits of another."""
    g = np.random.default_rng(seed)
    fps = g.integers(0, 1 << 64, n, np.uint64)
    for i in range(0, n, 3):
        fps[i] = fps[int(g.integers(n))]
        for bit in g.integers(0, 64, int(g.integers(1, 7))):
            fps[i] ^= np.uint64(1) << np.uint64(bit)
    return np.unique(fps)


def _trees(n, found):
    forest = S._Forest(n)
    for i, j in found:
        forest.join(i, j)
    return [forest.root(i) for i in range(n)]


@pytest.mark.parametrize("parts", [4, 8])
@pytest.mark.parametrize("worth", [0, 1 << 40])
def test_refined_tiles_lose_no_link(parts, worth, monkeypatch):
    both = _near_random(6000, parts)
    monkeypatch.setattr(S, "GROUP_PAIRS", worth)
    for a, b in ((both[::2], both[1::2]), (both, None)):
        other, base = (a, 0) if b is None else (b, len(a))
        nodes = a if b is None else np.concatenate((a, b))
        plain = [(i, j + base) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ other) <= 4).tolist()]
        got = S._tile_links(a, b, 4, parts)
        assert _trees(len(nodes), got) == _trees(len(nodes), plain)
        compared = sum(len(i) * len(j) for i, j in S._blocks(a, b, 4, parts, 1 << 21)) / (len(a) * len(other))
        assert compared == 1 if worth else compared < {4: 0.1, 8: 0.01}[parts]


@pytest.mark.parametrize("which", [0, 1])
def test_both_grids_find_the_same_links(spark, which):
    fps = _near_random(3000, 5)
    frame_ = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(6)
    index = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    plain = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 4).tolist()]
    for tile_rows in (65_536, 7):
        grid = S.grids(frame_, 4, tile_rows)[which]
        found = S.links(frame_, 4, tile_rows, grid).collect()
        assert _trees(len(fps), [(index[r.a], index[r.b]) for r in found]) == _trees(len(fps), plain)
    assert int(grid.size.sum()) == len(fps)
    # a pair the grid leaves out is further apart than the radius: the share it keeps, on random values
    _, pairs = grid.costs()
    assert pairs / (len(fps) ** 2 / 2) < (0.4, 0.1)[which]


def test_the_grid_that_sends_less_is_taken():
    g = np.random.default_rng(1)
    fps = g.integers(0, 1 << 64, 100_000, np.uint64)
    sizes = [np.zeros((33, 33), np.int64), np.zeros((17,) * 4, np.int64)]
    for size, kind in zip(sizes, ("<u4", "<u2")):
        np.add.at(size, tuple(np.bitwise_count(fps.view(kind).reshape(-1, size.ndim)).T), 1)
    small, large = ([S.Grid(size, 4, t).costs()[0] for size in sizes] for t in (65_536, 2))
    assert small[0] < small[1] and large[1] < large[0]
