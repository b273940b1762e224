"""Collocations against a plain count by text."""

import random
import re
from collections import Counter

import numpy as np

from daybook.llm import phrases

DOCS = "doc_id long, text string, lang string, phrase string, n long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=30, top=2000, covered=80):
    n, f, first = Counter(), Counter(), {}
    for i, text, lang in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for k in range(len(words) - m + 1):
                    key = (lang, tuple(words[k : k + m]))
                    f[key] += 1
                    if i is not None:
                        first[key] = min(i, first.get(key, i))
    known = {k: c for k, c in f.items() if 2 <= len(k[1]) and c >= least}
    out = {}
    for (lang, p), a in known.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(g == lang and len(q) > len(p) and 100 * c >= covered * a and inside(q) for (g, q), c in known.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, first.get((lang, p))))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s, d)
        for lang, rows in out.items()
        for i, (s, a, p, left, right, d) in enumerate(sorted(rows)[:top])
    )


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, g, "x", 1) for i, t, g in docs], DOCS).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def random_docs(seed, n=120):
    rng = random.Random(seed)
    words = ["New", "York", "new", "straße", "Über", "a", "b", "the", "Ä", "ä", " x", "o'k", "x y", "日本"]
    gaps = [" "] * 12 + ["  ", "\t", " \t ", ", ", ". ", "\n", "\x0b", "!?", "\x0c", "\r\n", ";", ":"]
    docs = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 60)))
        docs.append((i, text, rng.choice(["en", "de", None, "und", "en"])))
    return docs


def test_equals_plain_on_random_texts(spark):
    docs = random_docs(1) + [(3, "New York New York", "en")] * 40 + [(500, None, "en"), (501, "", None), (502, " .,; ", "fr"), (None, "new york " * 50, "de")]
    want = plain(docs, least=4)
    assert want and run(spark, docs, least=4) == want
    assert run(spark, docs, least=4, top=5, covered=101) == plain(docs, least=4, top=5, covered=101)


def test_false_hits_of_the_bitmap_change_nothing(spark, monkeypatch):
    docs = random_docs(2)
    monkeypatch.setattr(phrases, "may_hold", lambda bitmap, prints: np.ones(len(prints), bool))
    docs_df = spark.createDataFrame([(i, t, g, "x", 1) for i, t, g in docs], DOCS)
    known, totals = phrases.frequent_phrases(docs_df, least=6)
    assert min(r.f for r in known.collect()) >= 6 and sum(r.n for r in totals.collect()) > 0
    assert run(spark, docs, least=6) == plain(docs, least=6)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """Fingerprints of four bits only: every count still is by text."""
    docs = random_docs(4)
    whole = phrases.Block.grams

    def few(self, n, maps):
        at, prints = whole(self, n, maps)
        return at, (prints >> np.uint64(60)) << np.uint64(60)

    # blocks in this process: the tasks' functions, without Spark
    import pyarrow as pa

    monkeypatch.setattr(phrases.Block, "grams", few)
    batch = pa.record_batch({"doc": [d[0] for d in docs], "lang": [d[2] or "und" for d in docs], "text": pa.array([d[1] for d in docs], pa.string())})
    block, _, _, _ = next(phrases._blocks([batch]))
    at, prints = block.grams(2, {})
    assert len(set(prints.tolist())) <= 16
    texts = block.texts(at, 2).to_pylist()
    pieces = [re.findall(r"[^\x20\x09]+", p) for _, t, _ in docs for p in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(FOLD))]
    assert Counter(texts) == Counter(" ".join(w[k : k + 2]) for w in pieces for k in range(len(w) - 1))


def test_equal_phrases_have_equal_fingerprints_wherever_they_stand():
    import pyarrow as pa

    batch = pa.record_batch({"doc": [1, 2, 3], "lang": ["en", "en", "de"], "text": ["x y the  Cat", "the\tcat, the cat the", "the cat"]})
    block, code, _, _ = next(phrases._blocks([batch]))
    at, prints = block.grams(2, {})
    found = {}
    for t, row, p in zip(block.texts(at, 2).to_pylist(), block.row[at].tolist(), prints.tolist()):
        found.setdefault((t, int(code[row])), set()).add(p)
    assert all(len(p) == 1 for p in found.values()) and found["the cat", 0] != found["the cat", 1]


def test_bitmap_of_many_parts(spark):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 70_000).astype(np.uint64) * np.uint64(2)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print long")
    for most in (1 << 28, 1 << 18):
        bitmap = phrases._bitmap(df, most, part_bits=1 << 15)
        assert phrases.may_hold(bitmap, prints).all() and len(bitmap) * 8 == min(most, 1 << 21)
    other = rng.integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert phrases.may_hold(phrases._bitmap(df, 1 << 28), other).mean() < 0.08


def test_empty_table(spark):
    assert run(spark, []) == [] == run(spark, [(1, None, None), (2, "a b", "en")])
