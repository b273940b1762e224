"""Toxicity, personal data, tokens, packing and chat formatting."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from brute import ftrl as plain_ftrl
from brute import pii as plain_pii
from brute import rows
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from daybook.llm import chat, packing, pii, records, toxicity
from daybook.llm.tokens import PieceEncoder, vocabulary_path

DOCS = "doc_id long, text string, label int, features string"


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS).repartition(4)


# ------------------------------------------------------------------ toxicity


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(4)
    good, bad = [f"g{i}" for i in range(300)], ["vile", "nasty", "awful"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        text = r.choices(good, k=r.randint(20, 120))
        if toxic:
            for _ in range(6):
                text[r.randrange(len(text))] = r.choice(bad)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs += [(5000, None), (5001, ""), (None, "x"), (5002, "word " * 20000), docs[0], docs[0]]
    labels += [(None, 1), (3, None), (7000, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    df = frame(spark, docs)
    got = toxicity.scored(df, marks)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(docs) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in out)
    test = [(x.predicted, x.doc_id % 5 == 0) for x in out if x.held_out and x.doc_id is not None and x.doc_id < 900]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in out if x.doc_id is not None)
    assert sum(p for p, t in test if t) >= 0.9 * sum(t for _, t in test) and not any(p for p, t in test if not t)
    kept = toxicity.drop_toxic(df, marks)
    assert kept.columns == df.columns and kept.count() == sum(1 - x.predicted for x in out)
    # the held-out labels play no part
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows(toxicity.scored(df, flipped)) == rows(got)


def test_toxicity_without_labels(spark):
    df = frame(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(x.score, x.predicted) for x in toxicity.scored(df, none).collect()] == [(0.5, 0)] * 2
    assert toxicity.scored(df.limit(0), none).count() == 0


def test_training_holds_little_beside_its_examples():
    import tracemalloc

    rng = np.random.default_rng(5)
    examples = [(np.unique(rng.integers(0, 1 << 63, 600).astype(np.uint64) * np.uint64(2)), k % 2) for k in range(2000)]
    tracemalloc.start()
    try:
        toxicity.ftrl(examples, 1, 2.0, 1.0, 20.0, 0.0, 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < sum(f.nbytes for f, _ in examples)


def test_ftrl_is_sparse():
    r = np.random.default_rng(1)
    noise = [np.unique(r.integers(0, 500, 30).astype(np.uint64)) for _ in range(400)]
    examples = [(np.append(x, np.uint64(1000)) if i % 4 == 0 else x, int(i % 4 == 0)) for i, x in enumerate(noise)]
    names, weights, bias = toxicity.ftrl(examples, 8, 2.0, 1.0, 20.0, 0.0, 5)
    assert 1000 in names and weights[list(names).index(1000)] > 1 and len(names) < 50 and bias < 0


@pytest.mark.parametrize("refit", [False, True])
@pytest.mark.parametrize("l1", [0.0, 0.7, 3.0, 500.0])
def test_ftrl_equals_a_plain_one(l1, refit):
    r = np.random.default_rng(3)
    examples = [(np.unique(r.integers(0, 60, r.integers(0, 25)).astype(np.uint64)), int(r.random() < 0.3)) for _ in range(150)]
    examples = [(np.append(x, np.uint64(99)) if y else x, y) for x, y in examples]
    names, weights, bias = toxicity.ftrl(examples, 4, 1.5, 0.8, l1, 0.1, 3, refit)
    found, plain_bias = plain_ftrl([(x.tolist(), y) for x, y in examples], 4, 1.5, 0.8, l1, 0.1, 3, refit)
    assert dict(zip(names.tolist(), weights.tolist())) == pytest.approx(found, abs=1e-9) and bias == pytest.approx(plain_bias, abs=1e-9)
    assert bool(found) == (l1 < 500)


def test_held_out_recall_on_given_rows(spark):
    """What the labels of sf0.1 give: most toxic documents, hardly a clean one."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.scored(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] >= 0.75 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.005 * n[0, 0]


# ------------------------------------------------------------------ personal data


def test_pii_equals_brute_force(spark):
    r = random.Random(2)
    bits = list("a.@+-%_ 0123456789()é\n") + ["@b.co ", "1.2.3.4", "4111 1111 1111 1111", " +49 170 1234567 ", " contact John at ", " Zürich "]
    docs = [(i, "".join(r.choices(bits, k=r.randint(0, 40)))) for i in range(500)]
    docs += [(1000 + i, f"Mail alice.smith@corp.example.org about Projekt Falken today, or call {i}") for i in range(30)]
    docs += [(2000 + i, "Projekt plans and today's news") for i in range(20)]
    docs += [(3, None), (None, "x@y.zz secret x@y.zz"), (-1, "a@b.co " * 3000), (-2, "1" * 30000 + "@" * 5 + "a" * 30000), (-3, "😀 a@b.cc 😀 10.0.0.1 " * 70)]
    docs += [docs[7], docs[7]]
    df = frame(spark, docs)
    got, want = rows(pii.digest(pii.detect(df))), plain_pii(docs)
    assert got == want
    assert any("generalised" in x[6] for x in want) and any("removed" in x[6] for x in want)
    clean = pii.sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(docs)
    text = clean.where("doc_id = 1000").first().text
    assert "[EMAIL]" in text and "alice" not in text and "Falken" not in text
    assert pii.sanitise(df.limit(0)).count() == 0 and pii.digest(pii.detect(df.limit(0))).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pii_equals_brute_force_on_random_texts(spark, seed):
    """Far repeats, several matches in a window, words at its edges, long texts."""
    r = random.Random(seed)
    names = ["Über", "stone", "river", "Lerche"]
    things = ["4111 1111 1111 1111", "5500-0000-0000-0004", "a@x.co", "b@y.org", "1.2.3.4", "300.1.1.1", "+49 (30) 123-4567", "2024", "17"]
    common = ["the", "of", "x", "in", "it is", "and"]
    unique = ["Falken", "Amsel", "Zander", "Kranich", "Drossel", "Sperber", "Wiesel", "Marder", "Dachs"]
    own = {t: (u, r.choice(["stone", "river"])) for t, u in zip(things, unique)}  # one of its own, one of several

    def text():
        parts = []
        for _ in range(r.randrange(0, 9)):
            t = r.choice(things)
            gap = " ".join(r.choices(common, k=r.choice([0, 1, 2, 20, 25, 60])))
            parts += [r.choice([*[own[t][0]] * 4, r.choice(names)]), r.choice(["", " ", ", ", "."]), t, r.choice([" ", ": ", ""]), r.choice([own[t][1], "it"]), " ", gap, " "]
        if r.random() < 0.2:
            parts += [" ".join(r.choices(common, k=600)), " ", r.choice(unique).upper(), "'s ", r.choice(names)]
        return "".join(parts)

    docs = [(i, text()) for i in range(90)] + [(200 + i, " ".join(r.choices(common + names[1:3], k=12))) for i in range(60)] + [(7, docs_text()) for docs_text in (text, text)]
    docs += [(None, text()), (400, None), (401, "")]
    got, want = rows(pii.digest(pii.detect(frame(spark, docs)))), plain_pii(docs)
    assert got == sorted(want, key=repr)
    spans = "".join(x[-1] for x in want)
    assert "removed" in spans and "generalised" in spans


# ------------------------------------------------------------------ tokens


def library(path):
    """Ids of a text by a tokenizer of its own, as the library gives them."""
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name,drops_space", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_pieces_encode_as_the_whole_text(name, drops_space):
    r = random.Random(4)
    bits = list("ab1 \n\t'’.,<|>é́\x85\xa0 　\x1c\x1dΣς한ᄒ가 's't'll\r\x0b\x0c#ǅİßÅ²½ªʰ")
    bits += ["<|endoftext|>", " ", " ", "  ", "foo", "Bar,", "don't", "\x00", " \n", "​", "﻿", "᠎", "क़"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 30))) for _ in range(6000)]
    own, plain = PieceEncoder(vocabulary_path(name), drops_space, memory=2000), PieceEncoder(vocabulary_path(name), drops_space, specials=False)
    fresh = library(vocabulary_path(name))
    texts += ["<|endoftext|>", "a<|endoftext|>b", "<|EndOfText|> x", "<|endoftext|><|endoftext|>", "<|endoftext"]
    for lo in range(0, len(texts), 300):
        part = texts[lo : lo + 300]
        assert own.ids([t.encode() for t in part]) == [np.array(fresh(t), "<u4").tobytes() for t in part]
        assert plain.ids([t.encode() for t in part]) == [np.array(i, "<u4").tobytes() for i in plain._encode(part)]
    assert len(fresh("<|endoftext|>")) == 1 and len(plain._encode(["<|endoftext|>"])[0]) > 1


def test_cuts_of_many_texts():
    white = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    cut = re.compile(f" ?[^{white[1:]}+|{white}+(?![^{white[1:]})|{white}+").findall
    r = random.Random(9)
    bits = re.findall(white, "".join(map(chr, range(0x3001)))) + list("ab,é가\x1c\u200b\u2027\u2060\u3001\U0001f600 \u0085") + [" ", "  ", "\n", "word", " Word"] * 8
    texts = ["".join(r.choices(bits, k=r.randint(0, 9))) for _ in range(4000)]
    for name, drops_space, parts in (("byte_bpe_50k.json", False, cut), ("word_bpe_49k.json", True, lambda t: [p.decode() for p in t.encode().split()])):
        own = PieceEncoder(vocabulary_path(name), drops_space)
        for some in (texts, texts[:1], ["", "\n", "", "a", " "], [""], []):
            pieces, which, first = own._cut([t.encode() for t in some])
            got = [[pieces[k] for k in which[a:b]] for a, b in zip(first[:-1], first[1:])]
            assert got == [parts(t) for t in some] and len(set(pieces)) == len(pieces)
            assert len(own.ids([t.encode() for t in some])) == len(some)


class Counted(dict):
    """A dictionary that counts how often it is asked."""

    asked = 0

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __contains__(self, key):
        self.asked += 1
        return super().__contains__(key)


@pytest.mark.parametrize("name,drops_space", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_a_piece_is_looked_up_once_a_call_and_kept_while_it_is_met(name, drops_space):
    own, fresh = PieceEncoder(vocabulary_path(name), drops_space, memory=30), library(vocabulary_path(name))
    own.known = asked = Counted()
    text = " of the, words" * 20_000
    assert own.ids([text.encode()] * 3) == [np.array(fresh(text), "<u4").tobytes()] * 3
    assert asked.asked < 100
    new, encode = [], own._encode
    own._encode = lambda texts: new.extend(texts) or encode(texts)
    for k in range(40):  # new words fill the memory again and again
        own.ids([" of the, words {}".format(" ".join(a + chr(97 + k % 26) * (k + 1) for a in "abcdefghij")).encode()])
    assert len(own.known) <= 60 and len(own.older) <= 60
    assert "words" not in " ".join(new)


TEXTS = [(10**6, None), (10**6 + 1, ""), (-5, "a\x00b \x00 c\n\n d <|endoftext|>"), (4, "x  y\n z\t q 's"), (None, "null id"), (-5, "dup id"), (4, "x  y\n z\t q 's"),
         (11, "Long words repeat " * 3000)]


def test_records_round_trip(spark, tmp_path):
    path = vocabulary_path("word_bpe_49k.json")
    whole = library(path)
    df = frame(spark, TEXTS)
    manifest = records.write_records(df, f"file://{tmp_path}/r", path)
    got = records.read_records(manifest)
    start, want = 0, []
    for d, t in sorted(TEXTS, key=lambda d: (d[0] is not None, d[0] or 0, zlib.crc32((d[1] or "").encode()))):
        ids = whole(t or "") + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert rows(got) == sorted(want, key=repr)
    # any record by its index, and damage is noticed
    file = manifest.where("records > 1").first()
    one = list(records.read_range(file.file, file.records - 1, file.records))
    assert len(one) == 1 and len(records.unpack_ids(one[0])[1]) > 0
    raw = bytearray(records.frame(one[0]))
    raw[len(raw) // 2] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(raw))
    wide = records.pack_ids(None, np.array([70000, 2], "<u4").tobytes())
    assert records.unpack_ids(wide)[0] is None and records.unpack_ids(wide)[1].tolist() == [70000, 2]


def test_records_of_nothing(spark):
    assert records.round_trip(spark, frame(spark, TEXTS).limit(0), vocabulary_path("word_bpe_49k.json")).count() == 0


def test_packing(spark, tmp_path):
    path = vocabulary_path("byte_bpe_50k.json")
    whole = library(path)
    packed = packing.pack(frame(spark, TEXTS), path)
    got = packed.collect()
    assert len({x.sequence_id for x in got}) == len(got)
    assert all(x.offset == 0 and x.length == x.bucket == len(x.ids) // 4 <= 1024 and x.length & (x.length - 1) == 0 for x in got)
    want = sorted(((d, i) for d, t in TEXTS for i in whole(t or "") + [0]), key=repr)
    assert sorted(((x.doc_id, i) for x in got for i in np.frombuffer(x.ids, "<u4").tolist()), key=repr) == want
    long = sorted((x for x in got if x.doc_id == 11), key=lambda x: x.start)
    assert [i for x in long for i in np.frombuffer(x.ids, "<u4").tolist()] == whole(TEXTS[7][1]) + [0]
    assert [x.start for x in long] == [sum(y.length for y in long[:k]) for k in range(len(long))]
    packing.write_buckets(packed, f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/b").count() == len(got)
    assert packing.pack(frame(spark, TEXTS).limit(0), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame(spark, TEXTS), path, max_length=1000)


# ------------------------------------------------------------------ chat


def test_chat_round_trip(spark):
    r = random.Random(6)
    bits = ["\\", "#", "### user: ", "</turn>", "</turn>\n", "<\\/turn>", ":", "\n", "a", "é😀", " "]
    text = lambda: "".join(r.choices(bits, k=r.randint(0, 12)))
    turns = [(c, t, r.choice(["user", "assistant", "system", "a:b\\", "", "x\n### y: "]), text()) for c in range(60) for t in range(r.randint(1, 5))]
    turns += [(100, 0, None, None), (100, None, "assistant", "first"), (None, 1, "user", "x"), (None, 2, "assistant", "y"), (101, 1, "assistant", "b"),
              (101, 1, "assistant", "a"), (101, 1, "assistant", "a")]
    turns += [(102, i, "assistant", "é" * 50) for i in range(2000)]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, t string, id long").repartition(3)
    formatted = chat.format_turns(chat.canonical(df))
    want = {}
    for c, t, role, x in sorted(turns, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", x or ""))
    back = {x.conv_id: ([tuple(t) for t in x.turns], x.loss_text) for x in chat.read_turns(formatted).collect()}
    assert back == {c: (ts, "".join(x for role, x in ts if role == "assistant")) for c, ts in want.items()}
    digest = {x.conv_id: x for x in chat.digest(formatted).collect()}
    said = "".join(f"{role}\n{x}\n" for role, x in want[100])
    assert digest[100].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and digest[102].loss_chars == 100000
    assert chat.canonical(df.limit(0)).count() == 0


def test_layouts(spark):
    table = spark.sql(
        "SELECT 1L AS conv_id, array(named_struct('from', 'human', 'value', 'q'), named_struct('from', 'gpt', 'value', NULL)) AS conversations, 'x' AS content"
    )
    assert chat.canonical(table).first().turns == [("user", "q"), ("assistant", "")]
    alpaca = spark.sql("SELECT 1L AS conv_id, 'do' AS instruction, 'this' AS input, 'done' AS output, 5 AS score")
    assert chat.canonical(alpaca).first().turns == [("user", "do\n\nthis"), ("assistant", "done")]
    with pytest.raises(ValueError):
        chat.canonical(spark.sql("SELECT 1L AS conv_id, 'x' AS nothing"))
    records_ = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], "id": 5}, {"prompt": "p", "response": "r"},
        {"question": "q", "answer": "a"}, {"instruction": "i", "output": "o"}, {"prompt": "p", "completion": "c"}, {"foo": 1}, {"prompt": "p"},
    ]
    raw = [(i, json.dumps(x)) for i, x in enumerate(records_)] + [(7, "{bad"), (8, None)]
    got = {x.conv_id: (x.layout, x.turns) for x in chat.canonical_json(spark.createDataFrame(raw, "conv_id long, record string")).collect()}
    assert [got[i][0] for i in range(9)] == ["messages", "prompt", "question", "instruction", "completion", None, None, None, None]
    assert got[0][1] == [("user", "hi"), ("assistant", "yo")] and got[3][1] == [("user", "i"), ("assistant", "o")] and got[5][1] is None


def test_no_text_of_a_layout_is_lost(spark):
    system = spark.sql("SELECT 1L AS conv_id, 's' AS system, 'p' AS prompt, 'r' AS response, 'z' AS other")
    assert chat.canonical(system).first().turns == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert chat.unmapped_fields(system) == ["conv_id", "other"]
    history = "SELECT 1L AS conv_id, {0} AS history, {1} AS system, 'i' AS instruction, '' AS input, 'o' AS output"
    got = [chat.canonical(spark.sql(history.format(h, s))).first().turns for h, s in (("array(array('q', 'a'))", "'s'"), ("CAST(NULL AS array<array<string>>)", "''"))]
    assert got[0] == [("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "i"), ("assistant", "o")] and got[1] == [("user", "i"), ("assistant", "o")]
    with pytest.raises(ValueError):  # two layouts at once
        chat.canonical(spark.sql("SELECT 1L AS conv_id, 'p' AS prompt, 'r' AS response, 'q' AS question"))
    records_ = [
        {"system": "s", "prompt": "p", "response": "r"},
        {"messages": [{"role": "user", "content": "a"}, {"from": "gpt", "value": "b"}, {"role": "tool", "content": None, "name": "t"}], "lang": "en"},
        {"system": "s", "instruction": "i", "output": "o", "history": [["q", "a"], ["q2", "a2"]]},
        {"messages": [{"content": "no role"}, {"role": "user", "content": "x"}]},
        {"conversations": [{"from": "human", "value": "x"}], "system": "s"},
        {"prompt": "p", "response": "r", "question": "q"},
        {"prompt": "p", "response": {"text": "r"}},
        {"messages": [{"role": "user", "content": "a"}], "prompt": "p"},
        {"messages": []}, {"prompt": None, "response": "r"}, {"messages": [{"role": "user", "content": "x"}, "stray"]}, [1], {"prompt": "p", "response": "r", "history": "odd"},
    ]
    raw = [(i, json.dumps(x)) for i, x in enumerate(records_)]
    got = {x.conv_id: (x.layout, [tuple(t) for t in x.turns] if x.turns is not None else None, x.unmapped) for x in chat.canonical_json(spark.createDataFrame(raw, "conv_id long, record string")).collect()}
    assert got[0] == ("prompt with system", [("system", "s"), ("user", "p"), ("assistant", "r")], [])
    assert got[1] == ("messages", [("user", "a"), ("assistant", "b"), ("tool", "")], ["lang", "messages[].name"])
    assert got[2] == ("instruction with system and history", [("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "q2"), ("assistant", "a2"), ("user", "i"), ("assistant", "o")], [])
    assert got[3] == (None, None, ["messages"]) and got[4] == ("conversations with system", [("system", "s"), ("user", "x")], [])
    assert got[5] == (None, None, ["prompt", "question", "response"]) and got[6] == ("prompt", [("user", "p"), ("assistant", '{"text":"r"}')], [])
    assert got[7] == (None, None, ["messages", "prompt"]) and got[8] == ("messages", [], []) and got[9][1] == [("user", ""), ("assistant", "r")]
    assert got[10][0] is None and got[11] == (None, None, []) and got[12] == (None, None, ["history", "prompt", "response"])
