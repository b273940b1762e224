"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words (runs of letters, digits and
non-ASCII characters, A-Z folded), its word pairs, and its pairs with one word
left out between, hashed to 64 bits with the kind in the hash. No feature space
is laid out: the trainer keeps per-coordinate state only for hashes of its
sample, and the L1 term leaves few weights other than zero, which is what every
scoring task gets.

The sample is bounded: at most ``sample_rows`` labelled documents (least hash of
the id) and, of these, as many as ``sample_features`` distinct features in all
allow. Scoring reads every whole text.

Defined cases: null and empty texts have no features and score by the bias; a
null label or id isn't trained on, and an id with several labels counts as toxic
if any is 1; without a usable sample (an empty table, no labels) every score is
0.5; repeated rows are scored alike; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, Words, mix, setting, slices, utf8

SLICE = 256 << 10  # bytes of text at a time: what is made of them takes some forty times as much

_KEEP = np.zeros(256, bool)
_KEEP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32

#: Marks of the feature kinds: pair, pair over one word.
_PAIR, _SKIP = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every feature occurrence."""
    words = Words(buf, offs, _KEEP, _FOLD)
    rows, hashes = [words.row], [words.hash]
    for gap, mark in ((1, _PAIR), (2, _SKIP)):
        if len(words.hash) > gap:
            same = words.row[gap:] == words.row[:-gap]
            rows.append(words.row[:-gap][same])
            hashes.append(mix(words.hash[:-gap][same] * mark + words.hash[gap:][same]))
    return np.concatenate(rows), np.concatenate(hashes)


def _feature_lists(rows: DataFrame) -> DataFrame:
    """(key, label, features) with each row's distinct features as little-endian 64-bit numbers."""

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(2))
            for lo, hi in slices(offs, SLICE):
                row, h = _features(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(hi - lo + 1))
                h = h[order]
                lists = [np.unique(h[a:b]).tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(lists, pa.binary())],
                    names=["key", "label", "features"],
                )

    return rows.mapInArrow(run, "key long, label int, features binary")


def _passes(
    places: list[np.ndarray], labels: list[int], size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float
) -> np.ndarray:
    """Weights of ``size`` coordinates and the bias (the last one, without L1) after FTRL-proximal passes.

    Every coordinate has a rate of its own: z collects gradients less the pull
    of the weight, n their squares; a weight is zero while |z| <= l1.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = np.full(size + 1, l1)
    penalty[-1] = 0.0

    def weights(at):
        pull = np.abs(z[at]) - penalty[at]
        return np.where(pull > 0, -np.sign(z[at]) * pull / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for at, label in zip(places, labels):
            at = np.append(at, size)
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def _common(lists: list[np.ndarray], least: int) -> np.ndarray:
    """The numbers that ``least`` of the lists hold, in order; each list has a number once."""
    every = np.concatenate([*lists, np.zeros(0, np.uint64)])
    every.sort()
    last = len(every) - max(least, 1) + 1
    return np.unique(every[:last][every[:last] == every[len(every) - last :]]) if last > 0 else every[:0]


def ftrl(
    examples: list[tuple[np.ndarray, int]],
    epochs: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
    min_rows: int,
    refit: bool = True,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights other than zero after ``epochs`` passes over (distinct features, label) examples.

    L1 chooses the features and, as it must, shrinks their weights, the more the
    fewer examples there are; with ``refit`` as many passes without L1 over the
    chosen features alone give these their full weights. Features of fewer than
    ``min_rows`` examples are left out.
    """
    names = np.concatenate([_common([f[f >> np.uint64(61) == part] for f, _ in examples], min_rows) for part in range(8)])
    places, labels = [], [label for _, label in examples]
    for f, _ in examples:
        at = np.searchsorted(names, f)
        at = at[at < len(names)] if len(names) else at[:0]
        places.append(at[np.isin(names[at], f)].astype(np.int32))
    w = _passes(places, labels, len(names), epochs, alpha, beta, l1, l2)
    some = np.flatnonzero(w[:-1])
    if refit and len(some):
        number = np.full(len(names), -1)
        number[some] = np.arange(len(some))
        chosen = [number[at][number[at] >= 0] for at in places]
        w = _passes(chosen, labels, len(some), epochs, alpha, beta, 0.0, l2)
        names, some = names[some], np.flatnonzero(w[:-1])
    return names[some], w[some], float(w[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 16_384,
    sample_features: int = 12_000_000,
    epochs: int = 8,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 20.0,
    l2: float = 0.0,
    min_rows: int = 5,
) -> Model:
    """Fit on a bounded sample of the labelled rows (see the module's text)."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    sample = (
        marked.agg(F.max(label_col).cast("int").alias("label"))
        .withColumn("key", F.xxhash64("id"))
        .orderBy("key", "id")
        .limit(sample_rows)
    )
    # at most sample_rows ids; of rows that share an id one is trained on
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    lists = _feature_lists(texts.select("key", "label", "text").dropDuplicates(["key"]))

    def fit(batches):
        examples, room = [], sample_features
        for batch in batches:
            for label, raw in zip(batch.column(1).to_pylist(), batch.column(2)):
                found = np.frombuffer(raw.as_buffer(), "<u8").copy()
                if len(found) <= room:
                    examples.append((found, label))
                    room -= len(found)
        names, weights, bias = ftrl(examples, epochs, alpha, beta, l1, l2, min_rows) if len({x for _, x in examples}) == 2 else _NOTHING
        yield pa.RecordBatch.from_pydict(
            {"features": [names.astype("<u8").tobytes()], "weights": [weights.astype("<f8").tobytes()], "bias": [bias]}
        )

    # the bounded sample in one task, in the order of its keys, few rows at a time
    with setting(docs.sparkSession, BATCH_ROWS, "512"):
        rows = lists.repartition(1).sortWithinPartitions("key").mapInArrow(fit, "features binary, weights binary, bias double").collect()
    if not rows:
        return Model(*_NOTHING)
    return Model(np.frombuffer(rows[0].features, "<u8"), np.frombuffer(rows[0].weights, "<f8"), rows[0].bias)


_NOTHING = (np.zeros(0, np.uint64), np.zeros(0), 0.0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """(id_col, score_col) for every row: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(id_col, _scorer(shared)(F.col(text_col)).alias(score_col))


def _scorer(shared):
    @F.arrow_udf("double")
    def toxic(texts: pa.Array) -> pa.Array:
        model, out = shared.value, []
        if not len(model.features):
            return pa.array(np.full(len(texts), 1 / (1 + np.exp(-model.bias))))
        buf, offs = utf8(texts)
        for lo, hi in slices(offs, SLICE):
            row, h = _features(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
            at = np.minimum(np.searchsorted(model.features, h), len(model.features) - 1)
            hit = model.features[at] == h
            # each feature once in a row
            pairs = np.unique(row[hit] * len(model.features) + at[hit])
            total = np.bincount(pairs // len(model.features), model.weights[pairs % len(model.features)], minlength=hi - lo)
            out.append(1 / (1 + np.exp(-np.clip(total + model.bias, -35, 35))))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return toxic


def held_out(id_col: str = "doc_id"):
    """True for the third of ids that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_outside(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """``train`` on the labels whose id isn't held out."""
    return train(docs, labels.where(~held_out()), **options)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = train_outside(docs, labels, **options)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    model = train_outside(docs, labels, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.where(_scorer(shared)(F.col("text")) < threshold)
