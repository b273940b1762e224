"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are read in tasks as bytes. One prefix polynomial over the words of a
block (joined by single spaces) gives every n-gram's fingerprint by a
subtraction and a multiplication, whatever its length. Counting goes by levels:
fingerprints of n words are counted, summed in each task first, where both
(n-1)-grams inside may be frequent. What may be frequent is told by a bitmap of
the level before, of 16 bits a frequent fingerprint up to a bound; a false hit
costs a shuffled row and nothing else, so the bound changes no result.

Fingerprints only choose. A last pass points back to the texts: occurrences
whose fingerprint may be frequent are materialised as text and counted by text,
in each block first, so two phrases that share a fingerprint are told apart, and
no infrequent phrase is ever written or shuffled as text but by a bitmap's false
hit. Every phrase carries a pointer, the smallest id of a document that holds it.

Scores follow natively from exact counts, in decimals, as products may pass 64
bits.

Defined cases: null and empty texts hold no words; a null language is ``und``;
repeated rows count as often as they occur; rows with a null id count but aren't
pointed to; an empty table gives an empty result; other input columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, slices, utf8

SLICE = 1 << 20
LONGEST = 4
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_KEEP = ~_CUT
_KEEP[[0x20, 0x09]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


class _Powers:
    """Powers of a base modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.held = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.held) < n:
            p = np.full(max(n, 2 * len(self.held)), self.base, np.uint64)
            p[0] = 1
            self.held = np.multiply.accumulate(p)
        return self.held[:n]


class Block:
    """Words of several texts, joined by spaces, with their prefix polynomial."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, up: _Powers, down: _Powers):
        first = np.zeros(len(buf) + 1, bool)
        first[offsets] = True  # words never cross texts
        inside = _KEEP[buf]
        before, here = np.concatenate(([False], inside)), np.concatenate((inside, [False]))
        start, end = np.flatnonzero(here & (~before | first)), np.flatnonzero(before & (~here | first))
        self.row = np.searchsorted(offsets, start, "right") - 1
        cuts = np.concatenate(([0], np.cumsum(_CUT[buf])))[start]
        new = np.ones(len(start), bool)
        new[1:] = (cuts[1:] != cuts[:-1]) | (self.row[1:] != self.row[:-1])
        self.piece = np.cumsum(new)
        # the words' bytes, each word followed by a space
        length = end - start + 1
        self.stop = np.cumsum(length)
        self.start = self.stop - length
        total = int(self.stop[-1]) if len(length) else 0
        self.bytes = np.full(total, 0x20, np.uint8)
        at = np.arange(total)
        inner = np.ones(total, bool)
        inner[self.stop - 1] = False
        self.bytes[inner] = _FOLD[buf[(at + np.repeat(start - self.start, length))[inner]]]
        self.sums = np.zeros(total + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up.upto(total), out=self.sums[1:])
        self.down = down.upto(total + 1)
        self.seeds = seeds

    def grams(self, n: int, maps: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(first words, fingerprints) of the n-grams within pieces whose (n-1)-grams may be frequent."""
        at = np.arange(max(0, len(self.start) - n + 1))
        if n > 1:
            at = at[self.piece[at] == self.piece[at + n - 1]]
            if n - 1 in maps:
                ok = np.zeros(len(self.start) + 1, bool)
                some, prints = self.grams(n - 1, {})
                ok[some] = may_hold(maps[n - 1], prints)
                at = at[ok[at] & ok[at + 1]]
        a, b = self.start[at], self.stop[at + n - 1] - 1
        return at, mix((self.sums[b] - self.sums[a]) * self.down[a] + self.seeds[self.row[at]])

    def texts(self, at: np.ndarray, n: int) -> pa.Array:
        """The n-grams that start at the words ``at``, as strings."""
        a, b = self.start[at], self.stop[at + n - 1] - 1
        length = b - a
        ends = np.concatenate(([0], np.cumsum(length)))
        data = self.bytes[np.arange(int(ends[-1])) + np.repeat(a - ends[:-1], length)]
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])


def may_hold(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """True where the bitmap has the fingerprint's bit (its top bits name it)."""
    bits = len(bitmap) * 8
    place = (prints >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _blocks(batches) -> Iterator[tuple[Block, np.ndarray, pa.Array, pa.Array]]:
    """(block, language number of each of its rows, languages, ids) of (id, lang, text) batches."""
    up, down = _Powers(BASE), _Powers(INVERSE)
    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in langs.dictionary.to_pylist()], np.uint64)
        code = langs.indices.to_numpy()
        buf, offs = utf8(batch.column(2))
        for lo, hi in slices(offs, SLICE):
            mine = code[lo:hi]
            block = Block(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], seeds[mine], up, down)
            if len(block.start):
                yield block, mine, langs.dictionary, batch.column(0).slice(lo, hi - lo)


def _counts(docs: DataFrame, n: int, maps) -> DataFrame:
    """(print, n): how often each n-gram's fingerprint occurs, summed in each block.

    The language is in the fingerprint.
    """

    def run(batches):
        held = {k: v.value for k, v in maps.items()}
        for block, _, _, _ in _blocks(batches):
            found, count = np.unique(block.grams(n, held)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], names=["print", "n"])

    return docs.mapInArrow(run, "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))


def _bitmap(frequent: DataFrame, most_bits: int, part_bits: int = 1 << 19) -> np.ndarray:
    """The fingerprints' bits: about 16 bits for each, at most ``most_bits`` in all."""
    bits = 1 << 16
    size = frequent.count()
    while bits < 16 * size and bits < most_bits:
        bits *= 2
    shift, part = 64 - bits.bit_length() + 1, min(bits, part_bits)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column(0).to_numpy()
            for k in np.unique(place // part).tolist():
                mine = place[place // part == k] % part
                np.bitwise_or.at(held.setdefault(k, np.zeros(part // 8, np.uint8)), mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        for k, raw in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([raw.tobytes()], pa.binary())], names=["k", "raw"])

    place = frequent.select(F.shiftrightunsigned("print", shift).alias("place"))
    out = np.zeros(bits // 8, np.uint8)
    # each task ORs its rows into parts of 64 KB; all parts together are the bitmap
    for row in place.repartition(F.floor(F.col("place") / part)).mapInArrow(run, "k long, raw binary").collect():
        at = row.k * part // 8
        out[at : at + part // 8] |= np.frombuffer(row.raw, np.uint8)
    return out


def _verified(docs: DataFrame, maps) -> DataFrame:
    """(lang, size, phrase, f, first_doc) by text of what may be frequent, summed in each block.

    Rows of size 0 hold the number of all words.
    """

    def run(batches):
        held = {k: v.value for k, v in maps.items()}
        names_of_all = ["lang", "size", "phrase", "f", "first_doc"]
        for block, code, names, ids in _blocks(batches):
            lang, words = np.unique(code[block.row], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(lang)).cast(pa.string()), pa.array(np.zeros(len(lang), np.int32)),
                    pa.array([""] * len(lang), pa.string()), pa.array(words), pa.nulls(len(lang), pa.int64()),
                ],
                names=names_of_all,
            )
            for n in held:
                at, prints = block.grams(n, held)
                at = at[may_hold(held[n], prints)]
                if not len(at):
                    continue
                row = block.row[at]
                found = pa.table({"lang": pa.array(code[row]), "phrase": block.texts(at, n), "doc": ids.take(pa.array(row))})
                sums = found.group_by(["lang", "phrase"]).aggregate([([], "count_all"), ("doc", "min")]).combine_chunks()
                for out in sums.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(out.column("lang")).cast(pa.string()), pa.array(np.full(out.num_rows, n, np.int32)),
                            out.column("phrase").cast(pa.string()), out.column("count_all").cast(pa.int64()), out.column("doc_min"),
                        ],
                        names=names_of_all,
                    )

    parts = docs.mapInArrow(run, "lang string, size int, phrase string, f long, first_doc long")
    return parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"), F.min("first_doc").alias("first_doc"))


def frequent_phrases(
    docs: DataFrame, least: int = 30, most_bits: int = 1 << 28,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, f, first_doc) of 1 to 4 words with f >= least, (lang, n) of all words).

    ``most_bits`` bounds a level's bitmap (32 MB); beyond it more is shuffled,
    with the same result.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    maps = {}
    for n in range(1, LONGEST + 1):
        frequent = materialize(_counts(read, n, maps).where(F.col("n") >= least).select("print"), "prints")
        if frequent.isEmpty():
            break
        maps[n] = spark.sparkContext.broadcast(_bitmap(frequent, most_bits))
    found = materialize(_verified(read, maps).where((F.col("f") >= least) | (F.col("size") == 0)), "phrases")
    return found.where("size > 0"), found.where("size = 0").select("lang", F.col("f").alias("n"))


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, most_bits: int = 1 << 28,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to 4 words: (lang, rank, phrase, a, l, r, n, score, first_doc).

    Cutting a phrase after k words gives floor(2000000 * a / (l + r)); the
    lowest counts, the smallest k of equals. A phrase goes if a longer one
    holds it and has at least ``covered`` hundredths of its count.
    """
    known, totals = frequent_phrases(docs, least, most_bits, id_col, text_col, lang_col)
    words = F.split("phrase", " ")

    def big(c):
        return F.col(c).cast("decimal(20,0)")

    candidates = known.where("size >= 2").withColumn("w", words)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "k", F.col("f").alias("a"), "first_doc",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    part = known.select("lang", "phrase", "f")
    left = part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .withColumn("score", F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    )
    # at most three cuts of a phrase
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "first_doc")).alias("x")).select("lang", "phrase", "x.*")
    # phrases inside longer ones, with the largest count of those
    inner = candidates.where("size >= 3").select(
        "lang", "f",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size - 1), m -> "
                "transform(sequence(1, size - m + 1), i -> array_join(slice(w, i, m), ' '))))"
            )
        ).alias("phrase"),
    )
    over = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(over, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (big("longer") * 100 < big("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # one row a language
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc"
    )
