"""Helpers the operators share: tables, written intermediates, and words of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, name: str, value: str, default: str | None = None):
    """``name`` is ``value`` inside; after it what it was, or ``default`` where it wasn't set."""
    old = spark.conf.get(name, default) if default is not None else spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _shuffle_cleanup(spark: SparkSession):
    return setting(spark, CLEANUP, "true", "false")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files every executor can read, gives the next plan
    true sizes to choose its joins by, and lets Spark drop the shuffle files of
    the part that is done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores before them that no column of ``df`` is called so, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    mark = "__"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets into them (null: empty)."""
    col = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (a longer single row is a range of its own)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


#: Multipliers of the word and window hashes (odd 64-bit numbers).
_P, _Q1, _Q2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~SPACE


class Words:
    """Words of several rows at once: byte ranges, row, place in the row and a 64-bit hash.

    ``keep`` says which bytes belong to words, ``fold`` maps bytes before hashing.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, keep: np.ndarray = WORD, fold: np.ndarray | None = None):
        n = len(buf)
        inside = keep[buf]
        first = np.zeros(n + 1, bool)
        first[offsets] = True  # words never cross rows
        before = np.concatenate(([False], inside))
        here = np.concatenate((inside, [False]))
        self.start = np.flatnonzero(here & (~before | first))
        self.end = np.flatnonzero(before & (~here | first))
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        rows = len(offsets) - 1
        self.count = np.bincount(self.row, minlength=rows) if len(self.row) else np.zeros(rows, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.place = np.arange(len(self.start)) - self.first[self.row]
        letters = (buf if fold is None else fold[buf]).astype(np.uint64) + np.uint64(1)
        # polynomial of the bytes of a word, its first byte times 1
        length = self.end - self.start
        within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(self.start, length) + within
        power = _powers(_P, int(length.max()) if len(length) else 0)
        sums = np.add.reduceat(letters[at] * power[within], np.cumsum(length) - length) if len(length) else np.zeros(0, np.uint64)
        self.hash = mix(sums ^ (length.astype(np.uint64) << np.uint64(48)))

    def windows(self, size: int, second: bool = False) -> np.ndarray:
        """Hash of the ``size`` words from each word on; only where ``whole(size)`` holds."""
        base = _Q2 if second else _Q1
        n, out, power = len(self.hash), np.zeros(len(self.hash), np.uint64), np.uint64(1)
        word = mix(self.hash + base) if second else self.hash
        for j in range(size):
            if n > j:
                out[: n - j] += word[j:] * power
            power = np.multiply(power, base)
        return mix(out)

    def whole(self, size: int) -> np.ndarray:
        """True where ``size`` words of one row start."""
        return self.place + size <= self.count[self.row]


def spread(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean array of length ``n``, true in any of the ranges [start, end)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d)[:n] > 0
