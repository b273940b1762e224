"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of
``max_length`` as fit, then one piece for each bit of what is left, the longest
first. Every piece is a sequence of its own in the bucket of its length, so no
sequence crosses documents, none is padded, and a batch drawn from one bucket is
rectangular.

Defined cases: null and empty texts are the end id alone (one piece of one id);
repeated rows and rows with a null id are packed like any other, each into its
own sequences; an empty table gives no sequences; other input columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8
from .tokens import encoder

SLICE = 2 << 20


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Powers of two that add up to ``n``, longest first, none over ``max_length``."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = 1024, end_id: int = 0, drops_space: bool = False
) -> DataFrame:
    """One row per sequence: sequence_id, bucket (its length), id_col, start, length, offset, doc_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit numbers. ``start`` counts the
    document's ids before the piece; ``offset`` is its place in the sequence,
    always 0. ``sequence_id`` is unique and grows within a partition.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def run(batches):
        known, end = encoder(vocabulary, drops_space), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            for lo, hi in slices(offs, SLICE):
                raw = buf[offs[lo] : offs[hi]].tobytes()
                ends = (offs[lo : hi + 1] - offs[lo]).tolist()
                rows, starts, lengths, totals, ids = [], [], [], [], []
                for k, doc in enumerate(known.ids([raw[a:b] for a, b in zip(ends[:-1], ends[1:])])):
                    doc += end
                    n = len(doc) // 4
                    at = 0
                    for size in piece_lengths(n, max_length):
                        rows.append(lo + k)
                        starts.append(at)
                        lengths.append(size)
                        totals.append(n)
                        ids.append(doc[at * 4 : (at + size) * 4])
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, totals)), pa.array(ids, pa.binary())],
                    names=["doc", "start", "length", "doc_tokens", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    pieces = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc {kind}, start long, length long, doc_tokens long, ids binary"
    )
    return pieces.select(
        F.monotonically_increasing_id().alias("sequence_id"), F.col("length").alias("bucket"), F.col("doc").alias(id_col),
        "start", "length", F.lit(0).cast("long").alias("offset"), "doc_tokens", "ids",
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences with one folder for each length."""
    packed.write.partitionBy("bucket").parquet(path)


def digest(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The sequences with a checksum in place of their ids."""
    return packed.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
