"""Checksums of a table by key bucket, to compare versions without reading what is equal.

Every bucket of keys has a row count and two sums of row hashes. Sums don't
depend on the order of rows or on how they are dealt out, and the buckets of
Spark's own bucketing are used, so a bucketed version has one bucket per file.
Buckets add up to ranges: where a range is equal its buckets aren't looked at.
Equal sums of two 64-bit hashes of key and content digest count as equal content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.equality import content_digest
from .diff import _kcols
from .schema import as_keys, content_fields

SUMS = "bucket int, rows long, x decimal(38,0), y decimal(38,0)"


def bucket_of(keys: Sequence[str], buckets: int):
    """The bucket of a row, as ``bucketBy`` deals keys out."""
    return F.pmod(F.hash(*_kcols(keys)), F.lit(buckets))


def bucket_sums(df: DataFrame, keys: str | Sequence[str], buckets: int) -> DataFrame:
    """``bucket, rows, x, y`` of every bucket that has rows; summed in each task before the shuffle."""
    ks = as_keys(keys)
    fields = content_fields(df, ks)
    content = content_digest(fields) if fields else F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).alias("m"))
    rows = df.select(bucket_of(ks, buckets).cast("int").alias("bucket"), *_kcols(ks), content.alias("_digest"))
    x = F.xxhash64(*_kcols(ks), F.col("_digest.x"), F.col("_digest.m"))
    y = F.xxhash64(F.col("_digest.m"), F.col("_digest.x"), *_kcols(ks), F.lit(1))
    return rows.groupBy("bucket").agg(
        F.count("*").alias("rows"), *[F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(n) for h, n in ((x, "x"), (y, "y"))]
    )


def range_sums(sums: DataFrame, fanout: int) -> DataFrame:
    """The sums of ``fanout`` buckets each: the parents' level."""
    parent = F.floor(F.col("bucket") / fanout).cast("int")
    return sums.groupBy(parent.alias("range")).agg(*[F.sum(c).alias(c) for c in ("rows", "x", "y")])


def _unequal(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    pair = [F.struct("rows", "x", "y").alias("_s"), name]
    j = a.select(*pair).join(b.select(*pair).withColumnRenamed("_s", "_t"), name, "full_outer")
    return j.where(~F.col("_s").eqNullSafe(F.col("_t"))).select(name)


def unequal_buckets(a: DataFrame, b: DataFrame, fanout: int = 64) -> list[int]:
    """The buckets whose sums differ, from the unequal ranges down. At most one number a bucket."""
    ranges = [r[0] for r in _unequal(range_sums(a, fanout), range_sums(b, fanout), "range").collect()]
    if not ranges:
        return []
    inside = F.floor(F.col("bucket") / fanout).isin(ranges)
    return sorted(r[0] for r in _unequal(a.where(inside), b.where(inside), "bucket").collect())
