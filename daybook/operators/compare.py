"""Compare two dumps.

One full outer join on the key over the common columns classifies every key
as REMOVED (only in A), ADDED (only in B), MODIFIED or UNCHANGED. The
summary is one aggregate over that join, so a compare costs one shuffle of
each side regardless of how many figures are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.equality import content_digest, same_content
from ..session import scratch_path
from .diff import _kcols, _paired
from .keys import require_valid_keys
from .schema import as_keys, common_columns, content_fields, require_columns

REMOVED, ADDED, MODIFIED, UNCHANGED = "REMOVED", "ADDED", "MODIFIED", "UNCHANGED"
CLASSES = (REMOVED, ADDED, MODIFIED, UNCHANGED)


def compare(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], strategy: str = "struct", validate: bool = True
) -> DataFrame:
    """``<keys>, change, a, b`` for every key of either dump.

    Content is compared over the columns both dumps share (B's order).
    ``a``/``b`` are the row structs of each side (null where absent).
    ``strategy="hash"`` joins ``(key, digest)`` only and returns ``a``/``b``
    as the digests: for counting, a fraction of the shuffle of whole rows.
    Keys must be non-null and unique in each dump; ``validate`` (default)
    checks that first in one key-only job (a duplicated key would otherwise
    pair all its copies in the join).
    """
    ks = as_keys(keys)
    require_columns(a, ks, "dump A")
    require_columns(b, ks, "dump B")
    if validate:
        require_valid_keys({"dump A": a, "dump B": b}, ks)
    common = common_columns(a, b)
    a, b = a.select(*[F.col(f"`{c}`") for c in common]), b.select(*[F.col(f"`{c}`") for c in common])
    fields = content_fields(b, ks, ignore=())
    if strategy == "struct":
        dtype = T.StructType(fields)
        j = _paired(a, b, ks, fields)
        same = same_content(F.col("_p"), F.col("_n"), dtype)
    elif strategy == "hash":
        pa = a.select(*_kcols(ks), content_digest(fields).alias("_p"))
        pb = b.select(*_kcols(ks), content_digest(fields).alias("_n"))
        j = pa.join(pb, on=ks, how="full_outer")
        same = F.col("_p") == F.col("_n")
    else:
        raise ValueError(f"strategy must be 'struct' or 'hash', not {strategy!r}")
    pa, pb = F.col("_p"), F.col("_n")
    change = (
        F.when(pb.isNull(), F.lit(REMOVED))
        .when(pa.isNull(), F.lit(ADDED))
        .when(same, F.lit(UNCHANGED))
        .otherwise(F.lit(MODIFIED))
    )
    return j.select(*_kcols(ks), change.alias("change"), pa.alias("a"), pb.alias("b"))


def compare_rows(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], change: str, validate: bool = True
) -> DataFrame:
    """Plain rows of one class: A's version for REMOVED, B's otherwise.

    REMOVED and ADDED are anti joins (J03): the other side shuffles its keys only.
    """
    ks = as_keys(keys)
    if change not in (REMOVED, ADDED):
        return compare(a, b, ks, validate=validate).filter(F.col("change") == change).select(*_kcols(ks), "b.*")
    require_columns(a, ks, "dump A")
    require_columns(b, ks, "dump B")
    if validate:
        require_valid_keys({"dump A": a, "dump B": b}, ks)
    rest = [c for c in common_columns(a, b) if c not in ks]
    mine, other = (a, b) if change == REMOVED else (b, a)
    rows = mine.select(*_kcols(ks), *[F.col(f"`{c}`") for c in rest])
    return rows.join(other.select(*_kcols(ks)), on=ks, how="left_anti")


def compare_summary(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], strategy: str = "hash", validate: bool = True
) -> DataFrame:
    """One row of counts, total changes and change rate (% of A).

    ``change_rate`` is null when A is empty; rounded to 2 decimals. Only
    counts are needed, so by default only ``(key, digest)`` is shuffled.
    """
    c = F.col("change")

    def n(cls: str):
        return F.count_if(c == cls).cast("bigint")

    return rates(compare(a, b, keys, strategy, validate).agg(*[n(cls).alias(cls.lower()) for cls in CLASSES]))


def rates(counts: DataFrame) -> DataFrame:
    """The summary row of the four class counts."""
    rows_a = F.col("removed") + F.col("modified") + F.col("unchanged")
    rows_b = F.col("added") + F.col("modified") + F.col("unchanged")
    total = F.col("removed") + F.col("added") + F.col("modified")
    rate = F.when(rows_a > 0, F.round(total.cast("double") * 100.0 / rows_a.cast("double"), 2))
    return counts.select(
        rows_a.alias("rows_a"),
        rows_b.alias("rows_b"),
        "removed",
        "added",
        "modified",
        "unchanged",
        total.alias("total_changes"),
        rate.alias("change_rate"),
    )


def compare_samples(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], n: int = 5, validate: bool = True
) -> DataFrame:
    """Up to ``n`` rows (smallest keys) of REMOVED, ADDED and MODIFIED.

    One join of ``(key, digest)``; of each class the ``n`` smallest keys
    (limited in every task before the shuffle); then these at most ``3 n``
    keys are looked up in the dumps, whose rows are never shuffled.
    """
    ks = as_keys(keys)
    return _sample_rows(a, b, ks, compare(a, b, ks, "hash", validate).select(*_kcols(ks), "change"), n)


def _sample_rows(a: DataFrame, b: DataFrame, ks: list[str], classes: DataFrame, n: int) -> DataFrame:
    """Rows of the ``n`` smallest keys of each changed class of ``classes`` (``<keys>, change``)."""
    order = Window.partitionBy("change").orderBy(*_kcols(ks))
    few = classes.filter(F.col("change") != UNCHANGED).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")
    common = [F.col(f"`{c}`") for c in common_columns(a, b)]
    rest = [F.col(f"`{c}`") for c in common_columns(a, b) if c not in ks]
    removed = F.col("change") == REMOVED
    parts = [
        side.select(*common).join(F.broadcast(few.filter(mine)), on=ks).select("change", *_kcols(ks), *rest)  # 3 n keys at most
        for side, mine in ((a, removed), (b, ~removed))
    ]
    return parts[0].unionByName(parts[1])


def compare_report(
    a: DataFrame, b: DataFrame, keys: str | Sequence[str], n: int = 5
) -> tuple[DataFrame, DataFrame]:
    """C02 and C03 together: ``(summary row, samples)`` from one join of the dumps.

    The changed keys are written to the shared folder while the classes are
    counted, so neither result joins the dumps again; keys are checked once.
    """
    ks = as_keys(keys)
    spark = a.sparkSession
    counted = Observation("classes")
    c = F.col("change")
    classes = compare(a, b, ks, "hash").select(*_kcols(ks), "change")
    path = scratch_path(spark, "compare")
    observed = classes.observe(counted, *[F.count_if(c == cls).cast("bigint").alias(cls.lower()) for cls in CLASSES])
    observed.filter(c != UNCHANGED).write.parquet(path)
    counts = {cls.lower(): int(counted.get[cls.lower()] or 0) for cls in CLASSES}
    row = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])
    changed = spark.read.schema(classes.schema).parquet(path)
    return rates(row), _sample_rows(a, b, ks, changed, n)
