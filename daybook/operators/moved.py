"""Rows that moved: removed under one key, added with the same content under another.

Removed and added rows of equal content are matched as multisets, the k-th with
the k-th in key order. Ranks come from a sort dealt out by (content, key) ranges,
so content that a third of all rows share is ranked by many tasks, and ranks are
joined one to one: there is no cross product within a content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.equality import content_hash
from ..session import scratch_path
from .compare import ADDED, MODIFIED, REMOVED, UNCHANGED, compare
from .diff import _kcols
from .keys import require_valid_keys
from .schema import as_keys, common_columns, content_fields

MOVED = "MOVED"


def _ranked(rows: DataFrame, ks: list[str], name: str) -> DataFrame:
    """``rows`` (``<keys>, _hash``) with ``_rank``: the row's number in key order among equal hashes."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "_hash", *_kcols(ks)).withColumn("_part", F.spark_partition_id())
    path = scratch_path(spark, name)  # written once: the ranges come from a sample
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    # a hash has few rows here: one a range it lies in
    counts = dealt.groupBy("_hash", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("_hash", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # a range's rows of a hash are no more than the range has
    local = F.row_number().over(Window.partitionBy("_hash", "_part").orderBy(*_kcols(ks)))
    return dealt.withColumn("_local", local).join(offset, ["_hash", "_part"]).select(
        *_kcols(ks), "_hash", (F.col("_offset") + F.col("_local")).alias("_rank")
    )


def compare_moved(a: DataFrame, b: DataFrame, keys: str | Sequence[str], validate: bool = True) -> DataFrame:
    """``<keys>, change, to``: every key of either dump, with MOVED for matched pairs.

    A MOVED row has A's key and, in ``to``, a struct of B's; the REMOVED and the
    ADDED row it stands for aren't listed any more. ``to`` is null for all other
    classes. Content is compared over the columns both dumps share, as SHA-256
    of its canonical JSON. A table without content columns has no moves.
    """
    names = as_keys(keys)
    if {"change", "to"} & set(names):
        raise ValueError("no key column may be called change or to")
    if validate:
        require_valid_keys({"dump A": a, "dump B": b}, names)
    # the keys under names that meet no content column's
    mark = "_"
    while any(c.startswith(mark) for c in (*a.columns, *b.columns)):
        mark += "_"
    ks = [f"{mark}key{i}" for i in range(len(names))]
    a, b = (df.withColumnsRenamed(dict(zip(names, ks))) for df in (a, b))
    spark = a.sparkSession
    common = common_columns(a, b)
    fields = content_fields(b.select(*[F.col(f"`{c}`") for c in common]), ks, ignore=())
    if not fields:  # keys alone: every common row is equal
        a, b = (df.select(*_kcols(ks), F.lit(0).alias("only")) for df in (a, b))
    classes = compare(a, b, ks, strategy="hash", validate=False).select(*_kcols(ks), "change")
    path = scratch_path(spark, "classes")
    classes.write.parquet(path)
    classes = spark.read.schema(classes.schema).parquet(path)
    target = F.struct(*[F.col(k).alias(n) for k, n in zip(ks, names)])
    none = F.lit(None).cast(b.select(target.alias("to")).schema["to"].dataType)
    given = [F.col(k).alias(n) for k, n in zip(ks, names)]
    if not fields:
        return classes.select(*given, "change", none.alias("to"))

    def side(df: DataFrame, change: str, name: str) -> DataFrame:
        rows = df.join(classes.where(F.col("change") == change).select(*ks), ks, "left_semi")
        return _ranked(rows.select(*ks, F.unhex(content_hash(fields)).alias("_hash")), ks, name)

    gone = side(a, REMOVED, "removed").select(target.alias("_from"), "_hash", "_rank")
    come = side(b, ADDED, "added").select(target.alias("_to"), "_hash", "_rank")
    pairs = gone.join(come, ["_hash", "_rank"], "full_outer")
    change = F.when(F.col("_to").isNull(), F.lit(REMOVED)).when(F.col("_from").isNull(), F.lit(ADDED)).otherwise(F.lit(MOVED))
    key = F.coalesce("_from", "_to")
    moved = pairs.select(
        *[key.getField(n).alias(n) for n in names], change.alias("change"), F.when(F.col("_from").isNotNull(), F.col("_to")).alias("to")
    )
    rest = classes.where(F.col("change").isin(MODIFIED, UNCHANGED)).select(*given, "change", none.alias("to"))
    return rest.unionByName(moved)
