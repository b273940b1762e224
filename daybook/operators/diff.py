"""Snapshot diff (A01, A02, J01, F10-F12) and the change-log shape.

A change log row is ``<keys>, op, before, after, day``: ``op`` is INSERT,
UPDATE or DELETE; ``before`` is the row content before the change (null for
INSERT) and ``after`` the content after it (null for DELETE). Keeping both
images is what makes a change reversible (forward and reverse replay).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_lit
from ..functions.equality import content_digest, content_struct, same_content
from .keys import require_valid_keys
from .schema import align_columns, as_keys, content_fields, require_columns

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def _kcols(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def change_log_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    """Schema of the change log of a table shaped like ``df``."""
    ks = as_keys(keys)
    by_name = {f.name: f for f in df.schema.fields}
    require_columns(df, ks, "table")
    content = T.StructType(content_fields(df, ks))
    return T.StructType(
        [T.StructField(k, by_name[k].dataType, False) for k in ks]
        + [
            T.StructField("op", T.StringType(), False),
            T.StructField("before", content, True),
            T.StructField("after", content, True),
            T.StructField("day", T.DateType(), False),
        ]
    )


def _paired(prev: DataFrame, new: DataFrame, keys: list[str], fields: list[T.StructField]) -> DataFrame:
    """The one full outer equi join: ``<keys>, _p, _n`` (side structs).

    A side struct is null exactly when that side has no row for the key; a
    present row whose fields are all null is a non-null struct.
    """
    p = prev.select(*_kcols(keys), content_struct(fields).alias("_p"))
    n = new.select(*_kcols(keys), content_struct(fields).alias("_n"))
    return p.join(n, on=keys, how="full_outer")


def classify(prev: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Every key of either side with ``op`` (null when unchanged),
    ``before`` and ``after``. ``prev`` must already have ``new``'s columns."""
    ks = as_keys(keys)
    require_columns(prev, ks, "previous snapshot")
    require_columns(new, ks, "new dump")
    fields = content_fields(new, ks)
    dtype = T.StructType(fields)
    j = _paired(prev, new, ks, fields)
    p, n = F.col("_p"), F.col("_n")
    op = (
        F.when(p.isNull(), F.lit(INSERT))
        .when(n.isNull(), F.lit(DELETE))
        .when(~same_content(p, n, dtype), F.lit(UPDATE))
    )
    return j.select(*_kcols(ks), op.alias("op"), p.alias("before"), n.alias("after"))


def first_load(new: DataFrame, keys: str | Sequence[str], day) -> DataFrame:
    """The first dump of a table; every row is an INSERT."""
    ks = as_keys(keys)
    require_columns(new, ks, "new dump")
    fields = content_fields(new, ks)
    return new.select(
        *_kcols(ks),
        F.lit(INSERT).alias("op"),
        F.lit(None).cast(T.StructType(fields)).alias("before"),
        content_struct(fields).alias("after"),
        day_lit(day).alias("day"),
    )


def snapshot_diff(
    prev: DataFrame,
    new: DataFrame,
    keys: str | Sequence[str],
    day,
    on_extra: str = "drop",
    cast: bool = False,
    strategy: str = "struct",
    broadcast_limit: int | None = None,
    validate: bool = True,
) -> DataFrame:
    """The changes that turn ``prev`` into ``new``, dated ``day``.

    ``prev`` is first aligned to ``new``'s columns (P04); with
    ``on_extra="keep"`` a column that only ``prev`` has stays in the images
    (null in ``new``), so its loss is a change like any other. Keys must be
    non-null and unique on both sides: with ``validate`` (default) that is
    checked first, in one key-only job, and a violation raises
    ``KeyContractError`` (pass ``False`` for inputs already checked).

    ``strategy="struct"`` (default) shuffles each side once, whole rows, into
    one full outer join and classifies with one CASE. ``strategy="hash"``
    shuffles only ``(key, 12-byte digest)`` into that join, then classifies the
    rows of the changed keys alone; cheaper for wide rows and low change
    rates. Its changed-key set is broadcast only when its measured size is
    at most ``broadcast_limit`` bytes (default: the session's
    ``spark.sql.autoBroadcastJoinThreshold``; never over 1 GiB or a sixteenth
    of the driver's or an executor's heap). A larger set is not broadcast: both
    sides then go through the ``struct`` join, with the same result.
    """
    ks = as_keys(keys)
    prev = align_columns(prev, new.schema, on_extra=on_extra, cast=cast)
    if on_extra == "keep":
        new = align_columns(new, prev.schema)
    if validate:
        require_valid_keys({"previous snapshot": prev, "new dump": new}, ks)
    if strategy == "struct":
        changes = classify(prev, new, ks).filter(F.col("op").isNotNull())
        return changes.withColumn("day", day_lit(day))
    if strategy == "hash":
        return _diff_by_digest(prev, new, ks, day, broadcast_limit)
    raise ValueError(f"strategy must be 'struct' or 'hash', not {strategy!r}")


# No changed-key set above this is broadcast, whatever the limit given.
MAX_BROADCAST = 1 << 30

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def session_broadcast_limit(spark) -> int:
    """Bytes a broadcast side may hold: the session's broadcast threshold."""
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"), "b")


def _bytes(raw, unit: str) -> int:
    """Bytes of a size setting such as ``10m``; a bare number is in ``unit``."""
    raw = str(raw).strip().lower()
    digits = raw.rstrip("kmgtb")
    return int(digits) * _UNITS.get(raw[len(digits):] or unit, 1)


# A set is collected, hashed and serialized to be broadcast: several times its
# key_bytes are held at once, beside whatever else the memory is for.
MEMORY_SHARE = 16


def least_memory(spark) -> int:
    """Bytes of the smallest heap that a broadcast has to fit: the driver's or an executor's."""
    sc = spark.sparkContext
    heap = sc._jvm.java.lang.Runtime.getRuntime().maxMemory()
    if re.fullmatch(r"local(\[.*\])?", sc.master):  # no executors beside the driver
        return heap
    return min(heap, _bytes(sc.getConf().get("spark.executor.memory", "1g"), "m"))


def broadcast_room(spark, limit: int | None = None) -> int:
    """Most ``key_bytes`` of a set that is broadcast: ``limit`` (default: the
    session's threshold), as far as the driver and the executors can hold it."""
    wanted = limit if limit is not None else session_broadcast_limit(spark)
    return min(wanted, MAX_BROADCAST, least_memory(spark) // MEMORY_SHARE)


def key_bytes(df: DataFrame, ks: list[str]) -> Column:
    """An upper bound of the hashed-relation bytes of one row's keys."""
    total = F.lit(16).cast("bigint")  # per-row overhead of the hashed relation
    for f in df.select(*_kcols(ks)).schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 8
        else:
            total = total + F.lit(16)
    return total


def _diff_by_digest(prev: DataFrame, new: DataFrame, ks: list[str], day, broadcast_limit: int | None = None) -> DataFrame:
    """Phase 1 joins ``(key, digest)`` only and keeps the keys whose digest
    differs or is missing on a side; that key set is checkpointed (shared
    checkpoint dir) and measured exactly. Phase 2 classifies only those keys:
    if the set fits the limit and the memory both sides are semi-joined
    against its broadcast (no shuffle of whole rows but the changed ones);
    otherwise the change rate is high and phase 2 is the plain one-join
    classification of the full sides."""
    from ..session import shared_root

    spark = prev.sparkSession
    fields = content_fields(new, ks)
    ph = prev.select(*_kcols(ks), content_digest(fields).alias("_hp"))
    nh = new.select(*_kcols(ks), content_digest(fields).alias("_hn"))
    changed = (
        ph.join(nh, on=ks, how="full_outer")
        .filter(~F.col("_hp").eqNullSafe(F.col("_hn")))
        .select(*_kcols(ks))
    )
    shared_root(spark)  # the checkpoint dir must be the shared one
    changed = changed.checkpoint(eager=True)
    size = changed.agg(F.coalesce(F.sum(key_bytes(changed, ks)), F.lit(0))).first()[0]
    if size <= broadcast_room(spark, broadcast_limit):
        keyset = F.broadcast(changed)
        prev = prev.join(keyset, on=ks, how="left_semi")
        new = new.join(keyset, on=ks, how="left_semi")
    out = classify(prev, new, ks).filter(F.col("op").isNotNull())
    return out.withColumn("day", day_lit(day))


def flatten_changes(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``<keys>, op, before_<c>..., after_<c>..., [day]`` with plain columns."""
    ks = as_keys(keys)
    fields = log.schema["after"].dataType.fields
    cols = _kcols(ks) + [F.col("op")]
    cols += [F.col("before").getField(f.name).alias(f"before_{f.name}") for f in fields]
    cols += [F.col("after").getField(f.name).alias(f"after_{f.name}") for f in fields]
    if "day" in log.columns:
        cols.append(F.col("day"))
    return log.select(*cols)


def side_rows(changes: DataFrame, keys: str | Sequence[str], side: str) -> DataFrame:
    """The plain rows of one image side (``before`` or ``after``) plus ``op``."""
    ks = as_keys(keys)
    return changes.select(*_kcols(ks), f"{side}.*", "op")
