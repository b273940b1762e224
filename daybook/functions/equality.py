"""Row-content equality (the default change test) and the content hash.

Equality is null-safe struct equality (``<=>``): null vs value is a change,
null vs null is not, ``-0.0`` equals ``0.0`` and ``NaN`` equals ``NaN``, and
timestamps compare at full microsecond precision. Maps can't be compared by
Spark, so a map is compared as its entries sorted by key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed output formats for the JSON behind the content hash: nulls are kept and
# timestamps keep all six fractional digits, so neither can hide a change.
HASH_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _has(dtype: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has(f.dataType, kinds) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return _has(dtype.keyType, kinds) or _has(dtype.valueType, kinds)
    return False


def _normalize(c: Column, dtype: T.DataType, for_hash: bool) -> Column:
    """Rewrite ``c`` into a form whose ``<=>`` (or JSON) is the equality we want."""
    if isinstance(dtype, T.MapType):
        entry = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        entries = F.map_entries(c)
        if _needs(entry, for_hash):
            entries = F.transform(entries, lambda e: _normalize(e, entry, for_hash))
        return F.array_sort(entries)
    if isinstance(dtype, T.StructType):
        if not _needs(dtype, for_hash):
            return c
        fields = [_normalize(c.getField(f.name), f.dataType, for_hash).alias(f.name) for f in dtype.fields]
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        if not _needs(dtype.elementType, for_hash):
            return c
        return F.transform(c, lambda x: _normalize(x, dtype.elementType, for_hash))
    if for_hash and isinstance(dtype, (T.FloatType, T.DoubleType)):
        # -0.0 and 0.0 are equal under <=>; make their JSON equal too.
        return F.when(c == 0, F.lit(0.0).cast(dtype)).otherwise(c)
    return c


def _needs(dtype: T.DataType, for_hash: bool) -> bool:
    kinds: tuple[type, ...] = (T.MapType, T.FloatType, T.DoubleType) if for_hash else (T.MapType,)
    return _has(dtype, kinds)


def comparable(c: Column, dtype: T.DataType) -> Column:
    """``c`` in a form Spark can compare with ``<=>`` (maps → sorted entries)."""
    return _normalize(c, dtype, for_hash=False)


def same_content(a: Column, b: Column, dtype: T.DataType) -> Column:
    """Null-safe equality of two values of ``dtype`` (typically row structs)."""
    if _needs(dtype, for_hash=False):
        return comparable(a, dtype).eqNullSafe(comparable(b, dtype))
    return a.eqNullSafe(b)


def content_struct(fields: list[T.StructField], source: str | None = None) -> Column:
    """``struct(c1, c2, ...)`` of the given fields, optionally from an aliased side."""
    prefix = f"{source}." if source else ""
    return F.struct(*[F.col(f"{prefix}`{f.name}`").alias(f.name) for f in fields])


def content_json(fields: list[T.StructField], source: str | None = None) -> Column:
    """Canonical JSON of the content: names kept, nulls kept, exact timestamps."""
    dtype = T.StructType(fields)
    return F.to_json(_normalize(content_struct(fields, source), dtype, for_hash=True), HASH_JSON_OPTIONS)


def value_json(c: Column, dtype: T.DataType) -> Column:
    """Canonical JSON of one value, whatever its column is called."""
    return F.to_json(F.struct(_normalize(c, dtype, for_hash=True).alias("v")), HASH_JSON_OPTIONS)


def content_hash(fields: list[T.StructField], source: str | None = None) -> Column:
    """SHA-256 (hex) of :func:`content_json`."""
    return F.sha2(content_json(fields, source), 256)


def content_digest(fields: list[T.StructField], source: str | None = None) -> Column:
    """A 96-bit change-detection digest for shuffling instead of whole rows.

    ``xxhash64`` and ``murmur3`` (two independent hashes) over a lossless form
    of the content. Spark's hash functions skip nulls and the bounds of nested
    values, so a flat column comes with a null flag, and a nested one (struct,
    array, map) as its canonical JSON, which keeps nulls, lengths and levels
    apart: ``(null, 1)`` and ``(1, null)``, ``[1]`` and ``[1, null]``, or
    ``[[1],[2]]`` and ``[[1,2],[]]`` differ. ``-0.0``/``0.0`` and map entry
    order are normalized first, as for equality. Returned as
    ``struct<x long, m int>``.
    """
    prefix = f"{source}." if source else ""
    parts = []
    for f in fields:
        c = F.col(f"{prefix}`{f.name}`")
        if _has(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(content_json([f], source))
        else:
            parts += [_normalize(c, f.dataType, for_hash=True), c.isNull()]
    return F.struct(F.xxhash64(*parts).alias("x"), F.hash(*parts).alias("m"))
