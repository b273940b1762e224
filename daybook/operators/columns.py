"""Which columns an update changed (F15, G05): null-safe comparison field by field.

Every leaf of the images (nested structs go by their fields, arrays and maps are
leaves) has a place; a change's mask has a bit for each leaf that differs, 64 to
a number. A log over days with different columns is judged over the union of
them: a column that one day lacks counts as null there, so its coming or going
changes just the rows that hold a value in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.equality import same_content
from .diff import UPDATE
from .replay import _image_fields, _kcols
from .schema import as_keys

WORD = 64


def leaves(dtype: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """(path, type) of every leaf of a row type, in column order."""
    out: list[tuple[tuple[str, ...], T.DataType]] = []
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += leaves(f.dataType, (*prefix, f.name))
        else:
            out.append(((*prefix, f.name), f.dataType))
    return out


def path_name(path: Sequence[str]) -> str:
    """``a.b``; names that hold a dot come in backticks."""
    return ".".join(f"`{p}`" if "." in p else p for p in path)


def _value(image: Column, path: Sequence[str]) -> Column:
    for name in path:
        image = image.getField(name)
    return image


def _differs(before: Column, after: Column, path: Sequence[str], dtype: T.DataType) -> Column:
    """The leaf's values differ, or a struct above it is null on one side only."""
    differs = ~same_content(_value(before, path), _value(after, path), dtype)
    for n in range(1, len(path)):
        differs = differs | (_value(before, path[:n]).isNull() != _value(after, path[:n]).isNull())
    return differs


def change_mask(before: Column, after: Column, dtype: T.StructType) -> Column:
    """``array<long>``: bit ``i % 64`` of number ``i / 64`` is set if leaf ``i`` differs."""
    words = []
    parts = leaves(dtype)
    for lo in range(0, len(parts), WORD):
        word = F.lit(0).cast("long")
        for i, (path, kind) in enumerate(parts[lo : lo + WORD]):
            bit = F.shiftleft(F.lit(1).cast("long"), i)
            word = word.bitwiseOR(F.when(_differs(before, after, path, kind), bit).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return F.array(*words) if words else F.array().cast("array<long>")


def with_change_mask(log: DataFrame, mask_col: str = "mask") -> DataFrame:
    """``log`` with the mask of every UPDATE (null for other changes)."""
    _image_fields(log)
    if mask_col in log.columns:
        raise ValueError(f"the log has a column {mask_col!r}; name another one")
    mask = change_mask(F.col("before"), F.col("after"), log.schema["after"].dataType)
    return log.withColumn(mask_col, F.when(F.col("op") == UPDATE, mask))


def _has(mask: Column, i: int) -> Column:
    return F.element_at(mask, i // WORD + 1).bitwiseAND(F.shiftleft(F.lit(1).cast("long"), i % WORD)) != 0


def column_change_counts(log: DataFrame) -> DataFrame:
    """``day, column, updates, changed``: of each day's updates, how many changed each leaf.

    One aggregate over the changes, summed in each task: no row is multiplied by
    its columns.
    """
    masked = with_change_mask(log, "_mask").where(F.col("op") == UPDATE).select("day", "_mask")
    names = [path_name(p) for p, _ in leaves(log.schema["after"].dataType)]
    counts = masked.groupBy("day").agg(
        F.count("*").alias("updates"), F.array(*[F.count_if(_has(F.col("_mask"), i)) for i in range(len(names))]).alias("_n")
    )
    rows = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("column"), F.col("_n").alias("changed"))
    one = counts.select("day", "updates", F.explode(rows).alias("x"))
    return one.select("day", F.col("x").getField("column").alias("column"), "updates", F.col("x").getField("changed").alias("changed"))


def changes_of_column(log: DataFrame, keys: str | Sequence[str], column: str | Sequence[str]) -> DataFrame:
    """``<keys>, day, before, after``: the values of one leaf on both sides of each update that changed it."""
    ks = as_keys(keys)
    path = (column,) if isinstance(column, str) else tuple(column)
    found = {p: t for p, t in leaves(log.schema["after"].dataType)}
    if path not in found and isinstance(column, str) and tuple(column.split(".")) in found:
        path = tuple(column.split("."))
    if path not in found:
        raise ValueError(f"no column {column!r} in the log; it has {[path_name(p) for p in found]}")
    before, after = F.col("before"), F.col("after")
    rows = log.where((F.col("op") == UPDATE) & _differs(before, after, path, found[path]))
    return rows.select(*_kcols(ks), "day", _value(before, path).alias("before"), _value(after, path).alias("after"))
