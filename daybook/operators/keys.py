"""Business-key contract (P01, D14, D15): keys are non-null and unique per dump."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import as_keys


class KeyContractError(ValueError):
    """A dump has null or duplicate business keys."""


def normalize_key(df: DataFrame, key: str, aliases: Sequence[str] = ("id",)) -> DataFrame:
    """Rename the first present alias to ``key`` when ``key`` is absent."""
    if key in df.columns:
        return df
    for alias in aliases:
        if alias in df.columns:
            return df.withColumnRenamed(alias, key)
    return df


def key_problems(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: ``null_keys`` (rows with a null key part) and ``duplicate_keys``
    (distinct keys seen more than once). Reads only the key columns; the
    per-key count is combined map-side before the single shuffle."""
    ks = as_keys(keys)
    any_null = F.lit(False)
    for k in ks:
        any_null = any_null | F.col(f"`{k}`").isNull()
    per_key = df.select(*ks).groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.select(
        F.when(any_null, F.col("_n")).otherwise(F.lit(0)).alias("_null_rows"),
        F.when(~any_null & (F.col("_n") > 1), 1).otherwise(0).alias("_dup"),
    ).agg(
        F.coalesce(F.sum("_null_rows"), F.lit(0)).cast("bigint").alias("null_keys"),
        F.coalesce(F.sum("_dup"), F.lit(0)).cast("bigint").alias("duplicate_keys"),
    )


def require_valid_key(df: DataFrame, keys: str | Sequence[str], what: str = "dump") -> None:
    """Raise :class:`KeyContractError` if any key is null or duplicated."""
    require_valid_keys({what: df}, keys)


def _any_null(ks: Sequence[str]):
    return functools.reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in ks])


def offending_keys(
    frames: Mapping[str, DataFrame], keys: str | Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """``_frame, <keys>, _n`` for every null or repeated key of each frame
    (``_frame`` is the frame's position in ``frames``). Each frame is
    counted on its own, so its partitioning is kept (see below)."""
    ks, scope = as_keys(keys), list(within)
    any_null = _any_null(ks)
    offending = [
        df.groupBy(*[F.col(f"`{c}`") for c in scope + ks])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(any_null | (F.col("_n") > 1))
        .select(F.lit(i).alias("_frame"), *[F.col(f"`{k}`") for k in ks], "_n")
        for i, df in enumerate(frames.values())
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), offending)


def require_valid_keys(
    frames: Mapping[str, DataFrame], keys: str | Sequence[str], within: Sequence[str] = ()
) -> None:
    """The key contract for several frames at once, in one job: each
    frame's key columns counted per key (combined map-side, so a key
    repeated across a third of the rows collapses before the shuffle; no
    shuffle at all for a frame already partitioned by the key, such as a
    bucketed snapshot), then only the offending keys of all frames, tagged
    by frame, summarized. ``within`` columns (e.g. the dump day) scope
    uniqueness without being null-checked. Runs before any join on the key,
    so a bad input never reaches a join that would pair its copies."""
    ks, names = as_keys(keys), list(frames)
    any_null = _any_null(ks)
    per_key = offending_keys(frames, ks, within)
    if per_key.isEmpty():  # the common case: one probe
        return
    summary = (
        per_key.groupBy("_frame")
        .agg(
            F.sum(F.when(any_null, F.col("_n")).otherwise(0)).alias("null_keys"),
            F.sum(F.when(~any_null & (F.col("_n") > 1), 1).otherwise(0)).alias("duplicate_keys"),
        )
        .filter((F.col("null_keys") > 0) | (F.col("duplicate_keys") > 0))
        .collect()  # at most one row per frame
    )
    if summary:
        parts = [f"{names[r['_frame']]}: {r['null_keys']} row(s) with a null key, {r['duplicate_keys']} duplicated key(s)" for r in summary]
        raise KeyContractError(f"key {ks} must be non-null and unique; " + "; ".join(parts))
