"""Replay of a change log: apply (A03), backfill (A05), time travel.

Per-key order is what makes replay exact: the state of a key at day ``t`` is
the ``after`` image of its *last* change on or before ``t`` (forward), or the
``before`` image of its *first* change after ``t`` (reverse). Both are one
grouped ``max_by``/``min_by`` on ``day`` after one shuffle of the changes
only (see ``_by_key``); the (large) snapshot side is never aggregated,
it only passes through an anti join that AQE turns into a broadcast when the
change set turns out small.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_lit, to_day
from ..functions.equality import content_digest, content_struct, same_content
from ..session import shared_root
from .diff import DELETE, INSERT, UPDATE, broadcast_room, key_bytes
from .keys import require_valid_keys
from .schema import as_keys, content_fields, require_columns


def _kcols(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def _image_fields(log: DataFrame) -> list[T.StructField]:
    require_columns(log, ["op", "before", "after", "day"], "change log")
    return list(log.schema["after"].dataType.fields)


def _rows(df: DataFrame, keys: list[str], image: str, fields: list[T.StructField]) -> DataFrame:
    return df.select(*_kcols(keys), *[F.col(image).getField(f.name).alias(f.name) for f in fields])


def _by_key(log: DataFrame, keys: list[str]) -> DataFrame:
    """The change rows clustered by key, ready for a per-key reduction.

    Log keys are non-null by contract; stating it here (rather than letting
    the optimizer infer it on the anti-join branch only) keeps the two
    branches of a replay one identical plan, so the change window is
    scanned and shuffled once (ReusedExchange). Clustering by key first
    skips the map-side partial aggregate: log files hold one day each, where
    a key occurs at most once, so combining there would only add a sort of
    the whole change window; the per-key groups are bounded by the number
    of days."""
    nonnull = functools.reduce(lambda a, b: a & b, [c.isNotNull() for c in _kcols(keys)])
    return log.filter(nonnull).repartition(*_kcols(keys))


def last_change(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Per key, the latest change: ``<keys>, op, after, day``."""
    ks = as_keys(keys)
    last = F.max_by(F.struct("op", "after", "day"), "day").alias("_c")
    return _by_key(log, ks).groupBy(*ks).agg(last).select(*_kcols(ks), "_c.op", "_c.after", "_c.day")


def first_change(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Per key, the earliest change: ``<keys>, op, before, day``."""
    ks = as_keys(keys)
    first = F.min_by(F.struct("op", "before", "day"), "day").alias("_c")
    return _by_key(log, ks).groupBy(*ks).agg(first).select(*_kcols(ks), "_c.op", "_c.before", "_c.day")


def _changed_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a (per-key reduced) change set. The ``op`` test is always
    true; it keeps this branch reading the same aggregate as the image
    branch, so the change set is shuffled once and reused by both."""
    return changes.filter(F.col("op").isNotNull()).select(*_kcols(keys))


def _ordered(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


def apply_changes(
    snapshot: DataFrame, changes: DataFrame, keys: str | Sequence[str], many_days: bool = False
) -> DataFrame:
    """``snapshot`` with ``changes`` applied.

    ``snapshot ▷ changed keys  ∪  after-images of non-DELETE changes``: one
    anti join and a union. ``changes`` holds at most one change per key
    (one day's diff); pass ``many_days=True`` to reduce a multi-day change
    set to each key's last change first.
    """
    ks = as_keys(keys)
    fields = _image_fields(changes)
    if many_days:
        changes = last_change(changes, ks)
    kept = snapshot.join(_changed_keys(changes, ks), on=ks, how="left_anti")
    added = _rows(changes.filter(F.col("op") != DELETE), ks, "after", fields)
    return _ordered(kept.unionByName(added), snapshot.columns)


def as_of(
    log: DataFrame,
    day,
    keys: str | Sequence[str],
    base: DataFrame | None = None,
    base_day=None,
) -> DataFrame:
    """A06, forward replay: the table as it stood at the end of ``day``.

    Without a base, replays the log from its beginning: per key the last
    change on or before ``day``, kept unless it is a DELETE. With a base
    snapshot taken at ``base_day`` (<= ``day``) only the changes in
    ``(base_day, day]`` are read (partition-pruned) and applied to it.
    """
    ks = as_keys(keys)
    fields = _image_fields(log)
    t = to_day(day)
    if base is None:
        last = last_change(log.filter(F.col("day") <= F.lit(t)), ks)
        return _rows(last.filter(F.col("op") != DELETE), ks, "after", fields)
    b = to_day(base_day)
    if b > t:
        raise ValueError(f"base day {b} is after the target day {t}")
    window = log.filter((F.col("day") > F.lit(b)) & (F.col("day") <= F.lit(t)))
    return apply_changes(base, window, ks, many_days=True)


def undo_to(latest: DataFrame, log: DataFrame, day, keys: str | Sequence[str]) -> DataFrame:
    """A07/A08, reverse replay: undo every change made after ``day``.

    Per key the first change after ``day`` decides: INSERT means the key did
    not exist at ``day``; UPDATE or DELETE restore its ``before`` image.
    Keys without later changes keep their latest row (A08: with no change
    after ``day`` the result is ``latest`` itself).
    """
    ks = as_keys(keys)
    fields = _image_fields(log)
    first = first_change(log.filter(F.col("day") > F.lit(to_day(day))), ks)
    kept = latest.join(_changed_keys(first, ks), on=ks, how="left_anti")
    restored = _rows(first.filter(F.col("op") != INSERT), ks, "before", fields)
    return _ordered(kept.unionByName(restored), latest.columns)


def stack_dumps(dumps: Sequence[tuple[object, DataFrame]], day_col: str = "day") -> DataFrame:
    """Dated dumps (same columns) as one frame with a ``day`` column."""
    taken = [d for d, df in dumps if day_col in df.columns]
    if taken:
        raise ValueError(f"dumps of {taken} have a column {day_col!r}; name another day column")
    frames = [df.withColumn(day_col, day_lit(d)) for d, df in dumps]
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def build_change_log(
    dumps: DataFrame | Sequence[tuple[object, DataFrame]],
    keys: str | Sequence[str],
    days: Sequence | None = None,
    base: DataFrame | None = None,
    day_col: str = "day",
    validate: bool = True,
    strategy: str = "struct",
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The change log of many consecutive dumps in one pass.

    ``dumps`` is either a list of ``(day, frame)`` or one frame with a
    ``day`` column (e.g. a partitioned dump folder). ``days`` is the ordered
    list of dump days (read from the data if not given; only the distinct
    days reach the driver). ``base`` is the snapshot before the first day;
    without it the first day is a first load (all INSERT).

    One window per key, ordered by day index: the previous appearance
    (``lag``) gives INSERT (absent the day before) or UPDATE (content
    changed); the next appearance (``lead``) gives a DELETE on the day after
    the last day the key was seen. One hash exchange on the keys; a key has
    at most one row per dump, so no window group outgrows the number of days
    -- which ``validate`` (default) checks first: keys non-null and unique
    per day (and in ``base``), in one key-only job.

    ``strategy="hash"`` sends ``(key, day, digest)`` through the window instead
    of whole rows, writes the events it finds to the shared checkpoint folder,
    and then looks up the images of the changed rows only, by a broadcast of
    their ``(key, day)`` if its measured size is at most ``broadcast_limit``
    and fits the driver's and the executors' memory (as in ``snapshot_diff``);
    a larger set goes through the window of whole rows, with the same result.
    """
    ks = as_keys(keys)
    if strategy not in ("struct", "hash"):
        raise ValueError(f"strategy must be 'struct' or 'hash', not {strategy!r}")
    if not isinstance(dumps, DataFrame):
        if days is None:
            days = [d for d, _ in dumps]
        day_col = "_dump_day"  # a content column may be called day
        dumps = stack_dumps(dumps, day_col)
    require_columns(dumps, ks + [day_col], "dumps")
    if days is None:
        days = [r[0] for r in dumps.select(day_col).distinct().collect()]
    days = sorted({to_day(d) for d in days})
    if not days:
        raise ValueError("no dump days")
    fields = content_fields(dumps, ks, ignore=(day_col,))
    dtype = T.StructType(fields)
    if validate:
        frames = {"dumps": dumps.select(*_kcols(ks), F.col(day_col).cast("date").alias("_d"))}
        if base is not None:
            frames["base"] = base.select(*_kcols(ks), F.lit(None).cast("date").alias("_d"))
        require_valid_keys(frames, ks, within=["_d"])

    # The dump calendar: day -> (index, next dump day). One row per dump day,
    # so broadcasting it is bounded by the number of days; the lookup is a
    # hash probe per row, not a scan of the day list.
    day_array = F.array(*[F.lit(d) for d in days])
    idx = F.col("id").cast("int")
    calendar = dumps.sparkSession.range(len(days), numPartitions=1).select(
        F.element_at(day_array, idx + 1).alias("_day"),
        idx.alias("_i"),
        F.when(idx + 1 < len(days), F.element_at(day_array, F.least(idx + 2, F.lit(len(days))))).alias("_next"),
    )
    dated = dumps.select(*_kcols(ks), content_struct(fields).alias("_row"), F.col(day_col).cast("date").alias("_day"))
    dated = dated.join(F.broadcast(calendar), on="_day", how="left")
    unknown = F.raise_error(F.concat(F.lit("dump day not in the day list: "), F.col("_day").cast("string")))
    rows = dated.select(
        *_kcols(ks),
        "_row",
        "_day",
        "_next",
        F.when(F.col("_i").isNotNull(), F.col("_i")).otherwise(unknown.cast("int")).alias("_i"),
    )
    if base is not None:
        first = F.lit(days[0])
        rows = base.select(
            *_kcols(ks),
            content_struct(fields).alias("_row"),
            F.lit(None).cast("date").alias("_day"),
            first.alias("_next"),
            F.lit(-1).alias("_i"),
        ).unionByName(rows)

    if strategy == "hash":
        out = _log_by_digest(rows, ks, fields, broadcast_limit)
        if out is not None:
            return out
    no_image = F.lit(None).cast(dtype)
    events = _events(
        rows, ks, "_row", lambda before, after: ~same_content(before, after, dtype), before=lambda i, row: row, after=lambda i, row: row, none=no_image
    )
    return events.select(*_kcols(ks), "op", F.col("before"), F.col("after"), "day")


def _events(rows: DataFrame, ks: list[str], value: str, differs, before, after, none: Column) -> DataFrame:
    """``<keys>, op, before, after, day`` of rows ``<keys>, value, _day, _next, _i``.

    ``differs`` compares two days' values; ``before`` and ``after`` make the
    images from a day index and its value.
    """
    w = Window.partitionBy(*ks).orderBy("_i")
    rows = rows.select(
        "*",
        F.lag("_i").over(w).alias("_prev_i"),
        F.lag(value).over(w).alias("_prev"),
        F.lead("_i").over(w).alias("_next_i"),
    )
    i, now = F.col("_i"), F.col(value)
    prev_i, prev, next_i = F.col("_prev_i"), F.col("_prev"), F.col("_next_i")

    def event(op: str, b: Column, a: Column, day: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), b.alias("before"), a.alias("after"), day.alias("day"))

    today, tomorrow = F.col("_day"), F.col("_next")
    appears = (
        F.when(i < 0, F.lit(None))
        .when(prev_i.isNull() | (prev_i < i - 1), event(INSERT, none, after(i, now), today))
        .when(differs(prev, now), event(UPDATE, before(prev_i, prev), after(i, now), today))
    )
    vanishes = F.when(
        (next_i.isNull() & tomorrow.isNotNull()) | (next_i > i + 1),
        event(DELETE, before(i, now), none, tomorrow),
    )
    out = rows.select(*_kcols(ks), F.explode(F.array_compact(F.array(appears, vanishes))).alias("_e"))
    return out.select(*_kcols(ks), "_e.op", "_e.before", "_e.after", "_e.day")


def _log_by_digest(rows: DataFrame, ks: list[str], fields: list[T.StructField], limit: int | None) -> DataFrame | None:
    """The log of ``rows`` from their digests; None if too many rows changed to look them up."""
    spark = rows.sparkSession
    narrow = rows.select(*_kcols(ks), content_digest(fields, "_row").alias("_d"), "_day", "_next", "_i")
    nothing = F.lit(None).cast("int")
    found = _events(narrow, ks, "_d", lambda a, b: a != b, before=lambda i, d: i, after=lambda i, d: i, none=nothing)
    shared_root(spark)  # the checkpoint dir must be the shared one
    found = found.checkpoint(eager=True)
    wanted = found.select(*_kcols(ks), F.explode(F.array_compact(F.array("before", "after"))).alias("_i")).distinct()
    size = wanted.agg(F.coalesce(F.sum(key_bytes(wanted, ks) + 16), F.lit(0))).first()[0]
    if size > broadcast_room(spark, limit):
        return None
    images = rows.select(*_kcols(ks), "_i", "_row").join(F.broadcast(wanted), on=[*ks, "_i"])
    for side in ("before", "after"):
        mine = images.select(*_kcols(ks), F.col("_i").alias(side), F.col("_row").alias(f"_{side}"))
        found = found.join(mine, on=[*ks, side], how="left")
    return found.select(*_kcols(ks), "op", F.col("_before").alias("before"), F.col("_after").alias("after"), "day")
