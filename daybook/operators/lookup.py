"""Point-in-time lookup: what the table said of many keys, each at a day of its own.

The change log gives every key's rows intervals of validity; a probe (key, day)
finds the one interval its day falls in, by an equi join on the key with the day
as a condition on top. No day's table is rebuilt, whatever days are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .diff import DELETE
from .replay import _by_key, _image_fields, _kcols
from .schema import as_keys, require_columns

#: A key is hot if it has more than this share of the probes, so at most a thousand keys are.
HOT_SHARE = 0.001


def intervals(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``<keys>, valid_from, valid_to, row``: when each row of the table held.

    ``valid_to`` is the first day it no longer held (null: still holds). One
    shuffle of the log; a key's window holds one row per day it changed on.
    """
    ks = as_keys(keys)
    _image_fields(log)
    following = F.lead("day").over(Window.partitionBy(*ks).orderBy("day"))
    rows = _by_key(log, ks).select(*_kcols(ks), "op", "after", F.col("day").alias("valid_from"), following.alias("valid_to"))
    return rows.where(F.col("op") != DELETE).select(*_kcols(ks), "valid_from", "valid_to", F.col("after").alias("row"))


def lookup(
    log: DataFrame,
    probes: DataFrame,
    keys: str | Sequence[str],
    day_col: str = "day",
    probe_keys: Sequence[str] | None = None,
    into: str = "at",
    hot_rows: int = 1_000_000,
    salts: int = 32,
) -> DataFrame:
    """``probes`` with a column ``into``: ``struct<valid_from, row>`` of the table on each probe's day.

    ``probe_keys`` name the probes' key columns (default: the log's names). The
    struct is null where the key has no row that day, or key or day is null;
    every probe gives one row. Each side is shuffled once, by key. A key with
    more than ``hot_rows`` probes and over a thousandth of them all is hot: its
    probes are dealt to ``salts`` tasks and its intervals copied to these. Of
    such keys there are less than a thousand, which is what is broadcast.
    """
    ks = as_keys(keys)
    mine = list(probe_keys) if probe_keys else ks
    require_columns(probes, [*mine, day_col], "probes")
    if into in probes.columns:
        raise ValueError(f"probes have a column {into!r}; name another one")
    if len(mine) != len(ks):
        raise ValueError(f"probe keys {mine} don't match the log's {ks}")
    k = [f"_k{i}" for i in range(len(ks))]
    # the probe's row in one struct, so that its names meet no others
    asked = probes.select(
        F.struct(*[F.col(f"`{c}`") for c in probes.columns]).alias("_probe"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(mine, k)],
        F.col(f"`{day_col}`").cast("date").alias("_day"),
    )
    held = intervals(log, ks)
    held = held.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(ks, k)], "valid_from", "valid_to", "row")
    on = list(k)
    total = probes.count()
    if total > hot_rows:
        often = asked.groupBy(*k).agg(F.count("*").alias("_n")).where(F.col("_n") > max(hot_rows, int(total * HOT_SHARE)))
        hot = F.broadcast(often.select(*k, F.lit(True).alias("_hot")))
        deal = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0)).cast("int")
        asked = asked.join(hot, k, "left").withColumn("_salt", deal).drop("_hot")
        copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        held = held.join(hot, k, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
        on.append("_salt")
    a, b = asked.alias("a"), held.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    within = (F.col("a._day") >= F.col("b.valid_from")) & (F.col("b.valid_to").isNull() | (F.col("a._day") < F.col("b.valid_to")))
    found = F.when(F.col("b.valid_from").isNotNull(), F.struct(F.col("b.valid_from"), F.col("b.row")))
    return a.join(b, [*same, within], "left").select("a._probe", found.alias("_found")).select("_probe.*", F.col("_found").alias(into))
