"""Renamed columns under drift (P04, D12): which new column holds an old one's values.

A column that leaves and one that comes may be one column under another name.
That shows in the rows: under a new name the keys keep their values. Every key
common to both dumps votes, with 8 bytes for each column in question, and the
votes are counted in one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.equality import value_json
from .schema import as_keys, content_fields, nullable, require_columns

#: Hash buckets of a column's values, from which agreement by chance is estimated.
CHANCE_BUCKETS = 256

MATCHES = "old string, new string, agreed long, filled_old long, filled_new long, share double, above_chance double, chosen boolean"


def _vote(field: T.StructField) -> Column:
    """A hash of the column's type and value (null for null), equal for equal content."""
    c = F.col(f"`{field.name}`")
    return F.when(c.isNotNull(), F.xxhash64(F.lit(nullable(field.dataType).simpleString()), value_json(c, field.dataType)))


def column_matches(
    prev: DataFrame, new: DataFrame, keys: str | Sequence[str], min_share: float = 0.9, min_above_chance: float = 0.5
) -> DataFrame:
    """Pairs of a column only ``prev`` has and one of the same type only ``new`` has, with the votes of the common keys.

    ``agreed`` keys have one non-null value in both; ``filled_old`` and
    ``filled_new`` of the common keys have any; ``share`` is ``agreed`` over the
    larger of the two. ``above_chance`` (Cohen's kappa) is what remains of the
    share once the agreement of two unrelated columns with these values is taken
    off (1: all agree, 0: chance; null: a constant, which tells nothing).
    ``chosen`` pairs reach both thresholds and are one to one: the better pair
    first, and where two pairs that share a column are equally good, neither,
    as either would be a guess. Pairs without any agreeing key aren't listed.

    Keys are unique on both sides, as dumps are. One join that moves the keys
    and 8 bytes per column in question; the counts, a row for each pair and at
    most ``CHANCE_BUCKETS`` for each column, are all the driver sees.
    """
    ks = as_keys(keys)
    require_columns(prev, ks, "previous frame")
    require_columns(new, ks, "new frame")
    gone = [f for f in content_fields(prev, ks) if f.name not in new.columns]
    come = [f for f in content_fields(new, ks) if f.name not in prev.columns]
    kinds = {nullable(f.dataType).simpleString() for f in gone} & {nullable(f.dataType).simpleString() for f in come}
    gone, come = ([f for f in fields if nullable(f.dataType).simpleString() in kinds] for fields in (gone, come))
    if not gone or not come:
        return prev.sparkSession.createDataFrame([], MATCHES)
    counts = _counts(prev, new, ks, gone, come)
    pairs = [_rate(counts, f.name, g.name, i, j) for i, f in enumerate(gone) for j, g in enumerate(come) if counts.get((2, i, j))]
    chosen = _assign([p for p in pairs if p[5] >= min_share and p[6] is not None and p[6] >= min_above_chance])
    return prev.sparkSession.createDataFrame([(*p, (p[0], p[1]) in chosen) for p in pairs], MATCHES)


def _counts(prev: DataFrame, new: DataFrame, ks: list[str], gone: Sequence[T.StructField], come: Sequence[T.StructField]) -> dict:
    """{(0, i, bucket) | (1, j, bucket) | (2, i, j) | (3, 0, 0): rows}: values by bucket, agreeing pairs, common keys."""
    key = [f"_k{i}" for i in range(len(ks))]

    def side(df: DataFrame, fields: Sequence[T.StructField], name: str) -> DataFrame:
        votes = F.array(*[F.struct(F.lit(i).alias("c"), _vote(f).alias("h")) for i, f in enumerate(fields)])
        return df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(ks, key)], F.filter(votes, lambda v: v["h"].isNotNull()).alias(name))

    def entry(kind: int, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), a.cast("int").alias("a"), b.cast("int").alias("b"))

    def values(kind: int, votes: str) -> Column:
        return F.transform(votes, lambda v: entry(kind, v["c"], F.pmod(v["h"], F.lit(CHANCE_BUCKETS))))

    agreeing = F.flatten(F.transform("_old", lambda o: F.transform(F.filter("_new", lambda n: n["h"] == o["h"]), lambda n: entry(2, o["c"], n["c"]))))
    both = side(prev, gone, "_old").join(side(new, come, "_new"), key)
    entries = both.select(F.explode(F.concat(F.array(entry(3, F.lit(0), F.lit(0))), values(0, "_old"), values(1, "_new"), agreeing)).alias("e"))
    return {(r.kind, r.a, r.b): r.n for r in entries.groupBy("e.kind", "e.a", "e.b").agg(F.count("*").alias("n")).collect()}


def _rate(counts: Mapping, old: str, new: str, i: int, j: int) -> tuple:
    mine, theirs = ([counts.get((side, c, b), 0) for b in range(CHANCE_BUCKETS)] for side, c in ((0, i), (1, j)))
    agreed, filled = counts[2, i, j], max(sum(mine), sum(theirs))
    # buckets hold whole values, so this is no less than two unrelated columns would agree
    chance = sum(a * b for a, b in zip(mine, theirs)) / counts[3, 0, 0] / filled
    share = agreed / filled
    return old, new, agreed, sum(mine), sum(theirs), share, (share - chance) / (1 - chance) if chance < 1 else None


def _assign(pairs: list[tuple]) -> set[tuple[str, str]]:
    """One-to-one pairs, the best first; equally good pairs that share a column are all left out."""
    chosen, taken = set(), set()
    rank = lambda p: (p[6], p[2])
    for best in sorted({rank(p) for p in pairs}, reverse=True):
        level = [p for p in pairs if rank(p) == best and ("old", p[0]) not in taken and ("new", p[1]) not in taken]
        for p in level:
            if not any(q is not p and (q[0] == p[0] or q[1] == p[1]) for q in level):
                chosen.add((p[0], p[1]))
        taken |= {x for p in level for x in (("old", p[0]), ("new", p[1]))}
    return chosen


def renamed_columns(
    prev: DataFrame, new: DataFrame, keys: str | Sequence[str], min_share: float = 0.9, min_above_chance: float = 0.5
) -> dict[str, str]:
    """``{old: new}`` of the pairs that :func:`column_matches` chooses (no job without columns in question)."""
    return {r.old: r.new for r in column_matches(prev, new, keys, min_share, min_above_chance).where("chosen").collect()}


def check_renames(renames: Mapping[str, str], prev: T.StructType, new: T.StructType, keys: Sequence[str]) -> dict[str, str]:
    """``renames`` if each takes a content column that only ``prev`` has to one that only ``new`` has, one to one."""
    had, has = set(prev.fieldNames()) - set(keys), set(new.fieldNames()) - set(keys)
    wrong = {o: n for o, n in renames.items() if o not in had - has or n not in has - had}
    if wrong:
        raise ValueError(f"renames {wrong} don't take a column that leaves to one that comes: {sorted(had - has)} leave, {sorted(has - had)} come")
    if len(set(renames.values())) < len(renames):
        raise ValueError(f"renames {dict(renames)} take two columns to one")
    return dict(renames)


def fitting_renames(renames: Mapping[str, str], prev: T.StructType, new: T.StructType) -> dict[str, str]:
    """Those of ``renames`` whose old name only ``prev`` has and whose new one only ``new`` has."""
    had, has = set(prev.fieldNames()), set(new.fieldNames())
    return {o: n for o, n in renames.items() if o in had - has and n in has - had}
