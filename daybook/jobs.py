"""The four user-level jobs, as functions over paths that return results.

These are the entry points a user of a daily-dump history runs: integrate
today's dump, rebuild the table at a date, diff two dumps, report on the
latest snapshot. Each is a thin composition of the operators; nothing is
printed, everything comes back as DataFrames (or a dict of counts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .operators.compare import compare_report
from .operators.report import sample_rows, schema_of, top_n, total_rows
from .operators.schema import as_keys
from .sources.io import read_dump_csv, read_parquet, write_parquet
from .sources.rejects import split_dump_csv
from .sources.store import Store

# The report's top-N sections (column, how many). A section
# whose column the snapshot lacks is skipped.
REPORT_SECTIONS = (("code_departement", 20), ("nom_commune", 10), ("nom_voie", 10))


def daily_integration(
    spark: SparkSession,
    store_root: str,
    csv_path: str,
    day,
    schema: T.StructType,
    keys: str | Sequence[str],
    key_aliases=("id",),
    max_rejects: float | None = None,
    rejects_dir: str | None = None,
    renames=None,
    **store_options,
) -> dict:
    """Integrate one CSV dump as the table on ``day``; returns the day's counts.

    A line that doesn't fit the schema fails the day, unless ``max_rejects``
    allows a share of such lines: these are left out, counted (``rejected``, at
    the cost of one more pass over the dump) and written to ``rejects_dir``, if
    given, before the day is integrated. Over that share nothing is stored.
    ``renames`` goes to :meth:`Store.integrate`.
    """
    ks = as_keys(keys)
    key = ks[0] if len(ks) == 1 else None
    store = Store(spark, store_root, ks, **store_options)
    if max_rejects is None:
        return store.integrate(read_dump_csv(spark, csv_path, schema, key=key, key_aliases=key_aliases), day, renames=renames)
    split = split_dump_csv(spark, csv_path, schema, key=key, key_aliases=key_aliases)
    _, rejected = split.require(max_rejects)
    if rejects_dir is not None:
        write_parquet(split.rejects, rejects_dir)
    return {**store.integrate(split.accepted, day, renames=renames), "rejected": rejected}


def recompute_at_date(
    spark: SparkSession, store_root: str, day, keys: str | Sequence[str], output_dir: str | None = None
) -> DataFrame:
    """The full table as of ``day``; written to ``output_dir`` when given
    and then returned as read back from there."""
    df = Store(spark, store_root, keys).as_of(day)
    if output_dir is None:
        return df
    write_parquet(df, output_dir)
    return read_parquet(spark, output_dir)


def diff_between_dumps(
    spark: SparkSession, dir_a: str, dir_b: str, keys: str | Sequence[str], samples: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Compare two Parquet dumps: ``(summary row, samples per class)``."""
    return compare_report(read_parquet(spark, dir_a), read_parquet(spark, dir_b), keys, samples)


def report(
    spark: SparkSession,
    store_root: str,
    keys: str | Sequence[str],
    sections: Sequence[tuple[str, int]] = REPORT_SECTIONS,
    samples: int = 5,
) -> dict[str, DataFrame]:
    """Report on the latest snapshot: total, top-N per present column, schema, sample."""
    snap = Store(spark, store_root, keys).read_snapshot()
    out = {"total": total_rows(snap)}
    for column, n in sections:
        if column in snap.columns:
            out[f"top{n}_{column}"] = top_n(snap, column, n)
    out["schema"] = schema_of(snap)
    out["sample"] = sample_rows(snap, keys, samples)
    return out
