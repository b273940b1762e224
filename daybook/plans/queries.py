"""Registered queries: each operator of the engine run over the driver tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (whole tables; the daily snapshots are derived from
``orders``). Round-trip queries write under the session's shared folder and
return the frame read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    DELETE,
    INSERT,
    UPDATE,
    align_columns,
    apply_changes,
    as_of,
    build_change_log,
    change_counts,
    change_log_schema,
    changelog_stats,
    classify,
    common_columns,
    compare_rows,
    compare_samples,
    compare_summary,
    first_load,
    flatten_changes,
    group_count,
    key_problems,
    normalize_key,
    sample_rows,
    schema_of,
    snapshot_diff,
    top_n,
    total_rows,
    undo_to,
)
from ..functions.equality import content_hash
from ..operators.diff import side_rows
from ..operators.schema import content_fields
from ..session import scratch_path
from ..sources import io
from ..sources.store import Store
from .fixtures import DOC_KEY, KEY, day_of, document_day, read_table, snapshot, snapshots

Query = Callable[[SparkSession, str], DataFrame]


def _diff(spark, sf, a: int, b: int, strategy: str = "struct") -> DataFrame:
    return snapshot_diff(snapshot(spark, sf, a), snapshot(spark, sf, b), KEY, day_of(b), strategy=strategy)


def _log(spark, sf) -> DataFrame:
    return build_change_log(snapshots(spark, sf), KEY)


# -- diff (A01, A02, J01, F10-F12, P02, P03, U01, G04) -------------------------
def q_change_counts(spark, sf):
    return change_counts(_diff(spark, sf, 2, 3))


def q_first_load(spark, sf):
    return flatten_changes(first_load(snapshot(spark, sf, 0), KEY, day_of(0)), KEY)


def q_diff_inserts(spark, sf):
    return side_rows(_diff(spark, sf, 2, 3).filter(F.col("op") == INSERT), KEY, "after")


def q_diff_updates(spark, sf):
    return side_rows(_diff(spark, sf, 2, 3).filter(F.col("op") == UPDATE), KEY, "after")


def q_diff_deletes(spark, sf):
    return side_rows(_diff(spark, sf, 2, 3).filter(F.col("op") == DELETE), KEY, "before")


def q_change_log_day(spark, sf):
    return flatten_changes(_diff(spark, sf, 2, 3), KEY)


def q_change_log_day_hash(spark, sf):
    return flatten_changes(_diff(spark, sf, 2, 3, strategy="hash"), KEY)


def q_full_outer_classify(spark, sf):
    return flatten_changes(classify(snapshot(spark, sf, 3), snapshot(spark, sf, 4), KEY), KEY)


def q_changed_keys(spark, sf):
    return _diff(spark, sf, 2, 3).select(KEY).distinct()


def q_anti_changed_keys(spark, sf):
    return snapshot(spark, sf, 2).join(_diff(spark, sf, 2, 3).select(KEY), KEY, "left_anti")


# -- projections / schema (P01, P04, P06, P07, P11, F01) ------------------------
def q_rename_key(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col(KEY).alias("id"), "o_custkey", "o_totalprice")
    return normalize_key(orders, KEY)


def q_align_columns(spark, sf):
    target = snapshot(spark, sf, 0).schema
    drifted = read_table(spark, sf, "orders").select(KEY, "o_orderdate", "o_orderstatus", "o_custkey")
    return align_columns(drifted, target, on_extra="drop")


def q_common_columns(spark, sf):
    a = snapshot(spark, sf, 0)
    b = read_table(spark, sf, "orders").select("o_orderdate", "o_totalprice", KEY, "o_custkey")
    return b.select(*common_columns(a, b))


def q_content_hash(spark, sf):
    s = snapshot(spark, sf, 4)
    return s.select(KEY, content_hash(content_fields(s, [KEY])).alias("content_hash"))


def q_key_problems(spark, sf):
    k = F.col(KEY)
    stacked = snapshot(spark, sf, 2).unionByName(snapshot(spark, sf, 3))
    return key_problems(stacked.withColumn(KEY, F.when(k % 13 == 0, F.lit(None)).otherwise(k)), KEY)


# -- replay (A03, A05-A08, F13, F14, G06) -----------------------------------------
def q_apply_changes(spark, sf):
    return apply_changes(snapshot(spark, sf, 2), _diff(spark, sf, 2, 3), KEY)


def q_backfill_change_log(spark, sf):
    return flatten_changes(_log(spark, sf), KEY)


def q_changelog_stats(spark, sf):
    return changelog_stats(_log(spark, sf))


def q_changes_after(spark, sf):
    return flatten_changes(_log(spark, sf).filter(F.col("day") > F.lit(day_of(2))), KEY)


def q_changes_by_op(spark, sf):
    return flatten_changes(_log(spark, sf).filter(F.col("op") == DELETE), KEY)


def q_asof_forward(spark, sf):
    return as_of(_log(spark, sf), day_of(2), KEY)


def q_asof_from_base(spark, sf):
    return as_of(_log(spark, sf), day_of(3), KEY, base=snapshot(spark, sf, 1), base_day=day_of(1))


def q_asof_reverse(spark, sf):
    return undo_to(snapshot(spark, sf, 4), _log(spark, sf), day_of(1), KEY)


def q_asof_last_day(spark, sf):
    return undo_to(snapshot(spark, sf, 4), _log(spark, sf), day_of(4), KEY)


# -- compare (C01-C03, G05, J03, J04, F15) ----------------------------------------
def _compare_class(change: str) -> Query:
    def q(spark, sf):
        return compare_rows(snapshot(spark, sf, 0), snapshot(spark, sf, 4), KEY, change)

    return q


def _sample_class(change: str) -> Query:
    def q(spark, sf):
        return sample_rows(compare_rows(snapshot(spark, sf, 0), snapshot(spark, sf, 4), KEY, change), KEY, 5)

    return q


def q_compare_summary(spark, sf):
    return compare_summary(snapshot(spark, sf, 0), snapshot(spark, sf, 4), KEY)


def q_compare_samples(spark, sf):
    return compare_samples(snapshot(spark, sf, 0), snapshot(spark, sf, 4), KEY, 5)


# -- report (R01-R06, G01, G02, T01-T03) ------------------------------------------
def q_snapshot_count(spark, sf):
    return total_rows(snapshot(spark, sf, 4))


def q_group_count(spark, sf):
    return group_count(snapshot(spark, sf, 3), "o_orderpriority")


def q_top20_by_nation(spark, sf):
    return top_n(read_table(spark, sf, "customer"), "c_nationkey", 20)


def q_top10_by_brand(spark, sf):
    return top_n(read_table(spark, sf, "part"), "p_brand", 10)


def q_top10_by_source(spark, sf):
    return top_n(read_table(spark, sf, "documents"), "source", 10)


def q_sample_snapshot(spark, sf):
    return sample_rows(snapshot(spark, sf, 4), KEY, 5)


def q_schema_listing(spark, sf):
    return schema_of(snapshot(spark, sf, 4))


# -- sources / sinks / store (S01-S06, K01-K03, A04) --------------------------------
def q_csv_roundtrip(spark, sf):
    s = snapshot(spark, sf, 3)
    path = scratch_path(spark, "csv")
    io.write_dump_csv(s, path)
    return io.read_dump_csv(spark, path, s.schema, key=KEY)


def q_snapshot_roundtrip(spark, sf):
    s = snapshot(spark, sf, 4)
    path = io.day_dir(scratch_path(spark, "snapshot"), day_of(4))
    io.write_parquet(s, path)
    return io.read_parquet(spark, path, s.schema)


def q_changelog_roundtrip(spark, sf):
    root = scratch_path(spark, "changes")
    io.write_change_days(_log(spark, sf), root)
    schema = change_log_schema(snapshot(spark, sf, 0), KEY)
    return flatten_changes(io.read_change_log(spark, root, schema, after=day_of(1)), KEY)


def q_asof_roundtrip(spark, sf):
    root = scratch_path(spark, "changes")
    io.write_change_days(_log(spark, sf), root)
    schema = change_log_schema(snapshot(spark, sf, 0), KEY)
    out = scratch_path(spark, "asof")
    io.write_parquet(as_of(io.read_change_log(spark, root, schema, until=day_of(3)), day_of(3), KEY), out)
    return io.read_parquet(spark, out)


def q_integrate_days(spark, sf):
    store = Store(spark, scratch_path(spark, "store"), KEY)
    for d, dump in snapshots(spark, sf):
        store.integrate(dump, d)
    return flatten_changes(store.read_log(), KEY)


def q_store_bucketed(spark, sf):
    """A04 with bucketed snapshot versions: diffs and key checks without shuffle."""
    store = Store(spark, scratch_path(spark, "store"), KEY, buckets=8)
    for d, dump in snapshots(spark, sf):
        store.integrate(dump, d)
    return flatten_changes(store.read_log(), KEY)


def q_store_backfill(spark, sf):
    store = Store(spark, scratch_path(spark, "store"), KEY)
    store.backfill(snapshots(spark, sf), chunk_days=2)
    return flatten_changes(store.read_log(), KEY)


def q_store_as_of(spark, sf):
    store = Store(spark, scratch_path(spark, "store"), KEY, keep_snapshot_every=7)
    for d, dump in snapshots(spark, sf):
        store.integrate(dump, d)
    return store.as_of(day_of(2))


# -- a wide table: whole long texts through the digest strategy --------------------
def _documents_diff(spark, sf, strategy: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return snapshot_diff(document_day(docs, 0), document_day(docs, 1), DOC_KEY, day_of(1), strategy=strategy)


def q_documents_change_log(spark, sf):
    return flatten_changes(_documents_diff(spark, sf, "hash"), DOC_KEY)


def q_documents_change_counts(spark, sf):
    return change_counts(_documents_diff(spark, sf, "struct"))


QUERIES: dict[str, Query] = {
    "change_counts": q_change_counts,
    "first_load": q_first_load,
    "diff_inserts": q_diff_inserts,
    "diff_updates": q_diff_updates,
    "diff_deletes": q_diff_deletes,
    "change_log_day": q_change_log_day,
    "change_log_day_hash": q_change_log_day_hash,
    "full_outer_classify": q_full_outer_classify,
    "changed_keys": q_changed_keys,
    "anti_changed_keys": q_anti_changed_keys,
    "rename_key": q_rename_key,
    "align_columns": q_align_columns,
    "common_columns": q_common_columns,
    "content_hash": q_content_hash,
    "key_problems": q_key_problems,
    "apply_changes": q_apply_changes,
    "backfill_change_log": q_backfill_change_log,
    "changelog_stats": q_changelog_stats,
    "changes_after": q_changes_after,
    "changes_by_op": q_changes_by_op,
    "asof_forward": q_asof_forward,
    "asof_from_base": q_asof_from_base,
    "asof_reverse": q_asof_reverse,
    "asof_last_day": q_asof_last_day,
    "compare_removed": _compare_class("REMOVED"),
    "compare_added": _compare_class("ADDED"),
    "compare_modified": _compare_class("MODIFIED"),
    "compare_unchanged": _compare_class("UNCHANGED"),
    "compare_summary": q_compare_summary,
    "compare_samples": q_compare_samples,
    "sample_removed": _sample_class("REMOVED"),
    "sample_added": _sample_class("ADDED"),
    "sample_modified": _sample_class("MODIFIED"),
    "snapshot_count": q_snapshot_count,
    "group_count": q_group_count,
    "top20_by_nation": q_top20_by_nation,
    "top10_by_brand": q_top10_by_brand,
    "top10_by_source": q_top10_by_source,
    "sample_snapshot": q_sample_snapshot,
    "schema_listing": q_schema_listing,
    "csv_roundtrip": q_csv_roundtrip,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "changelog_roundtrip": q_changelog_roundtrip,
    "asof_roundtrip": q_asof_roundtrip,
    "integrate_days": q_integrate_days,
    "store_as_of": q_store_as_of,
    "store_backfill": q_store_backfill,
    "store_bucketed": q_store_bucketed,
    "documents_change_log": q_documents_change_log,
    "documents_change_counts": q_documents_change_counts,
}
