"""Independent SQL oracle (DuckDB) for the registered queries.

Written directly against the driver's tables with plain joins, ``IS DISTINCT
FROM`` and ``GROUP BY``; it shares nothing with the DataFrame code but the
snapshot fixture text. Output column names equal the DataFrame queries'.
"""

from __future__ import annotations

from .fixtures import N_DAYS, day_of, document_sql, snapshot_sql

KEY = "o_orderkey"
# Content columns of the derived snapshots and their SQL types (fixed values).
CONTENT = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
SQL_TYPES = {"o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderpriority": "VARCHAR"}


def snap(d: int) -> str:
    return f"({snapshot_sql(d)})"


def _date(d: int) -> str:
    return f"DATE '{day_of(d).isoformat()}'"


def _images(p: str | None, n: str | None) -> str:
    """before_* from side ``p`` and after_* from side ``n`` (None → typed null)."""
    cols = []
    for side, prefix in ((p, "before"), (n, "after")):
        for c in CONTENT:
            src = f"{side}.{c}" if side else f"CAST(NULL AS {SQL_TYPES[c]})"
            cols.append(f"{src} AS {prefix}_{c}")
    return ", ".join(cols)


def _changed(p: str, n: str) -> str:
    return " OR ".join([f"{p}.{KEY} IS NULL", f"{n}.{KEY} IS NULL"] + [f"{p}.{c} IS DISTINCT FROM {n}.{c}" for c in CONTENT])


def _op(p: str, n: str) -> str:
    return f"CASE WHEN {p}.{KEY} IS NULL THEN 'INSERT' WHEN {n}.{KEY} IS NULL THEN 'DELETE' ELSE 'UPDATE' END"


def diff(a: int, b: int) -> str:
    """Flattened change rows turning snapshot ``a`` into ``b`` (dated ``b``)."""
    return f"""SELECT coalesce(p.{KEY}, n.{KEY}) AS {KEY}, {_op('p', 'n')} AS op, {_images('p', 'n')}, {_date(b)} AS day
FROM {snap(a)} p FULL OUTER JOIN {snap(b)} n ON p.{KEY} = n.{KEY}
WHERE {_changed('p', 'n')}"""


# Content columns of the documents fixture and their SQL types (fixed values).
DOC_CONTENT = {"text": "VARCHAR", "lang": "VARCHAR", "source": "VARCHAR", "n_chars": "BIGINT"}


def documents_diff() -> str:
    """Flattened change rows from documents day 0 to day 1 (whole texts)."""
    imgs = ", ".join(
        [f"p.{c} AS before_{c}" for c in DOC_CONTENT] + [f"n.{c} AS after_{c}" for c in DOC_CONTENT]
    )
    changed = " OR ".join(["p.doc_id IS NULL", "n.doc_id IS NULL"] + [f"p.{c} IS DISTINCT FROM n.{c}" for c in DOC_CONTENT])
    return f"""SELECT coalesce(p.doc_id, n.doc_id) AS doc_id,
       CASE WHEN p.doc_id IS NULL THEN 'INSERT' WHEN n.doc_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op,
       {imgs}, {_date(1)} AS day
FROM ({document_sql(0)}) p FULL OUTER JOIN ({document_sql(1)}) n ON p.doc_id = n.doc_id
WHERE {changed}"""


def first_load(d: int) -> str:
    return f"SELECT n.{KEY} AS {KEY}, 'INSERT' AS op, {_images(None, 'n')}, {_date(d)} AS day FROM {snap(d)} n"


def full_log() -> str:
    parts = [first_load(0)] + [diff(d - 1, d) for d in range(1, N_DAYS)]
    return "\nUNION ALL\n".join(parts)


def _side(a: int, b: int, op: str, prefix: str) -> str:
    cols = ", ".join(f"{prefix}_{c} AS {c}" for c in CONTENT)
    return f"SELECT {KEY}, {cols}, op FROM ({diff(a, b)}) d WHERE op = '{op}'"


def _classes(a: int, b: int) -> str:
    """Per key of either dump: change class plus both sides' columns."""
    same = " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in CONTENT)
    cols = ", ".join(f"x.{c} AS a_{c}, y.{c} AS b_{c}" for c in CONTENT)
    return f"""SELECT coalesce(x.{KEY}, y.{KEY}) AS {KEY},
       CASE WHEN y.{KEY} IS NULL THEN 'REMOVED' WHEN x.{KEY} IS NULL THEN 'ADDED'
            WHEN {same} THEN 'UNCHANGED' ELSE 'MODIFIED' END AS change, {cols}
FROM {snap(a)} x FULL OUTER JOIN {snap(b)} y ON x.{KEY} = y.{KEY}"""


def _class_rows(change: str, a: int = 0, b: int = 4) -> str:
    side = "a" if change == "REMOVED" else "b"
    cols = ", ".join(f"{side}_{c} AS {c}" for c in CONTENT)
    return f"SELECT {KEY}, {cols} FROM ({_classes(a, b)}) c WHERE change = '{change}'"


def _sample(change: str) -> str:
    return f"SELECT * FROM ({_class_rows(change)}) s ORDER BY {KEY} LIMIT 5"


def _top(table: str, col: str, n: int) -> str:
    return (
        f"SELECT {col}, count(*) AS count FROM {table} GROUP BY {col} "
        f"ORDER BY count DESC, {col} ASC NULLS LAST LIMIT {n}"
    )


def _plain(d: int) -> str:
    return f"SELECT * FROM {snap(d)} s"


_CONTENT_JSON = ", ".join(f"{c} := {c}" for c in CONTENT)

ORACLE: dict[str, str] = {
    "change_counts": f"SELECT op, count(*) AS count FROM ({diff(2, 3)}) d GROUP BY op",
    "first_load": first_load(0),
    "diff_inserts": _side(2, 3, "INSERT", "after"),
    "diff_updates": _side(2, 3, "UPDATE", "after"),
    "diff_deletes": _side(2, 3, "DELETE", "before"),
    "change_log_day": diff(2, 3),
    "change_log_day_hash": diff(2, 3),
    "full_outer_classify": f"""SELECT coalesce(p.{KEY}, n.{KEY}) AS {KEY},
       CASE WHEN {_changed('p', 'n')} THEN {_op('p', 'n')} END AS op, {_images('p', 'n')}
FROM {snap(3)} p FULL OUTER JOIN {snap(4)} n ON p.{KEY} = n.{KEY}""",
    "changed_keys": f"SELECT DISTINCT {KEY} FROM ({diff(2, 3)}) d",
    "anti_changed_keys": f"SELECT * FROM {snap(2)} s WHERE {KEY} NOT IN (SELECT {KEY} FROM ({diff(2, 3)}) d)",
    "rename_key": f"SELECT {KEY}, o_custkey, o_totalprice FROM orders",
    "align_columns": f"""SELECT {KEY}, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
       CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders""",
    "common_columns": f"SELECT o_totalprice, {KEY}, o_custkey FROM orders",
    "content_hash": f"SELECT {KEY}, sha256(to_json(struct_pack({_CONTENT_JSON}))) AS content_hash FROM {snap(4)} s",
    "key_problems": f"""WITH k AS (
  SELECT CASE WHEN {KEY} % 13 = 0 THEN NULL ELSE {KEY} END AS k FROM {snap(2)} a
  UNION ALL
  SELECT CASE WHEN {KEY} % 13 = 0 THEN NULL ELSE {KEY} END AS k FROM {snap(3)} b)
SELECT (SELECT count(*) FROM k WHERE k IS NULL) AS null_keys,
       (SELECT count(*) FROM (SELECT k FROM k WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1) g) AS duplicate_keys""",
    "apply_changes": _plain(3),
    "backfill_change_log": full_log(),
    "changelog_stats": f"SELECT day, op, count(*) AS count FROM ({full_log()}) l GROUP BY day, op",
    "changes_after": f"SELECT * FROM ({full_log()}) l WHERE day > {_date(2)}",
    "changes_by_op": f"SELECT * FROM ({full_log()}) l WHERE op = 'DELETE'",
    "asof_forward": _plain(2),
    "asof_from_base": _plain(3),
    "asof_reverse": _plain(1),
    "asof_last_day": _plain(4),
    "compare_removed": _class_rows("REMOVED"),
    "compare_added": _class_rows("ADDED"),
    "compare_modified": _class_rows("MODIFIED"),
    "compare_unchanged": _class_rows("UNCHANGED"),
    "compare_summary": f"""WITH c AS ({_classes(0, 4)}),
n AS (SELECT count(*) FILTER (WHERE change = 'REMOVED') AS removed,
             count(*) FILTER (WHERE change = 'ADDED') AS added,
             count(*) FILTER (WHERE change = 'MODIFIED') AS modified,
             count(*) FILTER (WHERE change = 'UNCHANGED') AS unchanged FROM c)
SELECT removed + modified + unchanged AS rows_a, added + modified + unchanged AS rows_b,
       removed, added, modified, unchanged, removed + added + modified AS total_changes,
       CASE WHEN removed + modified + unchanged > 0
            THEN round(CAST(removed + added + modified AS DOUBLE) * 100.0
                       / CAST(removed + modified + unchanged AS DOUBLE), 2) END AS change_rate
FROM n""",
    "compare_samples": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS change, * FROM ({_sample(c)}) s{i}" for i, c in enumerate(("REMOVED", "ADDED", "MODIFIED"))
    ),
    "sample_removed": _sample("REMOVED"),
    "sample_added": _sample("ADDED"),
    "sample_modified": _sample("MODIFIED"),
    "snapshot_count": f"SELECT count(*) AS total_rows FROM {snap(4)} s",
    "group_count": f"SELECT o_orderpriority, count(*) AS count FROM {snap(3)} s GROUP BY o_orderpriority",
    "top20_by_nation": _top("customer", "c_nationkey", 20),
    "top10_by_brand": _top("part", "p_brand", 10),
    "top10_by_source": _top("documents", "source", 10),
    "sample_snapshot": f"SELECT * FROM {snap(4)} s ORDER BY {KEY} LIMIT 5",
    # DuckDB describes the same derived snapshot; its type names mapped to Spark's.
    "schema_listing": f"""SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS "column",
       CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type,
       "null" = 'YES' AS nullable
FROM (DESCRIBE SELECT * FROM {snap(4)} s)""",
    "csv_roundtrip": _plain(3),
    "snapshot_roundtrip": _plain(4),
    "changelog_roundtrip": f"SELECT * FROM ({full_log()}) l WHERE day > {_date(1)}",
    "asof_roundtrip": _plain(3),
    "integrate_days": full_log(),
    "store_as_of": _plain(2),
    "store_backfill": full_log(),
    "store_bucketed": full_log(),
    "documents_change_log": documents_diff(),
    "documents_change_counts": f"SELECT op, count(*) AS count FROM ({documents_diff()}) d GROUP BY op",
}
