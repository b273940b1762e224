"""Daily snapshots derived from the driver's ``orders`` table.

``snapshot_day(orders, d)`` is dump day ``d`` (``2025-01-01 + d``) of a table
keyed by ``o_orderkey``. Over days 0-4 it has late inserts, deletes, a delete
followed by a re-insert, a key updated on two days, value → null and their
combinations. ``snapshot_sql(d)`` is the same derivation as SQL text for the
DuckDB oracle; the two are written independently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "o_orderkey"
COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
FIRST_DAY = dt.date(2025, 1, 1)
N_DAYS = 5


def day_of(d: int) -> dt.date:
    return FIRST_DAY + dt.timedelta(days=d)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def snapshot_day(orders: DataFrame, d: int) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 5 == 0, F.concat(F.col("o_orderstatus"), F.lit(str(d // 2)))).otherwise(
        F.col("o_orderstatus")
    )
    priority = F.col("o_orderpriority")
    if d >= 3:
        priority = F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(priority)
    late_insert = (k % 10 == 1) & (F.lit(d) < 1 + F.floor(k / 10) % 4)
    deleted = (k % 7 == 0) & (F.lit(d) >= 2 + F.floor(k / 7) % 3)
    out_for_a_day = (k % 11 == 0) & F.lit(d == 2)
    return orders.filter(~late_insert & ~deleted & ~out_for_a_day).select(
        k, "o_custkey", status.alias("o_orderstatus"), "o_totalprice", priority.alias("o_orderpriority")
    )


def snapshot(spark: SparkSession, sf_dir: str, d: int) -> DataFrame:
    return snapshot_day(read_table(spark, sf_dir, "orders"), d)


def snapshots(spark: SparkSession, sf_dir: str, days=range(N_DAYS)) -> list[tuple[dt.date, DataFrame]]:
    orders = read_table(spark, sf_dir, "orders")
    return [(day_of(d), snapshot_day(orders, d)) for d in days]


def snapshot_sql(d: int) -> str:
    """SQL text of dump day ``d``; runs on both Spark SQL and DuckDB."""
    return f"""SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 5 = 0
            THEN concat(o_orderstatus, CAST(CAST(floor({d}/2) AS INT) AS VARCHAR(3)))
            ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice,
       CASE WHEN o_orderkey % 17 = 0 AND {d} >= 3 THEN NULL
            ELSE o_orderpriority END AS o_orderpriority
FROM orders
WHERE (o_orderkey % 10 <> 1 OR {d} >= 1 + CAST(floor(o_orderkey/10) AS BIGINT) % 4)
  AND (o_orderkey % 7 <> 0 OR {d} < 2 + CAST(floor(o_orderkey/7) AS BIGINT) % 3)
  AND NOT (o_orderkey % 11 = 0 AND {d} = 2)"""


# -- a wide table: documents (long texts), two dump days --------------------------
DOC_KEY = "doc_id"
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def document_day(documents: DataFrame, d: int) -> DataFrame:
    """Day 0: every document but the late ones (``doc_id % 89 = 0``).
    Day 1: late ones arrive, ``doc_id % 97 = 0`` are withdrawn and every
    50th text is revised (a suffix is appended; the whole text changes)."""
    k = F.col("doc_id")
    if d == 0:
        return documents.filter(k % 89 != 0).select(*DOC_COLUMNS)
    text = F.when(k % 50 == 0, F.concat(F.col("text"), F.lit(" [rev]"))).otherwise(F.col("text"))
    return documents.filter(k % 97 != 0).select("doc_id", text.alias("text"), "lang", "source", "n_chars")


def document_sql(d: int) -> str:
    if d == 0:
        return "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id % 89 <> 0"
    return """SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN concat(text, ' [rev]') ELSE text END AS text,
       lang, source, n_chars FROM documents WHERE doc_id % 97 <> 0"""
