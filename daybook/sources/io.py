"""Sources and sinks.

Every read takes an explicit schema (no type drift between days, D11); only
the *absence* of a path is treated as "nothing there yet" -- any other read
error surfaces (D10). No writer ever targets a path it reads from (D7).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.dates import to_day
from ..operators.keys import normalize_key


def read_dump_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    key: str | None = None,
    key_aliases=("id",),
    sep: str = ",",
) -> DataFrame:
    """A daily CSV dump (header row). With a schema, header names are
    checked against it and malformed rows fail the read; ``schema=None``
    opts into inference (not recommended: codes like ``06`` drift to int)."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", False).option("mode", "FAILFAST")
    df = reader.csv(path)
    return normalize_key(df, key, key_aliases) if key else df


def write_dump_csv(df: DataFrame, path: str) -> None:
    """A dump as CSV with a header (used to produce dumps for S01)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet snapshot or dump folder."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty relation."""
    return spark.createDataFrame([], schema)


def is_missing_path(err: AnalysisException) -> bool:
    cond = err.getCondition() if hasattr(err, "getCondition") else err.getErrorClass()
    return cond == "PATH_NOT_FOUND"


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """``(frame, found)``; a missing path gives an empty typed frame."""
    try:
        return spark.read.schema(schema).parquet(path), True  # the listing runs here
    except AnalysisException as err:
        if is_missing_path(err):
            return empty_frame(spark, schema), False
        raise


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite one folder (never an input of ``df``)."""
    df.write.mode("overwrite").parquet(path)


def day_dir(root: str, day) -> str:
    return f"{root.rstrip('/')}/day={to_day(day).isoformat()}"


def write_change_day(changes: DataFrame, root: str, day) -> None:
    """K02, one day: overwrite exactly ``root/day=D`` (other days untouched;
    a day with no change becomes an empty day rather than a stale one)."""
    write_parquet(changes.drop("day"), day_dir(root, day))


def write_change_days(log: DataFrame, root: str) -> None:
    """K02, many days: dynamic partition overwrite replaces only the days
    present in ``log``. Rows are rebalanced by day first, so each day is
    written as few right-sized files (AQE splits a big day, merges small
    ones) rather than one file per task per day."""
    (
        log.hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(root)
    )


def read_change_log(
    spark: SparkSession, root: str, schema: T.StructType, after=None, until=None
) -> DataFrame:
    """The day-partitioned log read with its explicit schema; ``after``
    (exclusive) and ``until`` (inclusive) prune day folders."""
    from pyspark.sql import functions as F

    df, _ = read_optional(spark, root, schema)
    if after is not None:
        df = df.filter(F.col("day") > F.lit(to_day(after)))
    if until is not None:
        df = df.filter(F.col("day") <= F.lit(to_day(until)))
    return df
