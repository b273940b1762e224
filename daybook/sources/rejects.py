"""CSV dumps with bad rows: one read split into the rows that fit the schema and the rest.

Records are lines, as in :func:`~daybook.sources.io.read_dump_csv`. A line fits
if it has the schema's number of columns and every value can be read as its
column's type; such rows are what the strict read would give. Every other line
is a *reject*: its file, its raw text and what is wrong, column by column. The
header of each file is checked against the schema by Spark; it must be written
without quotes. Which lines are rejects doesn't depend on the columns that a
query reads, as every line is parsed whole.

Defined cases: empty lines are no rows; an empty value is null and fits any
column; a reject's values are never used, also those that could be read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import normalize_key
from ..operators.schema import nullable

#: Separates nothing: each line is read as one value.
_NONE = "\u0001"


class TooManyRejects(ValueError):
    """More of a dump's lines don't fit its schema than is allowed."""


@dataclass(frozen=True)
class Split:
    """``accepted``: the rows that fit. ``rejects``: ``file, raw, reasons ARRAY<STRUCT<column, value, type>>``
    (``column`` is null where the number of columns is wrong)."""

    accepted: DataFrame
    rejects: DataFrame
    lines: DataFrame

    def counts(self) -> DataFrame:
        """One row: ``rows`` and ``rejected``, in one pass over the lines."""
        return self.lines.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_rejected").alias("rejected"))

    def require(self, share: float) -> tuple[int, int]:
        """``(rows, rejected)``; raises if over ``share`` of the lines are rejects."""
        rows, rejected = self.counts().first()
        if rejected > share * rows:
            raise TooManyRejects(f"{rejected} of {rows} lines don't fit the schema; at most a share of {share} may")
        return rows, rejected


def split_dump_csv(
    spark: SparkSession, path: str, schema: T.StructType, key: str | None = None, key_aliases=("id",), sep: str = ","
) -> Split:
    """S01 for dumps that may hold bad rows."""
    names = [f.name for f in schema.fields]
    whole = T.StructType([T.StructField(sep.join(names), T.StringType()), T.StructField("_line", T.StringType())])
    raw = (
        spark.read.schema(whole).option("header", True).option("enforceSchema", False).option("sep", _NONE).option("quote", "")
        .option("columnPruning", False).option("columnNameOfCorruptRecord", "_line").option("encoding", "UTF-8").csv(path)
    )
    # a line that holds the separator character itself comes as a corrupt record, whole
    raw = raw.select(F.coalesce(F.col("_line"), F.col(f"`{whole[0].name}`")).alias("_raw"), F.col("_metadata.file_path").alias("_file"))
    # columns by place, so that names can't clash with these here
    places = [T.StructField(f"c{i}", nullable(f.dataType)) for i, f in enumerate(schema.fields)]
    typed = T.StructType([*places, T.StructField("bad", T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    # through a generator: the line is parsed once, not in the filter and again in the projection
    lines = raw.select("_raw", "_file", F.explode(F.array(F.from_csv("_raw", typed.simpleString()[7:-1].replace(":", " "), options))).alias("_row"))
    lines = lines.withColumn("_rejected", F.col("_row.bad").isNotNull())
    accepted = lines.where(~F.col("_rejected")).select(*[F.col(f"_row.c{i}").alias(n) for i, n in enumerate(names)])

    tokens = ", ".join(f"c{i} string" for i in range(len(names)))
    found = lines.where("_rejected").withColumn("_token", F.from_csv("_raw", tokens, {"sep": sep, "mode": "PERMISSIVE"}))
    wrong = [
        F.when(
            F.col(f"_row.c{i}").isNull() & F.col(f"_token.c{i}").isNotNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(f"_token.c{i}").alias("value"), F.lit(f.dataType.simpleString()).alias("type")),
        )
        for i, f in enumerate(schema.fields)
    ]
    width = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit(f"{len(names)} columns").alias("type"))
    reasons = F.array_compact(F.array(*wrong))
    rejects = found.select(F.col("_file").alias("file"), F.col("_raw").alias("raw"), F.when(F.size(reasons) > 0, reasons).otherwise(F.array(width)).alias("reasons"))
    return Split(normalize_key(accepted, key, key_aliases) if key else accepted, rejects, lines)
