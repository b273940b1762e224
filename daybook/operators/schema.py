"""Column-level operators: presence checks, content columns, alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bookkeeping columns of a change log. Content lives in its structs, so content
# columns may have these names; key columns may not.
LOG_COLUMNS = ("op", "before", "after", "day")


def as_keys(keys: str | Sequence[str]) -> list[str]:
    ks = [keys] if isinstance(keys, str) else list(keys)
    if not ks:
        raise ValueError("at least one key column is required")
    reserved = [k for k in ks if k in LOG_COLUMNS]
    if reserved:
        raise ValueError(f"key column(s) {reserved} have the names of change-log columns; rename them first")
    return ks


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "frame") -> None:
    """Raise ``ValueError`` naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; has {df.columns}")


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both, in ``b``'s order."""
    in_a = set(a.columns)
    return [c for c in b.columns if c in in_a]


def content_fields(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> list[T.StructField]:
    """All fields except the keys (and ``ignore``), in frame order."""
    skip = set(keys) | set(ignore)
    return [f for f in df.schema.fields if f.name not in skip]


def content_columns(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> list[str]:
    return [f.name for f in content_fields(df, keys, ignore)]


def nullable(dtype: T.DataType) -> T.DataType:
    """``dtype`` with every nested value nullable, as a file source reads it."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(nullable(dtype.keyType), nullable(dtype.valueType), True)
    return dtype


def align_columns(
    df: DataFrame,
    target: T.StructType | DataFrame,
    on_extra: str = "drop",
    cast: bool = False,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Give ``df`` exactly the target's columns, in the target's order.

    Missing columns become typed nulls. Extra columns are dropped
    (``on_extra="drop"``), appended (``"keep"``) or rejected (``"error"``).
    A column whose type differs raises unless ``cast=True``, which casts it to
    the target type. ``renames`` (``{old: new}``) gives columns of ``df`` the
    names of the target first, so that their values are kept. Everything happens
    in a single projection.
    """
    if renames:
        require_columns(df, list(renames), "frame")
        df = df.withColumnsRenamed(dict(renames))
        if len(set(df.columns)) < len(df.columns):
            raise ValueError(f"renames {dict(renames)} give two columns one name")
    schema = target.schema if isinstance(target, DataFrame) else target
    have = {f.name: f.dataType for f in df.schema.fields}
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if extra and on_extra == "error":
        raise ValueError(f"columns {extra} are not in the target schema")
    if on_extra not in ("drop", "keep", "error"):
        raise ValueError(f"on_extra must be drop, keep or error, not {on_extra!r}")
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif nullable(have[f.name]) != nullable(f.dataType):
            if not cast:
                raise TypeError(
                    f"column {f.name!r} is {have[f.name].simpleString()} here but "
                    f"{f.dataType.simpleString()} in the target; pass cast=True to convert"
                )
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    if on_extra == "keep":
        cols.extend(F.col(f"`{c}`") for c in extra)
    return df.select(*cols)


def schema_of(df: DataFrame) -> DataFrame:
    """The schema as rows (``position, column, type, nullable``)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    spark = df.sparkSession
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")
