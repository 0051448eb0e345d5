"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Two-valued boolean: null -> false (``CASE WHEN cond THEN true ELSE false END``)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def count_true(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as a non-null bigint."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def ratio(num, den) -> Column:
    """Double ratio, null when the denominator is 0 or null (ANSI-safe, no error)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def coalesce_present(df: DataFrame, candidates: Iterable, type_name: str | None = None) -> Column:
    """``coalesce`` over the candidates that exist.

    A candidate is a column name (used if present in ``df.columns``) or a Column
    expression (always used). Returns a typed null if nothing is present.
    """
    present = set(df.columns)
    cols = []
    for c in candidates:
        if isinstance(c, str):
            if c in present:
                cols.append(F.col(c).cast(type_name) if type_name else F.col(c))
        else:
            cols.append(c.cast(type_name) if type_name else c)
    if not cols:
        return null_of(type_name or "string")
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def require_columns(df: DataFrame, expected: Iterable[str], name: str) -> None:
    """Driver-side schema check before any job runs; raises with the sorted missing list."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns in {name}: {missing}")


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (stable value hashes across engines)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
