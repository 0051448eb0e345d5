"""Data contracts as DataFrames: every check yields rows ``(check, failing_rows)``; 0 = pass.

Checks over one table share one aggregation pass (``agg`` of several ``count_if``), so a report of
N column checks costs one scan of the table, not N.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.functions.time import minus_minutes
from abx.functions.util import require_columns

CHECK_SCHEMA = "check string, failing_rows bigint"


def contract_required_columns(df: DataFrame, expected: Iterable[str], name: str) -> None:
    """Driver-side schema check before any job starts; raises with the sorted missing list."""
    require_columns(df, expected, name)


def _unpivot(df: DataFrame, checks: list[tuple[str, "F.Column"]]) -> DataFrame:
    """One aggregation computing every check, then one row per check."""
    aliases = [f"_c{i}" for i in range(len(checks))]
    agg = df.agg(*[expr.alias(a) for a, (_, expr) in zip(aliases, checks)])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(a).cast("long").alias("failing_rows"))
            for a, (name, _) in zip(aliases, checks)
        ]
    )
    return agg.select(F.inline(rows))


def contract_not_null(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Rows with a null in each column, one aggregation for all columns."""
    return _unpivot(df, [(f"{name}.not_null.{c}", F.count_if(F.col(c).isNull())) for c in cols])


def contract_accepted_values(df: DataFrame, col: str, values: Sequence[str], name: str) -> DataFrame:
    """Non-null values outside the accepted set (a null passes, as in SQL ``NOT IN`` tests)."""
    n = f"{name}.accepted_values.{col}"
    return _unpivot(df, [(n, F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*values)))])


def contract_unique_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of key values held by more than one row (partial aggregation, then a count)."""
    n = f"{name}.unique.{'+'.join(keys)}"
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return _unpivot(per_key, [(n, F.count_if(F.col("_c") > 1))])


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The offending key values themselves (post-condition check; empty = pass)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") != 1)


def contract_not_too_early(
    df: DataFrame, assigned_col: str, exposure_col: str, grace_minutes: int, name: str
) -> DataFrame:
    """Rows whose exposure precedes ``assigned - grace`` (null exposure passes)."""
    n = f"{name}.not_too_early.{exposure_col}"
    cond = F.col(exposure_col).isNotNull() & (F.col(exposure_col) < minus_minutes(assigned_col, grace_minutes))
    return _unpivot(df, [(n, F.count_if(cond))])


def union_checks(checks: Iterable[DataFrame]) -> DataFrame:
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    return out
