"""Equi-joins whose left side may hold one key in a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this, and more than one in MAX_HOT of all, is split.
ROWS_PER_TASK = 100_000
MAX_HOT = 10_000


def spread_join(
    big: DataFrame, small: DataFrame, on: str, how: str = "inner", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Join ``big`` with ``small`` (unique by ``on``) so that no key's rows end in one task.

    Keys are counted (combined in every task before the shuffle). Rows of a hot key are dealt over as many
    parts as it has shares of ``rows_per_task``, and its one row of ``small`` is repeated once a part. At most
    ``MAX_HOT`` keys can be hot, so their list is broadcast. ``big`` should be cheap to read twice.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    counts = big.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    total = F.lit(0) if rows_per_task <= 0 else big.select((F.count(F.lit(1)) / F.lit(MAX_HOT)).cast("long")).scalar()
    share = F.greatest(F.lit(max(1, rows_per_task)), total)
    hot = counts.filter(F.col("_n") > share).select(on, F.ceil(F.col("_n") / share).cast("int").alias("_parts"))
    dealt = big.join(F.broadcast(hot), on, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_parts")), F.lit(0)).cast("int")
    )
    repeated = small.join(F.broadcast(hot), on, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    )
    return dealt.drop("_parts").join(repeated.drop("_parts"), [on, "_part"], how).drop("_part")
