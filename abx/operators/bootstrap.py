"""Resampled intervals for per-unit values: Poisson bootstrap with weights hashed from unit and replicate.

A unit's weight in a replicate depends on nothing but the two, so a recomputed task, another partitioning or another
engine draws the same samples. Weighted sums are combined in every task: what is shuffled is one row an arm and replicate
a task, however many units there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.util import ratio

REPLICATES = 200
LEVEL = 0.95
# An md5 holds eight draws of four hexadecimal digits.
_DRAWS = 8
_DIGITS = 4
_RANGE = 16**_DIGITS


def poisson_cuts() -> list[int]:
    """Rising limits of a draw below 65,536: the weight is the number of limits at or below the draw (Poisson, mean 1)."""
    cuts, mass, total, k = [], math.exp(-1), 0.0, 0
    while True:
        total += mass
        cut = round(total * _RANGE)
        if cut >= _RANGE:
            return cuts
        cuts.append(cut)
        k += 1
        mass /= k


def _weight(draw: Column) -> Column:
    cuts = poisson_cuts()
    out = F.when(draw < cuts[0], F.lit(0))
    for weight, cut in enumerate(cuts[1:], 1):
        out = out.when(draw < cut, F.lit(weight))
    return out.otherwise(F.lit(len(cuts)))


def resampled_sums(units: DataFrame, value: str, per: str, replicates: int = REPLICATES, seed: str = "") -> DataFrame:
    """One row per experiment, arm and replicate: ``w_units``, ``w_value`` and ``w_per``, the weighted counts and sums.
    Replicate 0 has weight 1 for every unit: the sample itself. Null values count as 0, a null unit as the empty text."""
    if replicates < 2:
        raise ValueError("at least two replicates are needed")
    text = F.concat(F.coalesce(F.col("unit_id"), F.lit("")), F.lit(f":{seed}:"))
    base = units.select(
        "experiment_id",
        "variant_id",
        text.alias("_text"),
        F.coalesce(F.col(value), F.lit(0)).cast("decimal(28,10)").alias("_value"),
        F.coalesce(F.col(per), F.lit(0)).cast("decimal(28,10)").alias("_per"),
    )
    blocks = -(-replicates // _DRAWS)
    hashed = base.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "_h", F.md5(F.concat("_text", F.col("_block").cast("string")))
    )
    draws = hashed.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(_DRAWS - 1))))
    digits = F.col("_h").substr(F.col("_i") * _DIGITS + 1, F.lit(_DIGITS))
    drawn = draws.select(
        "experiment_id",
        "variant_id",
        (F.col("_block") * _DRAWS + F.col("_i") + 1).alias("replicate"),
        _weight(F.conv(digits, 16, 10).cast("int")).alias("_w"),
        "_value",
        "_per",
    ).filter(F.col("replicate") <= replicates)
    whole = base.select("experiment_id", "variant_id", F.lit(0).alias("replicate"), F.lit(1).alias("_w"), "_value", "_per")
    w = F.col("_w").cast("decimal(3,0)")
    return whole.unionByName(drawn).groupBy("experiment_id", "variant_id", "replicate").agg(
        F.sum(F.col("_w").cast("long")).alias("w_units"),
        F.sum(F.col("_value") * w).cast("decimal(38,10)").alias("w_value"),
        F.sum(F.col("_per") * w).cast("decimal(38,10)").alias("w_per"),
    )


def bootstrap_intervals(
    units: DataFrame,
    value: str = "revenue",
    per: str = "conversion_events",
    cfg: ExperimentConfig = DEFAULT,
    replicates: int = REPLICATES,
    level: float = LEVEL,
    seed: str = "",
) -> DataFrame:
    """Each arm but control: the difference to control of the mean of ``value`` a unit (``mean``) and of the ratio of sums
    ``value`` / ``per`` (``ratio``), with standard error and percentile interval over the replicates. A replicate in
    which an arm has no unit, or no ``per``, counts for neither (``n_replicates`` tells how many do). An experiment
    without control has nulls."""
    sums = resampled_sums(units, value, per, replicates, seed)
    stats = sums.select(
        "experiment_id", "variant_id", "replicate",
        F.inline(F.array(
            F.struct(F.lit("mean").alias("statistic"), ratio("w_value", "w_units").alias("_stat")),
            F.struct(F.lit("ratio").alias("statistic"), ratio("w_value", "w_per").alias("_stat")),
        )),
    )
    # One row an arm in each group: as many as an experiment has arms.
    w = Window.partitionBy("experiment_id", "replicate", "statistic")
    is_c = F.col("variant_id") == F.lit(cfg.control_variant_id)
    diffs = stats.withColumn("_control", F.max(F.when(is_c, F.col("_stat"))).over(w)).filter(~is_c)
    diff = F.col("_stat") - F.col("_control")
    sample, drawn = F.col("replicate") == 0, F.when(F.col("replicate") > 0, diff)
    tail = (1 - level) / 2
    return diffs.groupBy("experiment_id", "variant_id", "statistic").agg(
        F.max(F.when(sample, F.col("_control"))).alias("control"),
        F.max(F.when(sample, F.col("_stat"))).alias("treatment"),
        F.max(F.when(sample, diff)).alias("diff"),
        F.stddev_samp(drawn).alias("std_error"),
        F.percentile(drawn, F.lit(tail)).alias("ci_low"),
        F.percentile(drawn, F.lit(1 - tail)).alias("ci_high"),
        F.count(drawn).alias("n_replicates"),
    )
