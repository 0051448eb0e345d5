"""Quality totals of every grain in one pass, and stored sketches that merge over any window of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.functions.time import day_of
from abx.functions.util import count_true, ratio

GRAIN = ("experiment_id", "date_day", "assigned_variant_id")
ROLLUP_SETS = (
    ("experiment_id", "date_day", "assigned_variant_id"),
    ("experiment_id", "date_day"),
    ("experiment_id", "assigned_variant_id"),
    ("experiment_id",),
    ("date_day",),
    (),
)
# Sketch sizes: distinct counts within 1.04 / sqrt(2 ** 12) = 1.6 % (one standard error), quantiles within 1.4 % of rank.
HLL_LG_K = 12
THETA_LG_K = 12
KLL_K = 200
# Errors that a report allows: over three standard errors, and the rank error with its 99 % confidence rounded up.
UNITS_ERROR = 0.05
RANK_ERROR = 0.02


def quality_rollup(validation: DataFrame, sets: tuple[tuple[str, ...], ...] = ROLLUP_SETS) -> DataFrame:
    """Exposure quality by experiment, assignment day and assigned variant and all totals named in ``sets``, from one scan:
    rows are expanded once, counted in every task and shuffled as counts. ``grouping_level`` has a bit set for each of
    the three columns that a row is a total over (4, 2, 1), so a null key and a total stay apart."""
    v = validation.withColumn("date_day", day_of("assigned_at"))
    n = F.count(F.lit(1))
    g = v.groupingSets([list(s) for s in sets], *GRAIN).agg(
        F.grouping_id().cast("long").alias("grouping_level"),
        n.alias("assigned_units"),
        count_true(F.col("has_any_exposure")).alias("exposed_units"),
        count_true(F.col("has_valid_exposure")).alias("valid_exposed_units"),
        count_true(F.col("is_variant_mismatch")).alias("variant_mismatch_units"),
        count_true(F.col("has_multiple_variations_exposed")).alias("multi_variation_units"),
        count_true(F.col("is_pre_assignment_exposure")).alias("pre_assignment_units"),
        count_true(F.col("exposure_outside_window")).alias("outside_window_units"),
    )
    return g.select(
        "*",
        ratio("exposed_units", "assigned_units").alias("exposure_rate"),
        ratio("valid_exposed_units", "assigned_units").alias("valid_exposure_rate"),
        ratio("variant_mismatch_units", "exposed_units").alias("mismatch_rate"),
    )


def daily_sketches(validation: DataFrame) -> DataFrame:
    """One row an experiment and assignment day: sketches of its units (HLL for counts, theta for set operations) and of the
    exposure delays (KLL, seconds), to be stored and merged later without the events."""
    v = validation.withColumn("date_day", day_of("assigned_at"))
    delay = F.when(F.col("has_any_exposure"), F.col("exposure_delay_seconds")).cast("long")
    exposed = F.when(F.col("has_any_exposure"), F.col("unit_id"))
    return v.groupBy("experiment_id", "date_day").agg(
        F.hll_sketch_agg("unit_id", HLL_LG_K).alias("units_hll"),
        F.theta_sketch_agg("unit_id", THETA_LG_K).alias("units_theta"),
        F.theta_sketch_agg(exposed, THETA_LG_K).alias("exposed_theta"),
        F.kll_sketch_agg_bigint(delay, KLL_K).alias("delays_kll"),
        F.count(delay).alias("n_delays"),
    )


def merged_sketches(daily: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Per experiment over the days from ``first`` to ``last`` (both included, open if not given): estimated distinct units,
    units that were assigned but not exposed (theta difference), and the delay's quartiles."""
    if first is not None:
        daily = daily.filter(F.col("date_day") >= first)
    if last is not None:
        daily = daily.filter(F.col("date_day") <= last)
    m = daily.groupBy("experiment_id").agg(
        F.hll_sketch_estimate(F.hll_union_agg("units_hll")).alias("units_estimate"),
        F.theta_union_agg("units_theta", THETA_LG_K).alias("_all"),
        F.theta_union_agg("exposed_theta", THETA_LG_K).alias("_exposed"),
        F.kll_merge_agg_bigint(F.when(F.col("n_delays") > 0, F.col("delays_kll")), KLL_K).alias("_delays"),
        F.sum("n_delays").alias("n_delays"),
    )
    some = F.col("n_delays") > 0
    return m.select(
        "experiment_id",
        "units_estimate",
        F.theta_sketch_estimate("_all").alias("theta_units_estimate"),
        F.theta_sketch_estimate(F.theta_difference("_all", "_exposed")).alias("unexposed_estimate"),
        *[
            F.when(some, F.kll_sketch_get_quantile_bigint("_delays", F.lit(q))).alias(f"delay_p{round(100 * q)}")
            for q in (0.25, 0.5, 0.75)
        ],
        "n_delays",
    )


def sketch_accuracy(validation: DataFrame, daily: DataFrame) -> DataFrame:
    """The merged sketches of all days beside exact counts: per experiment the exact numbers, and whether each estimate is
    within its stated error (``UNITS_ERROR`` of the units, ``RANK_ERROR`` of a quantile's rank)."""
    exact = validation.groupBy("experiment_id").agg(
        F.count_distinct("unit_id").alias("exact_units"),
        F.count_distinct(F.when(~F.coalesce(F.col("has_any_exposure"), F.lit(False)), F.col("unit_id"))).alias("exact_unexposed"),
    )
    m = merged_sketches(daily)
    delays = validation.filter("has_any_exposure AND exposure_delay_seconds IS NOT NULL").select(
        F.col("experiment_id").alias("_e"), "exposure_delay_seconds"
    )
    quantiles = (("delay_p25", 0.25), ("delay_p50", 0.5), ("delay_p75", 0.75))
    joined = delays.join(m, F.col("_e") == F.col("experiment_id"))
    ranks = joined.groupBy(F.col("_e")).agg(
        *[F.avg((F.col("exposure_delay_seconds") < F.col(c)).cast("double")).alias(f"{c}_below") for c, _ in quantiles],
        *[F.avg((F.col("exposure_delay_seconds") <= F.col(c)).cast("double")).alias(f"{c}_upto") for c, _ in quantiles],
    )
    out = exact.join(m, "experiment_id").join(ranks, F.col("_e") == F.col("experiment_id"), "left")
    units = F.col("exact_units") * F.lit(UNITS_ERROR)
    right_rank = F.lit(True)
    for c, q in quantiles:
        inside = (F.col(f"{c}_below") <= q + RANK_ERROR) & (F.col(f"{c}_upto") >= q - RANK_ERROR)
        right_rank = right_rank & F.coalesce(inside, F.lit(True))
    return out.select(
        "experiment_id",
        "exact_units",
        "exact_unexposed",
        "n_delays",
        (F.abs(F.col("units_estimate") - F.col("exact_units")) <= units).alias("units_within"),
        (F.abs(F.col("theta_units_estimate") - F.col("exact_units")) <= units).alias("theta_within"),
        (F.abs(F.col("unexposed_estimate") - F.col("exact_unexposed")) <= units).alias("unexposed_within"),
        right_rank.alias("quantiles_within"),
    )
