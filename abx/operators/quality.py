"""Daily exposure-quality metrics (one aggregation pass over the validation table each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.time import day_of
from abx.functions.util import count_true, ratio


def _v(validation: DataFrame, extra_keys=()) -> DataFrame:
    return validation.withColumn("date_day", day_of("assigned_at"))


def quality_daily_counts(validation: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Batch-job counts by experiment x day of assignment (exposed = any exposure)."""
    v = _v(validation)
    return v.groupBy("experiment_id", "date_day", *extra_keys).agg(
        F.count(F.lit(1)).alias("assigned_units"),
        count_true(F.col("has_any_exposure")).alias("exposed_units"),
        count_true(F.col("has_valid_exposure")).alias("valid_exposed_units"),
        count_true(~F.col("has_any_exposure")).alias("missing_exposure_units"),
        count_true(F.col("is_variant_mismatch")).alias("variant_mismatch_units"),
        count_true(F.col("has_multiple_variations_exposed")).alias("multi_variation_units"),
        count_true(F.col("is_pre_assignment_exposure")).alias("pre_assignment_units"),
        count_true(F.col("exposure_outside_window")).alias("outside_window_units"),
        F.avg(F.when(F.col("has_any_exposure"), F.col("exposure_delay_seconds"))).alias(
            "avg_exposure_delay_seconds"
        ),
    )


def quality_daily(validation: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Counts plus 7 guarded ratios; ``mismatch_rate`` is over *exposed* units."""
    d = quality_daily_counts(validation, extra_keys)
    return d.select(
        "*",
        ratio("exposed_units", "assigned_units").alias("exposure_rate"),
        ratio("valid_exposed_units", "assigned_units").alias("valid_exposure_rate"),
        ratio("variant_mismatch_units", "exposed_units").alias("mismatch_rate"),
        ratio("missing_exposure_units", "assigned_units").alias("percent_missing_exposure"),
        ratio("multi_variation_units", "assigned_units").alias("percent_multiple_exposures"),
        ratio("pre_assignment_units", "assigned_units").alias("pre_assignment_rate"),
        ratio("outside_window_units", "assigned_units").alias("outside_window_rate"),
    )


def quality_daily_post(validation: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Warehouse variant: exposed = post-assignment exposure; ``variant_mismatch_rate`` is over
    *assigned* units; average delay over units with any exposure."""
    v = _v(validation)
    a = F.count(F.lit(1))
    return v.groupBy("experiment_id", "date_day", *extra_keys).agg(
        a.alias("assigned_units"),
        count_true(F.col("has_post_assignment_exposure")).alias("exposed_units"),
        count_true(F.col("has_valid_exposure")).alias("valid_exposed_units"),
        ratio(count_true(F.col("has_post_assignment_exposure")), a).alias("exposure_rate"),
        ratio(count_true(F.col("has_valid_exposure")), a).alias("valid_exposure_rate"),
        ratio(count_true(F.col("is_variant_mismatch")), a).alias("variant_mismatch_rate"),
        ratio(count_true(F.col("has_multiple_variations_exposed")), a).alias("multi_variation_rate"),
        ratio(count_true(F.col("is_pre_assignment_exposure")), a).alias("pre_assignment_rate"),
        ratio(count_true(F.col("exposure_outside_window")), a).alias("outside_window_rate"),
        F.avg(F.when(F.col("has_any_exposure"), F.col("exposure_delay_seconds"))).alias(
            "avg_exposure_delay_seconds"
        ),
    )


def exposure_audit(validation: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """BI audit lens per experiment x day with an exposure-health band."""
    v = _v(validation)
    a = F.count(F.lit(1))
    post = count_true(F.col("has_post_assignment_exposure"))
    d = v.groupBy("experiment_id", "date_day").agg(
        a.alias("assigned_units"),
        post.alias("exposed_units"),
        count_true(F.col("has_valid_exposure")).alias("valid_exposed_units"),
        ratio(post, a).alias("exposure_rate"),
        ratio(count_true(F.col("has_valid_exposure")), a).alias("valid_exposure_rate"),
        count_true(F.col("is_variant_mismatch")).alias("mismatch_units"),
        count_true(F.col("has_multiple_variations_exposed")).alias("multi_variation_units"),
        count_true(F.col("is_pre_assignment_exposure")).alias("pre_assignment_units"),
        count_true(F.col("exposure_outside_window")).alias("outside_window_units"),
        F.avg(F.when(F.col("has_post_assignment_exposure"), F.col("exposure_delay_seconds"))).alias(
            "avg_exposure_delay_seconds"
        ),
    )
    health = (
        F.when(F.col("exposure_rate") < F.lit(cfg.health_critical_below), F.lit("critical"))
        .when(F.col("exposure_rate") < F.lit(cfg.health_warning_below), F.lit("warning"))
        .otherwise(F.lit("ok"))
    )
    return d.withColumn("exposure_health", health)


def quality_daily_by_variant(validation: DataFrame) -> DataFrame:
    """Daily quality with the assigned variant added to the grain."""
    return quality_daily(validation, extra_keys=("assigned_variant_id",))


def quality_anomalies(
    daily: DataFrame,
    metrics: tuple[str, ...] = ("exposure_rate",),
    trailing_days: int = 7,
    threshold: float = 0.1,
) -> DataFrame:
    """Day-over-day and trailing-mean change of daily rates by calendar day.

    ``prev_rate`` is the rate of exactly one day earlier (null if that day has none) and the trailing
    mean covers the days of the ``trailing_days`` before; either change above ``threshold`` is an
    anomaly. One row per experiment, day and metric. Runs on the small post-aggregate daily table.
    """
    rates = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("rate")) for m in metrics])
    long = daily.select("experiment_id", "date_day", F.inline(rates))
    w = Window.partitionBy("experiment_id", "metric").orderBy(F.unix_date("date_day"))
    dod = F.col("rate") - F.col("prev_rate")
    vs_trail = F.col("rate") - F.col("trailing_avg_rate")
    out = long.select(
        "*",
        F.max("rate").over(w.rangeBetween(-1, -1)).alias("prev_rate"),
        F.avg("rate").over(w.rangeBetween(-trailing_days, -1)).alias("trailing_avg_rate"),
    )
    return out.select(
        "*",
        dod.alias("day_over_day_change"),
        vs_trail.alias("change_vs_trailing"),
        F.coalesce(F.greatest(F.abs(vs_trail), F.abs(dod)) > F.lit(threshold), F.lit(False)).alias("is_anomaly"),
    )
