"""Time to event with censoring: product-limit curves per arm and log-rank tests against control.

Units are reduced to counts by (experiment, arm, whole time steps) with a partial aggregation in every task; the
risk sets are running windows over those distinct times, never over units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.stats import chi2_upper_tail
from abx.functions.time import epoch_micros
from abx.functions.util import ratio
from abx.operators.asof import first_match_after

STEP_SECONDS = 3600
ARM = ("experiment_id", "variant_id")


def time_to_event(
    anchors: DataFrame, events: DataFrame, observed_until: Column, step_seconds: int = STEP_SECONDS
) -> DataFrame:
    """One row a unit: its whole steps from the anchor to its first event at or after it (``is_event``), or to
    ``observed_until`` if none came by then (censored). Units anchored later than that, or never, are not observed.
    """
    matched = first_match_after(anchors, events)
    until = observed_until.cast("timestamp_ntz")
    is_event = F.coalesce(F.col("next_at") <= until, F.lit(False))
    end = F.when(is_event, F.col("next_at")).otherwise(until)
    micros = epoch_micros(end) - epoch_micros("anchor_at")
    return matched.filter(F.col("anchor_at") <= until).select(
        "experiment_id",
        "unit_id",
        "variant_id",
        F.floor(micros / F.lit(step_seconds * 1_000_000)).cast("long").alias("steps"),
        is_event.alias("is_event"),
    )


def event_table(times: DataFrame) -> DataFrame:
    """Events, censored and units at risk by arm and distinct time."""
    counts = times.groupBy(*ARM, "steps").agg(
        F.count_if("is_event").alias("events"), F.count_if(~F.col("is_event")).alias("censored")
    )
    onward = Window.partitionBy(*ARM).orderBy(F.col("steps").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("at_risk", F.sum(F.col("events") + F.col("censored")).over(onward))


def survival_curve(times: DataFrame) -> DataFrame:
    """Product-limit estimate at every distinct time of an arm: ``survival`` after the time's events, its Greenwood
    ``std_error`` (null once no unit survives) and the Nelson-Aalen ``cumulative_hazard``."""
    t = event_table(times)
    upto = Window.partitionBy(*ARM).orderBy("steps").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e, r = F.col("events").cast("double"), F.col("at_risk").cast("double")
    t = t.select(
        "*",
        F.product(F.lit(1.0) - e / r).over(upto).alias("survival"),
        F.sum(e / r).over(upto).alias("cumulative_hazard"),
        F.sum(F.coalesce(F.try_divide(e, r * (r - e)), F.lit(0.0))).over(upto).alias("_greenwood"),
        F.max(F.col("events") == F.col("at_risk")).over(upto).alias("_none_left"),
    )
    return t.select(
        *ARM,
        "steps",
        "at_risk",
        "events",
        "censored",
        "survival",
        F.when(~F.col("_none_left"), F.col("survival") * F.sqrt("_greenwood")).alias("std_error"),
        "cumulative_hazard",
    )


def survival_summary(times: DataFrame) -> DataFrame:
    """Per arm: units, events, the median time (first step with survival at most one half; null if not reached) and the
    survival at the last time."""
    c = survival_curve(times)
    return c.groupBy(*ARM).agg(
        F.max("at_risk").alias("n_units"),
        F.sum("events").alias("n_events"),
        F.min(F.when(F.col("survival") <= 0.5, F.col("steps"))).alias("median_steps"),
        F.max("steps").alias("last_steps"),
        F.min("survival").alias("last_survival"),
    )


def logrank_test(times: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Log-rank test of every other arm against control: observed and expected events of the arm, their variance under
    equal hazards, the chi-square with one degree of freedom, its p-value and the ratio of the arms' observed-to-expected.

    Each test sees the arm's and control's distinct times side by side, so a time at which only one of them has rows
    still counts the other's units at risk. An experiment without a control arm has no test.
    """
    counts = times.groupBy(*ARM, "steps").agg(F.count_if("is_event").alias("events"), F.count(F.lit(1)).alias("left"))
    control = F.col("variant_id") == F.lit(cfg.control_variant_id)
    others = counts.filter(~control).select(*ARM).distinct()
    base = counts.filter(control).drop("variant_id").join(others, "experiment_id")
    side = counts.filter(~control).select("*", F.lit(True).alias("own")).unionByName(base.withColumn("own", F.lit(False)))
    own = F.col("own")
    by_time = side.groupBy(*ARM, "steps").agg(
        F.sum(F.when(own, F.col("events")).otherwise(0)).alias("e1"),
        F.sum("events").alias("e"),
        F.sum(F.when(own, F.col("left")).otherwise(0)).alias("l1"),
        F.sum("left").alias("l"),
        F.max(~own).alias("has_control"),
    )
    onward = Window.partitionBy(*ARM).orderBy(F.col("steps").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = by_time.select("*", F.sum("l1").over(onward).alias("r1"), F.sum("l").over(onward).alias("r"))
    e, e1, r, r1 = (F.col(c).cast("double") for c in ("e", "e1", "r", "r1"))
    hypergeometric = F.try_divide(r1 * (r - r1) * e * (r - e), r * r * (r - 1.0))
    g = t.groupBy(*ARM).agg(
        F.max("has_control").alias("has_control"),
        F.sum("e1").alias("observed"),
        F.sum("e").alias("observed_both"),
        F.sum(r1 * e / r).alias("expected"),
        F.sum(F.coalesce(hypergeometric, F.lit(0.0))).alias("variance"),
    ).filter("has_control")
    diff = F.col("observed") - F.col("expected")
    expected_control = F.col("observed_both") - F.col("expected")
    g = g.withColumn("chi_square", F.try_divide(diff * diff, F.col("variance")))
    relative = ratio(F.col("observed") * expected_control, (F.col("observed_both") - F.col("observed")) * F.col("expected"))
    return g.select(
        *ARM,
        "observed",
        "expected",
        "variance",
        "chi_square",
        chi2_upper_tail(F.col("chi_square"), F.lit(1)).alias("p_value"),
        relative.alias("hazard_ratio"),
    )
