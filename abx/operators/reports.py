"""Ad-hoc analyses over the published tables (the reference's smoke queries).

As-of dates and experiment ids are arguments (no ``current_date`` inside a query); every limit
has a total order in front of it, so the same rows come back on every run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.functions.util import count_true


def _since(as_of: str | _dt.date, days: int):
    return F.date_sub(F.to_date(F.lit(str(as_of))), int(days))


def reconcile_counts(assignments: DataFrame, validation: DataFrame) -> DataFrame:
    """Assignment rows against validation rows, in one row (one union scan, one aggregation)."""
    tagged = assignments.select(F.lit("a").alias("_t")).unionByName(validation.select(F.lit("v").alias("_t")))
    return tagged.agg(
        count_true(F.col("_t") == "a").alias("assignment_rows"),
        count_true(F.col("_t") == "v").alias("validation_rows"),
    )


def lowest_exposure(daily: DataFrame, as_of: str, days: int = 7, top: int = 10) -> DataFrame:
    """Experiments with the lowest average exposure rate over the trailing window (top-k)."""
    d = daily.filter(F.col("date_day") >= _since(as_of, days))
    g = d.groupBy("experiment_id").agg(F.avg("exposure_rate").alias("avg_exposure_rate_7d"))
    return g.orderBy(F.col("avg_exposure_rate_7d").asc_nulls_last(), "experiment_id").limit(top)


def status_samples(validation: DataFrame, statuses=("variant_mismatch", "pre_assignment_exposure"), n: int = 50):
    """Up to ``n`` example rows per status, first by key.

    One pass: ``row_number() <= n`` per status plans a partial WindowGroupLimit, so each map task
    forwards at most ``n`` rows per status and a status holding most rows stays cheap.
    """
    w = Window.partitionBy("validation_status").orderBy("experiment_id", "unit_id")
    v = validation.filter(F.col("validation_status").isin(*statuses))
    return v.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def delay_histogram(validation: DataFrame, experiment_id: str, lo: int = 0, hi: int = 86400, buckets: int = 24):
    """Counts of exposure delay in equal-width buckets (below -> 0, at/above ``hi`` -> buckets+1)."""
    v = validation.filter((F.col("experiment_id") == F.lit(experiment_id)) & (F.col("has_any_exposure") == F.lit(True)))
    b = F.width_bucket(F.col("exposure_delay_seconds"), F.lit(lo), F.lit(hi), F.lit(buckets))
    return v.groupBy(b.alias("delay_bucket")).agg(F.count(F.lit(1)).alias("n"))


def recent_results(results: DataFrame, experiment_id: str, n: int = 50) -> DataFrame:
    cols = ["experiment_id", "metric_id", "variant_id", "n_users", "conversion_rate", "uplift_abs", "p_value_two_sided"]
    order = [F.col("computed_at").desc()] if "computed_at" in results.columns else []
    if "computed_at" in results.columns:
        cols.append("computed_at")
    r = results.filter(F.col("experiment_id") == F.lit(experiment_id)).select(*cols)
    return r.orderBy(*order, "metric_id", "variant_id").limit(n)


def exposure_vs_results(daily: DataFrame, results: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Trailing exposure rate per experiment, left-joined to result availability."""
    e = daily.filter(F.col("date_day") >= _since(as_of, days))
    ea = e.groupBy("experiment_id").agg(F.avg("exposure_rate").alias("avg_exposure_rate_7d"))
    aggs = [F.count(F.lit(1)).alias("result_rows")]
    if "computed_at" in results.columns:
        aggs.append(F.max("computed_at").alias("last_results_at"))
    r = results.groupBy("experiment_id").agg(*aggs)
    return ea.join(r, "experiment_id", "left")


def significant_uplift(results: DataFrame, alpha: float = 0.05, min_abs_uplift: float = 0.01, n: int = 50):
    r = results.filter((F.col("p_value_two_sided") < F.lit(alpha)) & (F.abs("uplift_abs") > F.lit(min_abs_uplift)))
    return r.select(
        "experiment_id", "metric_id", "variant_id", "uplift_abs", "p_value_two_sided", "ci_low", "ci_high"
    ).orderBy("p_value_two_sided", "experiment_id", "metric_id", "variant_id").limit(n)


def mismatch_gate(daily_post: DataFrame, results: DataFrame, as_of: str, days: int = 7, threshold: float = 0.02):
    """Experiments whose trailing mismatch rate exceeds ``threshold`` while results exist."""
    m = daily_post.filter(F.col("date_day") >= _since(as_of, days))
    ma = m.groupBy("experiment_id").agg(F.avg("variant_mismatch_rate").alias("avg_mismatch_rate_7d"))
    ma = ma.filter(F.col("avg_mismatch_rate_7d") > F.lit(threshold))
    r = results.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("result_rows"))
    return ma.join(r, "experiment_id", "inner")


def exposure_health_report(daily: DataFrame, experiment_id: str) -> DataFrame:
    return (
        daily.filter(F.col("experiment_id") == F.lit(experiment_id))
        .select("experiment_id", "date_day", "exposure_rate", "valid_exposure_rate", "mismatch_rate")
        .orderBy("date_day")
    )
