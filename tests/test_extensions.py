"""Unit tests for assignment, quality-band, anomaly, power and spine operators on handmade rows."""

from __future__ import annotations

import math
from statistics import NormalDist

import pytest
from conftest import ts
from pyspark.sql import functions as F

from abx.operators import assign, quality
from abx.operators import extensions as X


def test_assign_variants_weighted_and_deterministic(spark):
    units = spark.range(20000).select(F.lit("x").alias("experiment_id"), F.col("id").cast("string").alias("unit_id"))
    variants = spark.createDataFrame([("x", "a", 80.0), ("x", "b", 20.0)],
                                     "experiment_id string, variant_id string, allocation_pct double")
    out = assign.assign_variants(units, variants)
    counts = {r.variant_id: r["count"] for r in out.groupBy("variant_id").count().collect()}
    assert sum(counts.values()) == 20000  # every unit gets exactly one variant
    assert abs(counts["a"] / 20000 - 0.8) < 0.02
    again = assign.assign_variants(units.repartition(7), variants)
    assert out.exceptAll(again).count() == 0
    salted = assign.assign_variants(units, variants, salt="s2")
    assert salted.join(out, ["experiment_id", "unit_id", "variant_id"]).count() < 20000


def test_tiny_arms_keep_their_share(spark):
    variants = spark.createDataFrame([("x", "a", 99.999), ("x", "b", 0.001), ("x", "c", 0.0)],
                                     "experiment_id string, variant_id string, allocation_pct double")
    units = spark.range(1_000_000).select(F.lit("x").alias("experiment_id"), F.col("id").cast("string").alias("unit_id"))
    got = {r.variant_id: r["count"] for r in assign.assign_variants(units, variants).groupBy("variant_id").count().collect()}
    assert sum(got.values()) == 1_000_000 and 1 <= got["b"] <= 30 and "c" not in got


def test_experiment_variants_template(spark):
    exps = spark.createDataFrame([("x",), ("y",)], "experiment_id string")
    rows = sorted(tuple(r) for r in assign.experiment_variants(exps).collect())
    assert rows == [("x", "control", "Control", 50.0, True), ("x", "treatment", "Treatment", 50.0, False),
                    ("y", "control", "Control", 50.0, True), ("y", "treatment", "Treatment", 50.0, False)]


def _validation_rows(spark, rows):
    schema = ("experiment_id string, unit_id string, assigned_at timestamp_ntz, has_post_assignment_exposure boolean, "
              "has_valid_exposure boolean, is_variant_mismatch boolean, has_multiple_variations_exposed boolean, "
              "is_pre_assignment_exposure boolean, exposure_outside_window boolean, exposure_delay_seconds bigint")
    return spark.createDataFrame(rows, schema)


def test_exposure_audit_health_bands(spark):
    rows = []
    for day, exposed in ((0, 6), (1, 8), (2, 10)):  # of 10 units per day: 60 %, 80 %, 100 %
        for i in range(10):
            e = i < exposed
            rows.append(("x", f"u{day}{i}", ts(days=day), e, e, False, False, False, False, 10 if e else None))
    got = {r.date_day.day: (r.exposure_rate, r.exposure_health)
           for r in quality.exposure_audit(_validation_rows(spark, rows)).collect()}
    assert got == {1: (0.6, "critical"), 2: (0.8, "warning"), 3: (1.0, "ok")}


def test_quality_anomalies_trailing_mean(spark):
    daily = spark.createDataFrame(
        [("x", ts(days=d).date(), r) for d, r in enumerate([0.9, 0.9, 0.9, 0.5, 0.9])],
        "experiment_id string, date_day date, exposure_rate double",
    )
    got = {r.date_day.day: r for r in quality.quality_anomalies(daily).collect()}
    assert got[1].prev_rate is None and got[1].is_anomaly is False
    assert got[4].trailing_avg_rate == pytest.approx(0.9) and got[4].is_anomaly is True
    assert got[5].day_over_day_change == pytest.approx(0.4) and got[5].is_anomaly is True


def test_quality_anomalies_over_missing_days(spark):
    """Days without rows are gaps: nothing is compared with a day that is not its neighbour."""
    daily = spark.createDataFrame(
        [("x", ts(days=d).date(), r, r / 10) for d, r in ((0, 0.9), (1, 0.9), (19, 0.2), (22, 0.9), (23, 0.9))],
        "experiment_id string, date_day date, exposure_rate double, mismatch_rate double",
    )
    rows = quality.quality_anomalies(daily, ("exposure_rate", "mismatch_rate")).collect()
    got = {r.date_day.day: r for r in rows if r.metric == "exposure_rate"}
    assert len(rows) == 10
    assert got[20].prev_rate is None and got[20].trailing_avg_rate is None and got[20].is_anomaly is False
    assert got[23].prev_rate is None and got[23].trailing_avg_rate == pytest.approx(0.2) and got[23].is_anomaly is True
    assert got[24].prev_rate == pytest.approx(0.9) and got[24].trailing_avg_rate == pytest.approx(0.55)


def test_power_mde_formula(spark):
    mbv = spark.createDataFrame(
        [("x", "m", "control", 1000, 0.1), ("x", "m", "treatment", 1000, 0.12)],
        "experiment_id string, metric_id string, variant_id string, n_users bigint, conversion_rate double",
    )
    (r,) = X.power_mde(mbv).collect()
    z = NormalDist().inv_cdf(0.975) + NormalDist().inv_cdf(0.8)
    expect = z * math.sqrt(0.1 * 0.9 * (2 / 1000))
    assert r.mde_abs == pytest.approx(expect) and r.mde_rel == pytest.approx(expect / 0.1)


def test_metric_spine_eligibility(spark):
    coh = spark.createDataFrame(
        [("x", "u1", "control", ts(), ts(60)), ("x", "u2", "treatment", ts(), None)],
        "experiment_id string, unit_id string, assigned_variant_id string, assigned_at timestamp_ntz, "
        "first_exposure_at timestamp_ntz",
    )
    got = {(r.unit_id, r.metric_id): r for r in X.metric_spine(coh).collect()}
    assert len(got) == 2 * len(X.DEFAULT_METRICS)
    assert got[("u1", "conversion_7d")].anchor_at == ts(60) and got[("u1", "conversion_7d")].is_eligible
    assert got[("u2", "conversion_7d")].is_eligible is False
    itt = got[("u2", "conversion_itt_7d")]
    assert itt.is_eligible and itt.window_end_at == ts(days=7)
