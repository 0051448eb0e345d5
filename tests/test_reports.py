"""Smoke-report operators on handmade rows."""

from __future__ import annotations

import datetime as dt

from conftest import ts

from abx.operators import reports as R


def test_delay_histogram_edges(spark):
    rows = [("x", True, d) for d in (-5, 0, 3599, 3600, 86399, 86400, 90000)] + [("x", True, None), ("x", False, 10),
                                                                                ("y", True, 10)]
    v = spark.createDataFrame(rows, "experiment_id string, has_any_exposure boolean, exposure_delay_seconds bigint")
    got = {r.delay_bucket: r.n for r in R.delay_histogram(v, "x").collect()}
    assert got == {0: 1, 1: 2, 2: 1, 24: 1, 25: 2, None: 1}


def test_reconcile_counts(spark):
    a = spark.range(5).selectExpr("id AS unit_id")
    v = spark.range(3).selectExpr("id AS unit_id")
    (r,) = R.reconcile_counts(a, v).collect()
    assert (r.assignment_rows, r.validation_rows) == (5, 3)


def _daily(spark):
    rows = [("a", dt.date(2024, 1, d), 0.5, 0.01) for d in (20, 28, 30)] + [
        ("b", dt.date(2024, 1, 30), 0.9, 0.05), ("c", dt.date(2024, 1, 2), 0.1, 0.5)]
    return spark.createDataFrame(rows, "experiment_id string, date_day date, exposure_rate double, "
                                       "variant_mismatch_rate double")


def test_lowest_exposure_window_and_order(spark):
    got = [(r.experiment_id, round(r.avg_exposure_rate_7d, 6)) for r in
           R.lowest_exposure(_daily(spark), "2024-01-31", top=1).collect()]
    assert got == [("a", 0.5)]  # c is outside the 7-day window; b is higher


def test_mismatch_gate_having(spark):
    res = spark.createDataFrame([("a", "m", "t"), ("b", "m", "t"), ("b", "m", "c")],
                                "experiment_id string, metric_id string, variant_id string")
    got = {r.experiment_id: r.result_rows for r in R.mismatch_gate(_daily(spark), res, "2024-01-31").collect()}
    assert got == {"b": 2}  # a averages 0.01 (below 0.02); c is outside the window


def test_significant_uplift_filters_and_orders(spark):
    rows = [("x", "m", "t1", 0.05, 0.01, -0.1, 0.2), ("x", "m", "t2", 0.005, 0.001, 0.0, 0.01),
            ("x", "m", "t3", -0.2, 0.03, -0.3, -0.1), ("x", "m", "t4", 0.2, 0.2, -0.1, 0.5)]
    res = spark.createDataFrame(rows, "experiment_id string, metric_id string, variant_id string, uplift_abs double, "
                                      "p_value_two_sided double, ci_low double, ci_high double")
    got = [r.variant_id for r in R.significant_uplift(res).collect()]
    assert got == ["t1", "t3"]


def test_status_samples_per_status_limit(spark):
    rows = [("x", f"u{i:03d}", "variant_mismatch", ts()) for i in range(120)] + [
        ("x", f"p{i:03d}", "pre_assignment_exposure", ts()) for i in range(3)] + [("x", "v", "valid", ts())]
    v = spark.createDataFrame(rows, "experiment_id string, unit_id string, validation_status string, "
                                    "assigned_at timestamp_ntz")
    got = R.status_samples(v, n=50).collect()
    mism = sorted(r.unit_id for r in got if r.validation_status == "variant_mismatch")
    assert len(mism) == 50 and mism[0] == "u000" and mism[-1] == "u049"
    assert sum(r.validation_status == "pre_assignment_exposure" for r in got) == 3
