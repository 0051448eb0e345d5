"""Every guard on rows that pass and rows that fail, the report and the gate."""

from __future__ import annotations

import pytest
from conftest import ts

from abx.operators import guardrails as G

ARMS = "experiment_id string, variant_id string, allocation_pct double"
UNITS = "experiment_id string, unit_id string, variant_id string"


@pytest.fixture(scope="module")
def arms(spark):
    return spark.createDataFrame([(e, v, 50.0) for e in ("good", "bad") for v in ("a", "b")], ARMS)


def units(spark, counts):
    rows = [(e, f"{v}{i}", v) for (e, v), n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, UNITS)


def by_experiment(df):
    return {r.experiment_id: r for r in df.collect()}


def test_assignment_unique(spark):
    df = spark.createDataFrame([("good", "u1", "a"), ("good", "u2", "a"), ("bad", "u1", "a"), ("bad", "u1", "b")], UNITS)
    got = by_experiment(G.guard_assignment_unique(df))
    assert got["good"].assignment_unique_passed and not got["bad"].assignment_unique_passed
    assert got["bad"].assignment_duplicates_count == 1


def test_srm_fails_on_shares_and_on_an_arm_that_is_not_planned(spark, arms):
    even = {("good", "a"): 50, ("good", "b"): 50}
    got = by_experiment(G.guard_srm(units(spark, {**even, ("bad", "a"): 80, ("bad", "b"): 20}), arms))
    assert got["good"].srm_passed and not got["bad"].srm_passed and got["good"].unplanned_arms == []
    got = by_experiment(G.guard_srm(units(spark, {**even, ("bad", "a"): 50, ("bad", "b"): 50, ("bad", "ghost"): 300}), arms))
    assert not got["bad"].srm_passed and got["bad"].unplanned_arms == ["ghost"] and got["bad"].total_units == 400
    empty = by_experiment(G.guard_srm(units(spark, {**even, ("bad", "a"): 50}), arms))
    assert not empty["bad"].srm_passed and empty["bad"].n_arms == 2


def test_exposure_and_outcome_order(spark):
    v = spark.createDataFrame(
        [("good", ts(), ts(1)), ("good", ts(), None), ("bad", ts(), ts(-1))],
        "experiment_id string, assigned_at timestamp_ntz, first_exposure_any_at timestamp_ntz",
    )
    got = by_experiment(G.guard_exposure_order(v))
    assert got["good"].exposure_order_passed and not got["bad"].exposure_order_passed
    o = spark.createDataFrame(
        [("good", ts(), ts()), ("good", ts(), None), ("bad", ts(), ts(-1))],
        "experiment_id string, anchor_at timestamp_ntz, converted_at timestamp_ntz",
    )
    got = by_experiment(G.guard_outcome_order(o, "anchor_at"))
    assert got["good"].outcome_order_passed and not got["bad"].outcome_order_passed


def test_outcome_grain_and_min_sample(spark, arms):
    o = spark.createDataFrame([("good", "u1"), ("good", "u2"), ("bad", "u1"), ("bad", "u1")], "experiment_id string, unit_id string")
    got = by_experiment(G.guard_outcome_grain(o))
    assert got["good"].outcome_grain_passed and got["bad"].duplicate_outcome_rows_count == 1
    got = by_experiment(G.guard_min_sample(units(spark, {("good", "a"): 40, ("good", "b"): 30, ("bad", "a"): 40, ("bad", "b"): 29}), arms))
    assert not got["good"].min_sample_warning and got["bad"].min_sample_warning


def test_report_names_failures_and_gate_keeps_the_rest(spark, arms):
    a = units(spark, {("good", "a"): 50, ("good", "b"): 50, ("bad", "a"): 90, ("bad", "b"): 10})
    v = spark.createDataFrame([("good", ts(), ts(1)), ("bad", ts(), ts(-1))], "experiment_id string, assigned_at timestamp_ntz, first_exposure_any_at timestamp_ntz")
    o = spark.createDataFrame([("good", "u1", ts(), ts(1)), ("bad", "u1", ts(), ts(1))], "experiment_id string, unit_id string, anchor_at timestamp_ntz, converted_at timestamp_ntz")
    report = G.experiment_quality_report(
        a.select("experiment_id").distinct(), G.guard_assignment_unique(a), G.guard_srm(a, arms), G.guard_exposure_order(v),
        G.guard_outcome_order(o, "anchor_at"), G.guard_outcome_grain(o), G.guard_min_sample(a, arms), "2024-01-02",
    )
    got = by_experiment(report)
    assert got["good"].is_valid_for_analysis and got["good"].failed_guardrails == [] and got["good"].warnings == []
    assert got["bad"].failed_guardrails == ["srm", "exposure_order"] and got["bad"].warnings == ["min_sample"]
    results = spark.createDataFrame([("good", 1), ("bad", 2)], "experiment_id string, x int")
    assert [tuple(r) for r in G.gated_results(results, report).collect()] == [("good", 1)]
