"""Golden three-unit scenario (FIXTURES.md §2): expected values computed from the formulas."""

from __future__ import annotations

import pytest
from conftest import ASSIGN_SCHEMA, CONVERSION_SCHEMA, EXPOSURE_SCHEMA, ts

from abx.operators import cohort, exposure, outcomes, quality, results


@pytest.fixture(scope="module")
def golden(spark):
    a = spark.createDataFrame(
        [("exp_demo", "u1", "control", ts()), ("exp_demo", "u2", "treatment", ts()), ("exp_demo", "u3", "control", ts())],
        ASSIGN_SCHEMA,
    )
    e = spark.createDataFrame(
        [("e1", "exp_demo", "u1", "control", ts(120), None), ("e2", "exp_demo", "u2", "treatment", ts(60), None)],
        EXPOSURE_SCHEMA,
    )
    c = spark.createDataFrame([("p1", "u1", ts(days=1), 10.0), ("p2", "u2", ts(days=2), 20.0)], CONVERSION_SCHEMA)
    v = exposure.validate_exposures(a, exposure.dedupe_exposures(e))
    coh = cohort.cohort(v)
    itt = outcomes.conversion_outcomes(coh, c, anchor="assignment")
    exp = outcomes.conversion_outcomes(coh, c, anchor="exposure")
    return {"validation": v, "cohort": coh, "itt": itt, "exposed": exp}


def test_daily_quality(golden):
    rows = quality.quality_daily(golden["validation"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.exposure_rate == pytest.approx(2 / 3)
    assert r.valid_exposure_rate == pytest.approx(2 / 3)
    assert r.mismatch_rate == 0.0 and r.pre_assignment_rate == 0.0 and r.percent_multiple_exposures == 0.0
    assert r.avg_exposure_delay_seconds == pytest.approx(90.0)


def test_itt_outcomes(golden):
    got = {
        (r.variant_id): (r.n_converted, r.n_users)
        for r in results.metric_by_variant_rounded(golden["itt"]).collect()
    }
    assert got == {"control": (1, 2), "treatment": (1, 1)}


def test_results_pairwise(golden):
    r = results.results_pairwise(results.metric_by_variant_rounded(golden["itt"])).collect()[0]
    assert r.uplift_abs == pytest.approx(0.5)
    assert r.se == pytest.approx(0.577350, abs=1e-6)
    assert r.z_score == pytest.approx(0.866025, abs=1e-6)
    assert r.p_value_two_sided == pytest.approx(0.386476, abs=1e-6)
    assert r.ci_low == pytest.approx(-0.631607, abs=1e-6)
    assert r.ci_high == pytest.approx(1.631607, abs=1e-6)


def test_results_itt(golden):
    rows = {r.variant_id: r for r in results.results(results.metric_by_variant(golden["itt"])).collect()}
    t = rows["treatment"]
    assert t.z == pytest.approx(0.866025, abs=1e-6)
    assert t.p_value_two_sided == pytest.approx(0.386476, abs=1e-6)
    assert t.uplift_rel == pytest.approx(1.0)
    assert t.se_unpooled == pytest.approx(0.353553, abs=1e-6)
    assert t.ci_low == pytest.approx(-0.192965, abs=1e-6)
    assert t.ci_high == pytest.approx(1.192965, abs=1e-6)
    c = rows["control"]
    assert c.uplift_abs == 0.0 and c.p_value_two_sided == pytest.approx(1.0)


def test_results_exposed_degenerate(golden):
    rows = {r.variant_id: r for r in results.results(results.metric_by_variant(golden["exposed"])).collect()}
    t = rows["treatment"]
    assert (t.n_users, t.conversions, t.control_n_users, t.control_conversions) == (1, 1, 1, 1)
    assert t.se == 0.0 and t.z is None and t.p_value_two_sided is None
    assert t.is_statistically_significant_95 is None
    assert t.uplift_abs == 0.0 and t.ci_low == 0.0 and t.ci_high == 0.0


def test_treatment_won_and_verdict(golden):
    gov = results.governed_results(results.results_pairwise(results.metric_by_variant_rounded(golden["itt"])))
    w = results.treatment_won(gov, 0.05).collect()[0]
    assert w.did_treatment_win is False
    v = results.verdict(gov).collect()[0]
    assert v.is_small_sample is True and v.ci_includes_zero is True and v.verdict == "not_won"
