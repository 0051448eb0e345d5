"""Handmade edge rows (FIXTURES.md §4): boundaries, ties, nulls, precedence, degenerate arms."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import ASSIGN_SCHEMA, CONVERSION_SCHEMA, EXPOSURE_SCHEMA, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.config import ExperimentConfig
from abx.operators import assign, cohort, exposure, outcomes, results, stage

US = dt.timedelta(microseconds=1)


def _validate(spark, assignments, exposures, mode="first_post"):
    a = spark.createDataFrame(assignments, ASSIGN_SCHEMA)
    e = spark.createDataFrame(exposures, EXPOSURE_SCHEMA)
    v = exposure.validate_exposures(a, exposure.dedupe_exposures(e), mode=mode)
    return {r.unit_id: r for r in v.collect()}


@pytest.mark.parametrize("mode", ["first_post", "first_any"])
def test_grace_and_window_boundaries(spark, mode):
    A = [("x", u, "control", ts(days=10)) for u in ("g0", "g1", "w0", "w1")]
    E = [
        ("1", "x", "g0", "control", ts(days=10) - dt.timedelta(minutes=5), None),  # exactly at grace: not pre
        ("2", "x", "g1", "control", ts(days=10) - dt.timedelta(minutes=5) - US, None),  # 1 us earlier: pre
        ("3", "x", "w0", "control", ts(days=17), None),  # exactly at +7 d: inside
        ("4", "x", "w1", "control", ts(days=17) + US, None),  # 1 us later: outside
    ]
    r = _validate(spark, A, E, mode)
    assert r["g0"].is_pre_assignment_exposure is False and r["g0"].validation_status == "valid"
    assert r["g1"].is_pre_assignment_exposure is True and r["g1"].validation_status == "pre_assignment_exposure"
    assert r["w0"].exposure_outside_window is False and r["w0"].validation_status == "valid"
    assert r["w1"].exposure_outside_window is True and r["w1"].validation_status == "exposure_outside_window"
    if mode == "first_post":
        # the pre-assignment unit has no post exposure, so it is not validly exposed either
        assert r["g1"].has_post_assignment_exposure is False and r["g1"].has_valid_exposure is False


def test_delay_counts_second_boundaries(spark):
    A = [("x", "u", "control", ts(0.9))]
    E = [("1", "x", "u", "control", ts(1.1), None)]
    assert _validate(spark, A, E)["u"].exposure_delay_seconds == 1


def test_assignment_tie_by_variant(spark):
    raw = spark.createDataFrame(
        [("x", "u", "treatment", ts()), ("x", "u", "control", ts()), ("x", "u", "control", ts(5))], ASSIGN_SCHEMA
    )
    rows = assign.canonical_assignments(raw).collect()
    assert [(r.variant_id, r.assigned_at) for r in rows] == [("control", ts())]


def test_exposure_tie_ingested_then_event_id(spark):
    E = spark.createDataFrame(
        [
            ("b", "x", "u", "control", ts(), None),
            ("c", "x", "u", "control", ts(), ts(9)),
            ("d", "x", "u", "control", ts(), ts(3)),
            ("a", "x", "u", "control", ts(), None),
        ],
        EXPOSURE_SCHEMA,
    )
    (r,) = exposure.dedupe_exposures(E).collect()
    assert r.event_id == "d"  # non-null ingested_at first, then the earliest one
    E2 = spark.createDataFrame(
        [("b", "x", "u", "control", ts(), None), ("a", "x", "u", "control", ts(), None)], EXPOSURE_SCHEMA
    )
    (r2,) = exposure.dedupe_exposures(E2).collect()
    assert r2.event_id == "a"


def test_null_assigned_at_is_invalid_other(spark):
    A = [("x", "u", "control", None)]
    E = [("1", "x", "u", "control", ts(), None)]
    r = _validate(spark, A, E)["u"]
    assert r.has_any_exposure is True and r.has_post_assignment_exposure is False
    assert r.validation_status == "invalid_other"


def test_null_variant_can_be_valid_on_keep_null_path(spark):
    # pre-assignment event with a null variant, assigned variant only seen after assignment
    A = [("x", "u", "control", ts(days=1))]
    E = [("1", "x", "u", None, ts(), None), ("2", "x", "u", "control", ts(days=1, seconds=10), None)]
    r = _validate(spark, A, E)["u"]
    assert r.has_valid_exposure is True
    assert r.validation_status == "pre_assignment_exposure"
    assert r.exposure_variation_count == 1


def test_multi_variation(spark):
    A = [("x", "u", "control", ts())]
    E = [("1", "x", "u", "control", ts(10), None), ("2", "x", "u", "treatment", ts(20), None)]
    r = _validate(spark, A, E)["u"]
    assert r.has_multiple_variations_exposed is True and r.validation_status == "multi_variation_exposure"
    assert r.exposure_event_count == 2 and r.exposure_variation_count == 2


def test_no_exposure_counts_are_null(spark):
    r = _validate(spark, [("x", "u", "control", ts())], [("1", "y", "v", "control", ts(), None)])["u"]
    assert r.validation_status == "no_exposure"
    assert r.exposure_event_count is None and r.exposure_variation_count is None


def test_staging_precedence_and_bad_json(spark):
    schema = T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("event_name", T.StringType()),
            T.StructField("occurred_at", T.TimestampNTZType()),
            T.StructField("event_timestamp", T.TimestampNTZType()),
            T.StructField("unit_id", T.StringType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("experiment_id", T.StringType()),
            T.StructField("variation_id", T.StringType()),
            T.StructField("properties", T.StringType()),
            T.StructField("event_properties", T.StringType()),
        ]
    )
    props = json.dumps({"user_id": "bag_u", "experiment_id": "bag_x", "variation_id": "bag_v"})
    rows = [
        ("1", "experiment_exposed", None, ts(5), None, "usr", None, None, props, None),  # fallbacks
        ("2", "experiment_exposed", ts(1), ts(5), "col_u", "usr", "col_x", "col_v", props, None),  # columns win
        ("3", "experiment_exposed", ts(1), None, None, None, None, None, "{bad json", '{"experiment_id": "ep_x"}'),
        ("4", "experiment_exposed", ts(1), None, None, None, None, None, None, None),  # no unit -> dropped
        ("5", "purchase", ts(1), None, "u", None, "x", "v", None, None),  # other event name
    ]
    out = {r.event_id: r for r in stage.stage_exposures(spark.createDataFrame(rows, schema)).collect()}
    assert set(out) == {"1", "2"}
    assert (out["1"].unit_id, out["1"].experiment_id, out["1"].variant_id, out["1"].exposed_at) == (
        "usr", "bag_x", "bag_v", ts(5))
    assert (out["2"].unit_id, out["2"].experiment_id, out["2"].variant_id, out["2"].exposed_at) == (
        "col_u", "col_x", "col_v", ts(1))
    # bad JSON: unit unusable -> row dropped even though event_properties has an experiment
    rows3 = [("3", "experiment_exposed", ts(1), None, "u3", None, None, None, "{bad", '{"experiment_id": "ep_x"}')]
    (r3,) = stage.stage_exposures(spark.createDataFrame(rows3, schema)).collect()
    assert r3.experiment_id == "ep_x" and r3.variant_id is None


def test_conversion_window_half_open_and_multi_experiment(spark):
    coh = cohort.cohort(
        _validation_rows(spark, [("x1", "u", "control", ts()), ("x2", "u", "treatment", ts())])
    )
    conv_at_anchor = spark.createDataFrame([("p", "u", ts(), 1.0)], CONVERSION_SCHEMA)
    got = {r.experiment_id: r.did_convert for r in outcomes.conversion_outcomes(coh, conv_at_anchor, anchor="assignment").collect()}
    assert got == {"x1": True, "x2": True}  # one purchase counts in both experiments
    conv_at_end = spark.createDataFrame([("p", "u", ts(days=7), 1.0)], CONVERSION_SCHEMA)
    got = {r.experiment_id: r.did_convert for r in outcomes.conversion_outcomes(coh, conv_at_end, anchor="assignment").collect()}
    assert got == {"x1": False, "x2": False}


def _validation_rows(spark, assignments):
    a = spark.createDataFrame(assignments, ASSIGN_SCHEMA)
    e = spark.createDataFrame([], EXPOSURE_SCHEMA)
    return exposure.validate_exposures(a, e)


def test_control_missing_and_zero_conversions(spark):
    schema = "experiment_id string, unit_id string, variant_id string, metric_id string, did_convert boolean"
    out = spark.createDataFrame(
        [("x", "1", "treatment", "m", False), ("x", "2", "treatment", "m", False), ("y", "1", "control", "m", False),
         ("y", "2", "treatment", "m", False)],
        schema,
    )
    rows = {(r.experiment_id, r.variant_id): r for r in results.results(results.metric_by_variant(out)).collect()}
    assert rows[("x", "treatment")].control_n_users is None and rows[("x", "treatment")].p_value_two_sided is None
    y = rows[("y", "treatment")]
    assert y.conversion_rate == 0.0 and y.se == 0.0 and y.z is None and y.uplift_rel is None
    pw = results.results_pairwise(results.metric_by_variant_rounded(out)).collect()
    assert [r.experiment_id for r in pw] == ["y"]  # pairwise drops arms without control


def test_hot_unit_is_split_by_day(spark):
    """A unit holding most conversions meets its anchors day by day; counts and revenue are exact."""
    coh = cohort.cohort(
        _validation_rows(spark, [("x1", "hot", "control", ts()), ("x2", "hot", "treatment", ts(days=3)),
                                 ("x1", "cold", "treatment", ts())])
    )
    conv = spark.createDataFrame(
        [(f"h{i}", "hot", ts(seconds=3600 * i), float(i)) for i in range(300)] + [("c1", "cold", ts(days=1), 5.0)],
        CONVERSION_SCHEMA,
    )
    got = outcomes.unit_outcomes(coh, conv)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_ad" in plan and "Limit" not in plan  # an equi-key per day, no counting pass
    assert {(r.experiment_id, r.unit_id): (r.conversion_events, r.revenue) for r in got.collect()} == {
        ("x1", "hot"): (168, float(sum(range(168)))),
        ("x2", "hot"): (168, float(sum(range(72, 240)))),
        ("x1", "cold"): (1, 5.0),
    }


def test_permutation_invariance(spark):
    """Shuffled input and another partitioning give the same canonical and deduped rows."""
    import random

    rnd = random.Random(7)
    A = [("x", f"u{i % 40}", rnd.choice(["control", "treatment"]), ts(rnd.randrange(0, 50))) for i in range(400)]
    E = [(str(i), "x", f"u{i % 40}", rnd.choice(["control", "treatment", None]), ts(rnd.randrange(0, 50)),
          rnd.choice([None, ts(rnd.randrange(0, 5))])) for i in range(400)]
    base_a = sorted(assign.canonical_assignments(spark.createDataFrame(A, ASSIGN_SCHEMA)).collect())
    base_e = sorted(exposure.dedupe_exposures(spark.createDataFrame(E, EXPOSURE_SCHEMA)).collect(), key=str)
    for seed in (1, 2):
        r = random.Random(seed)
        A2, E2 = A[:], E[:]
        r.shuffle(A2)
        r.shuffle(E2)
        a2 = spark.createDataFrame(A2, ASSIGN_SCHEMA).repartition(5 + seed)
        e2 = spark.createDataFrame(E2, EXPOSURE_SCHEMA).repartition(3 + seed)
        assert sorted(assign.canonical_assignments(a2).collect()) == base_a
        assert sorted(exposure.dedupe_exposures(e2).collect(), key=str) == base_e


def test_exposure_event_id_is_stable(spark):
    raw = spark.createDataFrame(
        [("x", "u", "control", ts(1.5), "view")],
        "experiment_id string, unit_id string, variant_id string, exposed_at timestamp_ntz, exposure_event_type string",
    )
    (r,) = stage.stage_exposures_strict(raw).collect()
    import hashlib

    expect = hashlib.sha256(b"x||u||control||2024-01-01 00:00:01.500000||view").hexdigest()
    assert r.exposure_event_id == expect


def test_bag_types_map_struct_variant(spark):
    base = "event_id string, event_name string, occurred_at timestamp_ntz, experiment_id string"
    m = spark.createDataFrame(
        [("1", "experiment_exposed", ts(), None, {"user_id": "mu", "experiment_id": "mx", "variation_id": "mv"})],
        base + ", properties map<string,string>",
    )
    (r,) = stage.stage_exposures(m).collect()
    assert (r.unit_id, r.experiment_id, r.variant_id) == ("mu", "mx", "mv")
    s = spark.createDataFrame([("2", "experiment_exposed", ts(), "sx", ("su",))],
                              base + ", properties struct<user_id:string>")
    (r,) = stage.stage_exposures(s).collect()
    assert (r.unit_id, r.experiment_id, r.variant_id) == ("su", "sx", None)
    v = spark.createDataFrame([("3", "experiment_exposed", ts(), None, '{"user_id": 7, "experiment_id": "vx"}')],
                              base + ", props string")
    v = v.withColumn("properties", F.parse_json("props")).drop("props")
    (r,) = stage.stage_exposures(v).collect()
    assert (r.unit_id, r.experiment_id) == ("7", "vx")


def test_prefilter_equals_plain(spark):
    from abx.plans.experiment import ExperimentDAG

    d = ExperimentDAG(spark, "/root/testdata/sf0.001")
    a = outcomes.unit_outcomes(d.cohort, d.conversions, prefilter=True)
    b = outcomes.unit_outcomes(d.cohort, d.conversions, prefilter=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
