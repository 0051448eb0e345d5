"""Product-limit curves and log-rank tests against plain loops and a worked example."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from abx.operators import survival as S
from conftest import CONVERSION_SCHEMA, ts

TIMES = "experiment_id string, unit_id string, variant_id string, steps long, is_event boolean"


def _times(spark, rows):
    return spark.createDataFrame([("e", str(i), v, s, d) for i, (v, s, d) in enumerate(rows)], TIMES)


def test_worked_example(spark):
    """Remission times (weeks) of 21 treated and 21 untreated patients, the textbook data of Freireich et al. (1963)."""
    treated = [(6, 1), (6, 1), (6, 1), (6, 0), (7, 1), (9, 0), (10, 1), (10, 0), (11, 0), (13, 1), (16, 1), (17, 0), (19, 0), (20, 0),
               (22, 1), (23, 1), (25, 0), (32, 0), (32, 0), (34, 0), (35, 0)]
    control = [1, 1, 2, 2, 3, 4, 4, 5, 5, 8, 8, 8, 8, 11, 11, 12, 12, 15, 17, 22, 23]
    t = _times(spark, [("treatment", s, bool(d)) for s, d in treated] + [("control", s, True) for s in control])
    km = {r.steps: r for r in S.survival_curve(t).filter("variant_id = 'treatment'").collect()}
    assert km[6].survival == pytest.approx(0.857, abs=1e-3) and km[6].std_error == pytest.approx(0.0764, abs=1e-4)
    assert km[23].survival == pytest.approx(0.448, abs=1e-3) and km[23].at_risk == 6
    (r,) = S.logrank_test(t).collect()
    assert (r.observed, r.variance) == (9, pytest.approx(6.2570, abs=1e-3))
    assert r.expected == pytest.approx(19.25, abs=1e-2) and r.chi_square == pytest.approx(16.79, abs=1e-2)
    medians = {x.variant_id: x.median_steps for x in S.survival_summary(t).collect()}
    assert medians == {"treatment": 23, "control": 8}


def test_against_loops(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["control", "b", "c"]), rnd.randrange(12), rnd.random() < 0.6) for _ in range(400)]
    t = _times(spark, rows).repartition(4)
    for r in S.survival_curve(t).collect():
        own = [(s, d) for v, s, d in rows if v == r.variant_id]
        left, h, g = 1.0, 0.0, 0.0
        for at in sorted({s for s, _ in own if s <= r.steps}):
            n, e = sum(s >= at for s, _ in own), sum(s == at and d for s, d in own)
            left, h = left * (1 - e / n), h + e / n
            g += e / (n * (n - e)) if n > e else 0.0
        assert r.survival == pytest.approx(left, abs=1e-12) and r.cumulative_hazard == pytest.approx(h)
        assert r.std_error is None if left == 0 else r.std_error == pytest.approx(left * math.sqrt(g))
    for r in S.logrank_test(t).collect():
        both = [x for x in rows if x[0] in (r.variant_id, "control")]
        expected = variance = 0.0
        for at in sorted({s for _, s, _ in both}):
            n, n1 = sum(s >= at for _, s, _ in both), sum(s >= at and v == r.variant_id for v, s, _ in both)
            e = sum(s == at and d for _, s, d in both)
            expected += n1 * e / n
            variance += n1 * (n - n1) * e * (n - e) / (n * n * (n - 1)) if n > 1 else 0.0
        assert r.expected == pytest.approx(expected) and r.variance == pytest.approx(variance)


def test_no_control_and_no_events(spark):
    assert S.logrank_test(_times(spark, [("b", 1, True), ("c", 2, False)])).collect() == []
    (r,) = S.logrank_test(_times(spark, [("b", 1, False), ("control", 2, False)])).collect()
    assert (r.observed, r.chi_square, r.p_value) == (0, None, None)
    assert S.survival_curve(_times(spark, [("b", 1, False)])).collect()[0].survival == 1.0


def test_censoring_edges(spark):
    anchors = [("e", u, "control", ts()) for u in "abcd"] + [("e", "late", "control", ts(days=9)), ("e", "none", "control", None)]
    a = spark.createDataFrame(anchors, "experiment_id string, unit_id string, variant_id string, anchor_at timestamp_ntz")
    conv = [("1", "a", ts(), 1.0), ("2", "b", ts(seconds=3600), 1.0), ("3", "c", ts(days=2), 1.0), ("4", "c", ts(seconds=7199), 1.0),
            ("5", "d", ts(days=5, micros=1), 1.0)]
    c = spark.createDataFrame(conv, CONVERSION_SCHEMA)
    got = {r.unit_id: (r.steps, r.is_event) for r in S.time_to_event(a, c, F.lit(ts(days=5))).collect()}
    # An event at the anchor is step 0; one after the end of the observation is censored there.
    assert got == {"a": (0, True), "b": (1, True), "c": (1, True), "d": (120, False)}
