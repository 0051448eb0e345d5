"""Sort-and-carry matches against the day-keyed join and plain loops."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from abx.operators import asof, outcomes
from abx.plans.experiment import ExperimentDAG
from conftest import CONVERSION_SCHEMA, ts

ANCHORS = "experiment_id string, unit_id string, variant_id string, anchor_at timestamp_ntz"


def _outcomes(df):
    return sorted(
        (tuple(r) for r in df.select("experiment_id", "unit_id", "first_at", "n_events", F.round("revenue", 6)).collect()),
        key=repr,
    )


@pytest.mark.parametrize("sf,start,end", [("sf0.01", 0, 7), ("sf0.001", 1, 30)])
def test_equals_the_day_keyed_join(spark, sf, start, end):
    d = ExperimentDAG(spark, f"/root/testdata/{sf}")
    want = outcomes.window_outcomes(d.itt_anchors, d.conversions, start, end)
    assert _outcomes(asof.window_outcomes(d.itt_anchors, d.conversions, start, end)) == _outcomes(want)


def test_hot_unit_on_one_day_crosses_partitions(spark):
    """A unit holds nearly all events, most at a handful of times; its markers lie between them."""
    rnd = random.Random(5)
    conv = [(str(i), "hot", ts(seconds=rnd.randrange(40)), float(i % 7)) for i in range(3000)]
    conv += [(f"x{i}", f"u{i % 9}", ts(seconds=rnd.randrange(80)), 1.5) for i in range(200)]
    anchors = [(f"e{i}", "hot", "control", ts(seconds=i, micros=0)) for i in range(45)]
    anchors += [("e", f"u{i}", "control", ts(seconds=30)) for i in range(12)]
    a = spark.createDataFrame(anchors, ANCHORS).repartition(3)
    c = spark.createDataFrame(conv, CONVERSION_SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seen = asof.carry(a, c, "anchor_at", value=F.col("revenue")).collect()
        got = _outcomes(asof.window_outcomes(a, c, 0, 1))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(seen) == len(anchors)
    for r in seen:
        own = [x for x in conv if x[1] == r.unit_id]
        before = [x for x in own if x[2] < r.anchor_at]
        assert r.events_before == len(before)
        assert float(r.value_before or 0) == sum(x[3] for x in before)
        assert r.next_at == min((x[2] for x in own if x[2] >= r.anchor_at), default=None)
    assert got == _outcomes(outcomes.window_outcomes(a, c, 0, 1))


def test_window_edges_and_nulls(spark):
    day = dt.timedelta(days=7)
    conv = [("1", "a", ts(), 1.0), ("2", "a", ts() + day, 2.0), ("3", "b", ts() + day - dt.timedelta(microseconds=1), None),
            ("4", None, ts(), 1.0), ("5", "c", None, 1.0)]
    anchors = [("e", "a", "v", ts()), ("e", "b", "v", ts()), ("e", "c", "v", ts()), ("e", "d", "v", None), ("f", None, "v", ts())]
    a, c = spark.createDataFrame(anchors, ANCHORS), spark.createDataFrame(conv, CONVERSION_SCHEMA)
    got = {(r.experiment_id, r.unit_id): (r.first_at, r.n_events, r.revenue) for r in asof.window_outcomes(a, c, 0, 7).collect()}
    assert got == {
        ("e", "a"): (ts(), 1, 1.0),
        ("e", "b"): (ts() + day - dt.timedelta(microseconds=1), 1, 0.0),
        ("e", "c"): (None, 0, None),
        ("e", "d"): (None, 0, None),
        ("f", None): (None, 0, None),
    }
    nxt = {(r.experiment_id, r.unit_id): r.next_at for r in asof.first_match_after(a, c).collect()}
    assert nxt[("e", "a")] == ts() and nxt[("e", "d")] is None and nxt[("f", None)] is None
    assert asof.first_match_after(a.limit(0), c).collect() == []
    assert all(r.next_at is None for r in asof.first_match_after(a, c.limit(0)).collect())
