"""Gap sessions against a plain pass over each unit's events."""

from __future__ import annotations

import random

import pytest

from abx.operators import sessions as S
from conftest import ts

SCHEMA = "unit_id string, occurred_at timestamp_ntz, kind string"


def _plain(rows, gap):
    out, by = [], {}
    for u, t, _ in rows:
        if u is not None and t is not None:
            by.setdefault(u, []).append(t)
    for u, times in by.items():
        times.sort()
        runs = [[times[0]]]
        for a, b in zip(times, times[1:]):
            runs[-1].append(b) if (b - a).total_seconds() <= gap else runs.append([b])
        out += [(u, i + 1, r[0], r[-1], len(r)) for i, r in enumerate(runs)]
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("unit_id", "session_no", "started_at", "ended_at", "n_events").collect())


def test_gap_edges(spark):
    gap = 600
    rows = [("at", ts(), "a"), ("at", ts(seconds=gap), "b"), ("over", ts(), "a"), ("over", ts(seconds=gap, micros=1), "a"),
            ("under", ts(), "a"), ("under", ts(seconds=gap, micros=-1), "a"), ("twice", ts(), "a"), ("twice", ts(), "a"),
            ("midnight", ts(days=1, seconds=-1), "a"), ("midnight", ts(days=1, seconds=1), "b"), (None, ts(), "a"), ("x", None, "a")]
    df = S.sessions(spark.createDataFrame(rows, SCHEMA), gap, type_col="kind", types=("a", "b"))
    assert _got(df) == _plain(rows, gap)
    by = {(r.unit_id, r.session_no): r for r in df.collect()}
    assert by[("at", 1)].n_events == 2 and ("at", 2) not in by
    assert by[("over", 2)].n_events == 1 and by[("under", 1)].n_events == 2
    assert (by[("midnight", 1)].n_a, by[("midnight", 1)].n_b, by[("midnight", 1)].duration_seconds) == (1, 1, 2.0)
    with pytest.raises(ValueError):
        S.sessions(spark.createDataFrame(rows, SCHEMA), 0)
    assert S.sessions(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("gap", [1, 37, 3600])
def test_against_a_plain_pass_with_a_hot_unit(spark, gap):
    rnd = random.Random(gap)
    rows = [("hot" if i % 3 else f"u{i % 11}", ts(seconds=rnd.randrange(40 * 3600), micros=rnd.randrange(3) - 1), "a") for i in range(3000)]
    assert _got(S.sessions(spark.createDataFrame(rows, SCHEMA).repartition(6), gap)) == _plain(rows, gap)


def test_a_unit_reaches_the_window_as_slots(spark):
    """Ten thousand events of one unit within an hour are two or three rows before the shuffle to its window."""
    rows = [("hot", ts(seconds=i % 3600), "a") for i in range(10_000)]
    df = S.sessions(spark.createDataFrame(rows, SCHEMA).coalesce(1), 1800)
    assert [tuple(r)[1:] for r in df.select("unit_id", "session_no", "n_events").collect()] == [(1, 10_000)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_min(_t")
