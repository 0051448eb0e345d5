"""Poisson bootstrap: the same draws under any partitioning, weights of mean 1, intervals near the normal ones."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.operators import bootstrap as B


def _units(spark, n=6000):
    return spark.range(n).selectExpr(
        "'e' AS experiment_id", "CASE WHEN id % 3 = 0 THEN 'control' WHEN id % 3 = 1 THEN 't' ELSE 'u' END AS variant_id",
        "CAST(id AS STRING) AS unit_id", "(id % 11) * 1.5D AS revenue", "1 + id % 4 AS conversion_events")


def test_cuts_are_the_poisson_distribution():
    cuts = B.poisson_cuts()
    assert cuts == sorted(set(cuts)) and cuts[0] == round(65536 / math.e)
    draws = np.searchsorted(cuts, np.arange(65536), side="right")
    assert abs(draws.mean() - 1) < 1e-3 and abs(draws.var() - 1) < 1e-3


def test_same_under_any_partitioning(spark):
    u = _units(spark, 500)
    one = {tuple(r) for r in B.resampled_sums(u.coalesce(1), "revenue", "conversion_events", 20).collect()}
    assert one == {tuple(r) for r in B.resampled_sums(u.repartition(7), "revenue", "conversion_events", 20).collect()}
    assert one != {tuple(r) for r in B.resampled_sums(u, "revenue", "conversion_events", 20, seed="x").collect()}


def test_interval_is_near_the_normal_one(spark):
    u = _units(spark)
    rows = {(r.variant_id, r.statistic): r for r in B.bootstrap_intervals(u).collect()}
    assert set(rows) == {(v, s) for v in "tu" for s in ("mean", "ratio")}
    sd = {r[0]: (r[1], r[2]) for r in u.groupBy("variant_id").agg(F.var_samp("revenue"), F.count("*")).collect()}
    for v in "tu":
        r = rows[v, "mean"]
        se = math.sqrt(sum(sd[x][0] / sd[x][1] for x in (v, "control")))
        assert r.n_replicates == B.REPLICATES and r.std_error == pytest.approx(se, rel=0.2)
        assert r.ci_low < r.diff < r.ci_high and r.ci_high - r.ci_low == pytest.approx(3.92 * se, rel=0.25)
        assert r.diff == pytest.approx(r.treatment - r.control)


def test_missing_control_empty_ratio_and_empty_table(spark):
    u = _units(spark, 30).filter("variant_id = 't'")
    assert {(r.diff, r.n_replicates) for r in B.bootstrap_intervals(u).collect()} == {(None, 0)}
    none = _units(spark, 30).withColumn("conversion_events", F.lit(0))
    got = {r.statistic: r for r in B.bootstrap_intervals(none).filter("variant_id = 't'").collect()}
    assert got["ratio"].diff is None and got["ratio"].n_replicates == 0 and got["mean"].diff is not None
    assert B.bootstrap_intervals(_units(spark, 0)).collect() == []
    with pytest.raises(ValueError):
        B.resampled_sums(u, "revenue", "conversion_events", 1)
