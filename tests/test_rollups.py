"""Totals of every grain from one scan, and merged sketches within their stated errors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from abx.operators import rollups as R
from abx.plans.experiment import ExperimentDAG


@pytest.fixture(scope="module")
def validation(spark):
    return ExperimentDAG(spark, "/root/testdata/sf0.01", checkpoint_stages=True).validation_any


def test_totals_add_up_from_one_scan(validation):
    r = R.quality_rollup(validation)
    assert r._jdf.queryExecution().executedPlan().toString().count("Expand") == 1
    rows = r.collect()
    by = {}
    for x in rows:
        by.setdefault(x.grouping_level, []).append(x)
    assert set(by) == {0, 1, 2, 3, 5, 7}
    total = by[7][0]
    for level in by:
        assert sum(x.assigned_units for x in by[level]) == total.assigned_units
        assert sum(x.exposed_units for x in by[level]) == total.exposed_units
    assert total.exposure_rate == total.exposed_units / total.assigned_units


def test_null_variant_is_no_total(spark):
    row = dict(experiment_id="e", assigned_variant_id=None, assigned_at=None, has_any_exposure=True, has_valid_exposure=False,
               is_variant_mismatch=None, has_multiple_variations_exposed=False, is_pre_assignment_exposure=False, exposure_outside_window=False)
    schema = "experiment_id string, assigned_variant_id string, assigned_at timestamp_ntz, " + ", ".join(f"{c} boolean" for c in list(row)[3:])
    got = R.quality_rollup(spark.createDataFrame([tuple(row.values())], schema)).collect()
    assert sorted(x.grouping_level for x in got) == [0, 1, 2, 3, 5, 7]


def test_sketches_written_and_merged_for_windows(spark, validation, tmp_path):
    path = str(tmp_path / "sketches")
    R.daily_sketches(validation).write.parquet(path)
    stored = spark.read.parquet(path)
    v = validation.withColumn("d", F.to_date("assigned_at"))
    for lo, hi in (("2024-01-01", "2024-01-03"), ("2024-01-02", "2024-01-31")):
        exact = {
            r[0]: (r[1], r[2])
            for r in v.filter((F.col("d") >= lo) & (F.col("d") <= hi)).groupBy("experiment_id").agg(
                F.count_distinct("unit_id"), F.count(F.when(F.col("has_any_exposure"), F.col("exposure_delay_seconds")))).collect()
        }
        got = {r.experiment_id: r for r in R.merged_sketches(stored, F.lit(lo).cast("date"), F.lit(hi).cast("date")).collect()}
        assert got.keys() == exact.keys()
        for e, (units, delays) in exact.items():
            assert abs(got[e].units_estimate - units) <= R.UNITS_ERROR * units and got[e].n_delays == delays


def test_large_sketches_are_within_their_errors(spark):
    n = 60_000
    v = spark.range(n).selectExpr(
        "'e' AS experiment_id", "CAST(id % 40000 AS STRING) AS unit_id", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 30) AS assigned_at",
        "id % 40000 % 4 <> 0 AS has_any_exposure", "id * 7919 % 100000 AS exposure_delay_seconds")
    (r,) = R.sketch_accuracy(v, R.daily_sketches(v)).collect()
    assert r.exact_units == 40_000 and r.units_within and r.theta_within and r.unexposed_within and r.quantiles_within
