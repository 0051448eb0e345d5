"""Daily batch jobs: raw day partitions in, silver/gold day partitions out, idempotent re-runs."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from abx.operators import assign, exposure, stage
from abx.plans import jobs
from abx.sources import io, lens

SF = "/root/testdata/sf0.001"
DT = "2024-01-05"


def _raw_layer(spark, base):
    ev = lens.load_events(spark, SF)
    fe = lens.conversions(ev).select(
        "event_id", F.col("unit_id").alias("user_id"), F.col("occurred_at").alias("event_time_utc"),
        F.lit("purchase").alias("event_type"), "revenue", F.to_date("occurred_at").cast("string").alias("dt"))
    io.write_day(fe, base, "fact_event")
    a = lens.raw_assignments(ev).select(
        "experiment_id", F.col("unit_id").alias("user_id"), "variant_id",
        F.col("assigned_at").alias("assignment_time_utc"), "assignment_source", F.col("dt").cast("string").alias("dt"))
    e = lens.raw_exposures(ev).select(
        "experiment_id", F.col("unit_id").alias("user_id"), "variant_id",
        F.col("exposed_at").alias("exposure_time_utc"), "exposure_event_type", F.col("dt").cast("string").alias("dt"))
    io.write_day(a, base, "fact_assignment")
    io.write_day(e, base, "fact_exposure")
    return ev


def test_run_day_matches_in_memory_and_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="abx-jobs-")
    raw, silver, gold = f"{root}/raw", f"{root}/silver", f"{root}/gold"
    ev = _raw_layer(spark, raw)
    conv = lens.conversions(ev)
    jobs.run_day(spark, raw, silver, gold, conv, DT)
    jobs.run_day(spark, raw, silver, gold, conv, DT)  # re-run replaces the day, no duplicates

    # A unit belongs to the day of its earliest assignment over all days; its exposures are those from
    # a day before until the last day of the window after.
    canonical = assign.canonical_assignments(lens.raw_assignments(ev).filter(F.col("dt") <= F.lit(DT)))
    day_a = canonical.filter(F.col("dt") == F.lit(DT))
    day_e = lens.raw_exposures(ev).filter((F.col("dt") >= F.lit("2024-01-04")) & (F.col("dt") <= F.lit("2024-01-13")))
    expect_v = exposure.validate_exposures_any(
        day_a, exposure.dedupe_exposures_strict(stage.stage_exposures_strict(day_e)))
    got_v = io.read_day(spark, silver, "int_experiment_exposure_validation", DT).drop("dt")
    cols = sorted(c for c in expect_v.columns if c != "dt")
    assert got_v.count() == expect_v.count() > 0
    assert sorted(got_v.select(*cols).collect()) == sorted(expect_v.select(*cols).collect())

    q = io.read_day(spark, gold, "fct_experiment_quality_metrics_daily", DT)
    assert q.groupBy("experiment_id", "date_day").count().filter("count > 1").count() == 0
    r = io.read_day(spark, gold, "fct_experiment_results", DT)
    assert r.count() > 0 and "p_value_two_sided" in r.columns
    assert io.read_day(spark, gold, "fct_experiment_exposure_quality_daily", DT).count() > 0
    u = io.read_day(spark, gold, "fct_experiment_unit_outcomes", DT)
    assert {"anchor_type", "conversion_events", "revenue"} <= set(u.columns) and u.count() == got_v.count()
    report = io.read_day(spark, gold, "fct_experiment_quality_report", DT)
    ok = {x.experiment_id for x in report.filter("is_valid_for_analysis").collect()}
    gated = {x.experiment_id for x in io.read_day(spark, gold, "fct_experiment_results_gated", DT).collect()}
    assert report.count() > 0 and gated == ok & {x.experiment_id for x in r.collect()}


def _handmade(spark, base):
    """Units whose exposures fall on other days than their assignment, and one assigned twice."""
    t = lambda day, hour=12: dt.datetime(2024, 1, day, hour)
    a = [("x", "u1", "control", t(1, 23)), ("x", "u2", "treatment", t(1)), ("x", "u3", "control", t(1)), ("x", "u1", "treatment", t(2)),
         ("x", "u4", "control", t(2, 0)), ("x", "u5", "control", t(2))]
    e = [("x", "u1", "control", t(2, 1)), ("x", "u2", "treatment", t(9)), ("x", "u4", "control", t(1, 23)), ("x", "u4", "control", t(3)),
         ("x", "u5", "control", t(2, 13))]
    day = F.date_format("at", "yyyy-MM-dd").alias("dt")
    schema = "experiment_id string, user_id string, variant_id string, at timestamp_ntz"
    keys = ["experiment_id", "user_id", "variant_id"]
    fa = spark.createDataFrame(a, schema).select(*keys, F.col("at").alias("assignment_time_utc"), F.lit("s").alias("assignment_source"), day)
    fe = spark.createDataFrame(e, schema).select(*keys, F.col("at").alias("exposure_time_utc"), F.lit("view").alias("exposure_event_type"), day)
    io.write_day(fa, base, "fact_assignment")
    io.write_day(fe, base, "fact_exposure")


def test_days_together_equal_one_run_over_all(spark):
    root = tempfile.mkdtemp(prefix="abx-days-")
    raw, silver, gold = f"{root}/raw", f"{root}/silver", f"{root}/gold"
    _handmade(spark, raw)
    for d in ("2024-01-01", "2024-01-02"):
        jobs.build_assignments(spark, raw, silver, d)
        jobs.build_exposure_validation(spark, raw, silver, gold, d)
    got = spark.read.parquet(f"{silver}/int_experiment_exposure_validation").drop("dt")
    all_a = jobs.normalize(spark.read.parquet(f"{raw}/fact_assignment")).drop("dt")
    all_e = jobs.normalize(spark.read.parquet(f"{raw}/fact_exposure")).drop("dt")
    want = exposure.validate_exposures_any(
        assign.canonical_assignments(all_a), exposure.dedupe_exposures_strict(stage.stage_exposures_strict(all_e)))
    cols = sorted(set(want.columns) - {"dt"})
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))
    assert {r.unit_id: r.validation_status for r in got.collect()} == {
        "u1": "valid", "u2": "exposure_outside_window", "u3": "no_exposure", "u4": "pre_assignment_exposure", "u5": "valid"}


def test_an_empty_rerun_replaces_the_day(spark):
    root = tempfile.mkdtemp(prefix="abx-empty-")
    df = spark.createDataFrame([(1, DT), (2, DT)], "x int, dt string")
    io.write_day(df, root, "t")
    io.write_day(spark.createDataFrame([(9, "2024-01-06")], "x int, dt string"), root, "t")
    io.write_day(df.filter("x > 5"), root, "t", dt=DT)
    assert io.read_day(spark, root, "t", DT).count() == 0
    assert [r.x for r in io.read_day(spark, root, "t", "2024-01-06").collect()] == [9]


def test_repeated_canonical_keys_stop_the_job(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="abx-post-")
    _handmade(spark, f"{root}/raw")
    monkeypatch.setattr(jobs.assign, "canonical_assignments", lambda df: df.union(df))
    with pytest.raises(ValueError, match="repeat keys"):
        jobs.build_assignments(spark, f"{root}/raw", f"{root}/silver", "2024-01-01")


def test_read_seed_csv(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("experiment_id,user_id,first_exposure_at\nexp,u1,2024-01-01 00:02:00\nexp,u3,\n")
    schema = "experiment_id string, user_id string, first_exposure_at timestamp_ntz"
    from pyspark.sql import types as T

    df = io.read_seed_csv(spark, str(p), T._parse_datatype_string(schema))
    rows = sorted(df.collect())
    assert rows[1].first_exposure_at is None and rows[0].first_exposure_at.minute == 2


def test_cli_runs_both_jobs(spark):
    from abx.plans import cli

    root = tempfile.mkdtemp(prefix="abx-cli-")
    raw, silver, gold = f"{root}/raw", f"{root}/silver", f"{root}/gold"
    _raw_layer(spark, raw)
    cli.main(["assignments", "--dt", DT, "--in", raw, "--out", silver], spark=spark)
    cli.main(["exposure-validation", "--dt", DT, "--in", raw, "--silver", silver, "--gold", gold,
              "--pre_assignment_grace_minutes", "5"], spark=spark)
    assert io.read_day(spark, gold, "fct_experiment_quality_metrics_daily", DT).count() > 0
    cli.main(["results", "--dt", DT, "--in", raw, "--silver", silver, "--gold", gold], spark=spark)
    # the bounded, partition-pruned conversion read gives the same outcomes as all conversions
    got = io.read_day(spark, gold, "int_experiment_metric_outcomes", DT).drop("dt")
    from abx.operators import cohort as COH
    from abx.operators import outcomes as OUT

    v = io.read_day(spark, silver, "int_experiment_exposure_validation", DT)
    expect = OUT.conversion_outcomes(COH.cohort(v), lens.conversions(lens.load_events(spark, SF)), anchor="assignment")
    cols = sorted(expect.columns)
    assert sorted(got.select(*cols).collect()) == sorted(expect.select(*cols).collect())
    # cluster defaults are not applied to a local session, and never override explicit settings
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) in (None, "")


def test_materialize_view(spark):
    df = spark.createDataFrame([(1,)], "x int")
    v = io.materialize(df, "abx_test_view")
    assert spark.table("abx_test_view").count() == 1 and v.count() == 1


def test_run_reports_with_checkpointed_stages(spark):
    import __spark_entry__ as E

    root = tempfile.mkdtemp(prefix="abx-reports-")
    names = ["validate_exposures", "quality_daily_post", "results", "cohort_sizes"]
    assert jobs.run_reports(spark, SF, root, names) == names
    for n in names:
        got = spark.read.parquet(f"{root}/{n}")
        exp = E.queries()[n](spark, SF)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, exp.collect())), n
