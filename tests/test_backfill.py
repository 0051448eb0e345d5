"""Late and corrected raw days: catching up equals one run over all days."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from abx.plans import backfill as B
from abx.plans import jobs
from abx.sources import io

SCHEMA = "experiment_id string, user_id string, variant_id string, at timestamp_ntz"
KEYS = ["experiment_id", "user_id", "variant_id"]
TABLES = {
    "silver": ["fact_assignment_canonical", "int_experiment_exposure_validation", "metrics_assignment_quality"],
    "gold": ["int_experiment_metric_outcomes", "fct_experiment_unit_outcomes", "fct_experiment_results", "fct_experiment_quality_report"],
}


def at(day, hour=12):
    return dt.datetime(2024, 1, day, hour)


def write(spark, raw, assignments, exposures, events):
    day = F.date_format("at", "yyyy-MM-dd").alias("dt")
    a, e = spark.createDataFrame(assignments, SCHEMA), spark.createDataFrame(exposures, SCHEMA)
    v = spark.createDataFrame(events, "event_id string, user_id string, at timestamp_ntz, revenue double")
    io.write_day(a.select(*KEYS, F.col("at").alias("assignment_time_utc"), F.lit("s").alias("assignment_source"), day), raw, "fact_assignment")
    io.write_day(e.select(*KEYS, F.col("at").alias("exposure_time_utc"), F.lit("view").alias("exposure_event_type"), day), raw, "fact_exposure")
    io.write_day(
        v.select("event_id", "user_id", F.col("at").alias("event_time_utc"), F.lit("purchase").alias("event_type"), "revenue", day), raw, "fact_event"
    )


ASSIGNED = [("x", "u1", "control", at(1)), ("x", "u2", "treatment", at(1)), ("x", "u3", "control", at(2)), ("x", "u4", "treatment", at(3)),
            ("x", "u5", "control", at(3))]
EXPOSED = [("x", "u1", "control", at(1, 13)), ("x", "u3", "control", at(2, 14)), ("x", "u4", "treatment", at(3, 15))]
EVENTS = [("1", "u1", at(2), 5.0), ("2", "u4", at(4), 7.0), ("3", "u5", at(5), 9.0)]


def tables(spark, root):
    out = {}
    for layer, names in TABLES.items():
        for name in names:
            df = spark.read.parquet(f"{root}/{layer}/{name}")
            out[name] = sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    return out


def catch_up(spark, root):
    return B.catch_up(spark, f"{root}/raw", f"{root}/silver", f"{root}/gold")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="abx-backfill-")


def in_order(spark, assignments, exposures, events):
    other = tempfile.mkdtemp(prefix="abx-batch-")
    write(spark, f"{other}/raw", assignments, exposures, events)
    conv = jobs.read_conversions(spark, f"{other}/raw")
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        jobs.run_day(spark, f"{other}/raw", f"{other}/silver", f"{other}/gold", conv, d)
    return tables(spark, other)


def test_late_assignment_of_day_one_after_day_three(spark, root):
    write(spark, f"{root}/raw", ASSIGNED, EXPOSED, EVENTS)
    assert catch_up(spark, root) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert catch_up(spark, root) == []
    # u4, so far canonical on day 3, turns out to have been assigned on day 1, to the other arm.
    late = ASSIGNED + [("x", "u4", "control", at(1, 20))]
    write(spark, f"{root}/raw", late, EXPOSED, EVENTS)
    assert catch_up(spark, root) == ["2024-01-01", "2024-01-03"]
    got = tables(spark, root)
    want = in_order(spark, late, EXPOSED, EVENTS)
    # Reports of days between are as of then and are not rebuilt; all others equal one batch.
    for name in got:
        if name != "fct_experiment_quality_report":
            assert got[name] == want[name], name
    assert [r for r in spark.read.parquet(f"{root}/silver/fact_assignment_canonical").filter("unit_id = 'u4'").collect()][0].variant_id == "control"


def test_removed_rows_and_late_exposures_and_events(spark, root):
    """Which days are rebuilt, without rebuilding them."""
    twice = ASSIGNED + [("x", "u1", "control", at(3))]
    write(spark, f"{root}/raw", twice, EXPOSED, EVENTS)
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        jobs.build_assignments(spark, f"{root}/raw", f"{root}/silver", d)
    B.raw_digests(spark, f"{root}/raw").write.parquet(f"{root}/silver/{B.MANIFEST}")

    def days(assignments, exposures, events):
        raw = tempfile.mkdtemp(prefix="abx-raw-")
        write(spark, raw, assignments, exposures, events)
        changed = B.changed_days(B.read_manifest(spark, f"{root}/silver"), B.raw_digests(spark, raw))
        return B.days_to_rebuild(spark, raw, f"{root}/silver", changed)

    assert days(twice, EXPOSED, EVENTS) == []
    # u1 is no longer assigned on day 1, so its row moves to day 3.
    assert days([r for r in twice if r != ("x", "u1", "control", at(1))], EXPOSED, EVENTS) == ["2024-01-01", "2024-01-03"]
    # An exposure may count for units assigned up to the window before it, or the grace after it.
    assert days(twice, EXPOSED + [("x", "u2", "treatment", at(2, 9))], EVENTS) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert days(twice, EXPOSED + [("x", "u2", "treatment", at(10, 9))], EVENTS) == ["2024-01-02", "2024-01-03"]
    # A conversion counts for windows that start after its day no more.
    assert days(twice, EXPOSED, EVENTS + [("9", "u5", at(18), 1.0)]) == ["2024-01-03"]
    assert days(twice, EXPOSED, EVENTS + [("9", "u5", at(1), 1.0)]) == ["2024-01-01"]


def test_digests_do_not_depend_on_order_or_files_but_on_rows(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01"), (2, None, "2024-01-01"), (2, None, "2024-01-01")], "x int, y string, dt string")
    one = B.day_digests(df, "t").collect()
    assert one == B.day_digests(df.repartition(3).orderBy(F.desc("x")), "t").collect()
    assert one != B.day_digests(df.distinct(), "t").collect()
    swapped = df.withColumn("y", F.coalesce("y", F.lit("")))
    assert one != B.day_digests(swapped, "t").collect()


def test_read_day_opens_one_folder(spark, root):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, dt string")
    io.write_day(rows, root, "t")
    day = io.read_day(spark, root, "t", "2024-01-02")
    assert [r.x for r in day.collect()] == [2] and day.columns == ["x", "dt"]
    assert len(day.inputFiles()) == 1 and "dt=2024-01-02" in day.inputFiles()[0]
    assert "2024-01-01" not in day._jdf.queryExecution().executedPlan().toString()
    missing = io.read_day(spark, root, "t", "2024-01-09")
    assert missing.collect() == [] and missing.columns == ["x", "dt"]


def test_report_guards_can_fail_in_the_daily_job(spark, root):
    """Raw repeats, a conversion before the first exposure and a planned 90/10 split stop experiment x; y passes."""
    both = [("x", "u1", "control", at(1)), ("x", "u1", "control", at(1, 14)), ("x", "u2", "treatment", at(1)),
            ("y", "u1", "control", at(1)), ("y", "u2", "treatment", at(1))]
    seen = [("x", "u1", "control", at(2)), ("y", "u1", "control", at(1, 13))]
    write(spark, f"{root}/raw", both, seen, [("1", "u1", at(1, 20), 1.0)])
    plan = [("x", "control", 90.0), ("x", "treatment", 10.0), ("y", "control", 50.0), ("y", "treatment", 50.0)]
    spark.createDataFrame(plan, "experiment_id string, variant_id string, allocation_pct double").withColumn("dt", F.lit("2024-01-01")).write.partitionBy(
        "dt").parquet(f"{root}/raw/dim_experiment_variant")
    catch_up(spark, root)
    report = {r.experiment_id: r for r in io.read_day(spark, f"{root}/gold", "fct_experiment_quality_report", "2024-01-01").collect()}
    assert report["x"].failed_guardrails == ["assignment_unique", "srm", "outcome_order"]
    assert report["x"].outcomes_before_analysis_start_count == 1
    assert report["y"].is_valid_for_analysis
    gated = io.read_day(spark, f"{root}/gold", "fct_experiment_results_gated", "2024-01-01").collect()
    assert {r.experiment_id for r in gated} == {"y"}
