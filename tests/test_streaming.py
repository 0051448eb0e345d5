"""Incremental validation: a file stream over raw exposures rebuilds only the touched days."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from abx.sources import io, lens
from abx.streaming.incremental import start_incremental_validation

SF = "/root/testdata/sf0.001"


def _write(spark, ev, base, days):
    a = lens.raw_assignments(ev).filter(F.col("dt").isin(*days)).withColumn("dt", F.col("dt").cast("string"))
    e = lens.raw_exposures(ev).filter(F.col("dt").isin(*days)).withColumn("dt", F.col("dt").cast("string"))
    io.write_day(a, base, "fact_assignment")
    io.write_day(e, base, "fact_exposure")


def test_stream_processes_new_days_only(spark):
    root = tempfile.mkdtemp(prefix="abx-stream-")
    raw, silver, gold, ckpt = f"{root}/raw", f"{root}/silver", f"{root}/gold", f"{root}/ckpt"
    ev = lens.load_events(spark, SF)
    _write(spark, ev, raw, ["2024-01-03", "2024-01-04"])
    q = start_incremental_validation(spark, raw, silver, gold, checkpoint_location=ckpt)
    q.awaitTermination(300)
    v = spark.read.parquet(f"{silver}/int_experiment_exposure_validation")
    assert sorted(str(r.dt) for r in v.select("dt").distinct().collect()) == ["2024-01-03", "2024-01-04"]

    _write(spark, ev, raw, ["2024-01-05"])
    q2 = start_incremental_validation(spark, raw, silver, gold, checkpoint_location=ckpt)
    q2.awaitTermination(300)
    lp = q2.lastProgress
    assert lp is not None and lp["numInputRows"] > 0
    v = spark.read.parquet(f"{silver}/int_experiment_exposure_validation")
    days = sorted(str(r.dt) for r in v.select("dt").distinct().collect())
    assert days == ["2024-01-03", "2024-01-04", "2024-01-05"]
    # the resumed query read only the new day's files
    new_rows = spark.read.parquet(f"{raw}/fact_exposure").filter(F.col("dt") == "2024-01-05").count()
    assert lp["numInputRows"] == new_rows
