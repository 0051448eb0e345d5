"""Late and corrected raw data: which days to rebuild, found from digests of every raw day.

A manifest keeps, per raw table and day, the number of rows and an order-free digest of their contents as of the last
run. ``catch_up`` digests the raw days again, compares, and reruns the daily jobs for the changed days and for
those that they move:

- assignments: days that hold, or held, the canonical row of a unit of a changed day, and raw days of units that a changed
  day no longer holds;
- exposures: days whose units' windows reach the changed day;
- outcome events: cohort days whose conversion windows reach it.

Reruns go from the oldest day on, each replaces its day folders, and the manifest is written last, so a run that dies is
repeated whole by the next one. The result equals one run over all days in order.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.operators import assign
from abx.plans import jobs
from abx.session import cut_lineage

RAW_TABLES = ("fact_assignment", "fact_exposure", "fact_event")
MANIFEST = "manifest_raw_days"
MANIFEST_SCHEMA = "table string, dt string, n_rows long, digest decimal(38,0)"


def read_all(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The whole day-partitioned table, or None if it has no day yet."""
    path = f"{base.rstrip('/')}/{table}"
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def day_digests(df: DataFrame, table: str) -> DataFrame:
    """(table, dt, n_rows, digest): sums of the rows' 64-bit hashes, so neither order, files nor partitions matter, and
    repeated rows count. Sums combine in every task; the shuffle holds a row a task and day."""
    cols = [F.col(c).cast("string") for c in sorted(df.columns) if c != "dt"]
    row = F.xxhash64(*cols, *[c.isNull() for c in cols]).cast("decimal(38,0)")
    return df.groupBy(F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row).cast("decimal(38,0)").alias("digest")
    ).select(F.lit(table).alias("table"), "dt", "n_rows", "digest")


def raw_digests(spark: SparkSession, raw_base: str) -> DataFrame:
    out = spark.createDataFrame([], MANIFEST_SCHEMA)
    for table in RAW_TABLES:
        df = read_all(spark, raw_base, table)
        if df is not None:
            out = out.unionByName(day_digests(df, table))
    return out


def read_manifest(spark: SparkSession, silver_base: str) -> DataFrame:
    found = read_all(spark, silver_base, MANIFEST)
    return spark.createDataFrame([], MANIFEST_SCHEMA) if found is None else found


def changed_days(before: DataFrame, now: DataFrame) -> DataFrame:
    """(table, dt) of the days that came, went or changed."""
    b = before.select("table", "dt", F.struct("n_rows", "digest").alias("_b"))
    n = now.select("table", "dt", F.struct("n_rows", "digest").alias("_n"))
    return b.join(n, ["table", "dt"], "full").filter(~F.col("_b").eqNullSafe(F.col("_n"))).select("table", "dt")


def _days_around(changed: list[str], before: int, after: int) -> set[str]:
    return {(date.fromisoformat(d) + timedelta(days=i)).isoformat() for d in changed for i in range(-before, after + 1)}


def _moved_days(spark: SparkSession, raw_base: str, silver_base: str, days: list[str]) -> set[str]:
    """Days whose canonical rows depend on the units that the changed assignment days hold or held."""
    raw = read_all(spark, raw_base, "fact_assignment")
    silver = read_all(spark, silver_base, "fact_assignment_canonical")
    keys = list(assign.KEY)
    parts = []
    if raw is not None:
        raw = jobs.normalize(raw)
        parts.append(raw.filter(F.col("dt").isin(days)).select(*keys))
    if silver is not None:
        parts.append(silver.filter(F.col("dt").isin(days)).select(*keys))
    if not parts:
        return set()
    touched = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    touched = touched.distinct()
    found: set[str] = set()
    for table in (raw, silver):
        if table is not None:
            rows = table.join(touched, keys, "left_semi").select(F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt"))
            found |= {r.dt for r in rows.distinct().collect()}  # a day list, not data
    return found


def days_to_rebuild(
    spark: SparkSession, raw_base: str, silver_base: str, changed: DataFrame, cfg: ExperimentConfig = DEFAULT
) -> list[str]:
    """Assignment days to rerun, oldest first."""
    by: dict[str, list[str]] = {}
    for r in changed.collect():  # one row a changed day
        by.setdefault(r.table, []).append(r.dt)
    window, after = cfg.max_days_after_assignment + 1, cfg.conversion_window_days
    days = set(by.get("fact_assignment", []))
    if days:
        days |= _moved_days(spark, raw_base, silver_base, sorted(days))
    grace = -(-cfg.pre_assignment_grace_minutes // 1440)
    days |= _days_around(by.get("fact_exposure", []), window, grace)
    # An outcome's anchor is the assignment or a first exposure in its window.
    days |= _days_around(by.get("fact_event", []), window + after, 0)
    raw = read_all(spark, raw_base, "fact_assignment")
    silver = read_all(spark, silver_base, "fact_assignment_canonical")
    own: set[str] = set()
    for table in (raw, silver):
        if table is not None:
            dts = table.select(F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt")).distinct()
            own |= {r.dt for r in dts.collect()}
    return sorted(days & own)


def catch_up(
    spark: SparkSession, raw_base: str, silver_base: str, gold_base: str, cfg: ExperimentConfig = DEFAULT
) -> list[str]:
    """Bring silver and gold up to the raw tables; returns the days that were rebuilt."""
    now = cut_lineage(raw_digests(spark, raw_base))
    days = days_to_rebuild(spark, raw_base, silver_base, changed_days(read_manifest(spark, silver_base), now), cfg)
    conversions = jobs.read_conversions(spark, raw_base, cfg)
    for dt in days:
        jobs.run_day(spark, raw_base, silver_base, gold_base, conversions, dt, cfg)
    now.write.mode("overwrite").parquet(f"{silver_base.rstrip('/')}/{MANIFEST}")
    return days
