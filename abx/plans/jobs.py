"""Daily batch jobs over a raw -> silver -> gold layout (one ``dt=YYYY-MM-DD`` partition per run).

- ``build_assignments``        raw fact_assignment  -> silver canonical assignments + quality metrics
- ``build_exposure_validation`` raw fact_exposure    -> silver deduped exposures, validation;
                                                         gold daily quality
- ``build_results``            silver validation + conversions -> gold outcomes, metrics, results

Each stage is written with dynamic partition overwrite (re-running a day replaces only that
day), and the next stage reads the written table back instead of recomputing the lineage: a
lost executor then costs one stage, not the whole chain, and no stage is computed twice.
Raw inputs may use the reference's column names (``user_id``, ``assignment_time_utc``,
``exposure_time_utc``); they are mapped once at read time.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.util import require_columns
from abx.operators import assign, cohort, exposure, guardrails, outcomes, quality, results, stage
from abx.operators.contracts import unique_key_violations
from abx.sources.io import read_day, read_days, write_day

# Raw-layer column names of the reference and the names used here.
RAW_RENAMES = {
    "user_id": "unit_id",
    "assignment_time_utc": "assigned_at",
    "exposure_time_utc": "exposed_at",
    "event_time_utc": "occurred_at",
}


def normalize(df: DataFrame) -> DataFrame:
    """Rename reference raw columns to the library's names (no-op for already-normalized data)."""
    out = df
    for old, new in RAW_RENAMES.items():
        if old in out.columns and new not in out.columns:
            out = out.withColumnRenamed(old, new)
    return out


CANONICAL_COLUMNS = {"experiment_id", "unit_id", "variant_id", "assigned_at"}


def has_day(spark: SparkSession, base: str, table: str, dt: str) -> bool:
    """Whether the table has rows of the day (reads at most one)."""
    return not read_day(spark, base, table, dt).isEmpty()


def build_assignments(spark: SparkSession, raw_base: str, silver_base: str, dt: str) -> None:
    """Canonical assignments of the day: units whose earliest assignment of all days falls on it.

    Units known from earlier days leave by an anti join on their keys, so a unit assigned again
    later keeps one row over all days. The written table must hold every key once.
    """
    raw = normalize(read_day(spark, raw_base, "fact_assignment", dt))
    require_columns(raw, {*CANONICAL_COLUMNS, "dt"}, "raw assignments")
    earlier = normalize(read_days(spark, raw_base, "fact_assignment", None, dt)).filter(F.col("dt") < F.lit(dt))
    new = raw.join(earlier.select(*assign.KEY).distinct(), list(assign.KEY), "left_anti")
    write_day(assign.canonical_assignments(new), silver_base, "fact_assignment_canonical", dt=dt)
    write_day(assign.assignment_quality(raw), silver_base, "metrics_assignment_quality", dt=dt)
    written = read_day(spark, silver_base, "fact_assignment_canonical", dt)
    repeated = unique_key_violations(written, assign.KEY).limit(5).collect()
    if repeated:
        raise ValueError(f"Canonical assignments of {dt} repeat keys, e.g. {[tuple(r) for r in repeated]}")


def build_exposure_validation(
    spark: SparkSession,
    raw_base: str,
    silver_base: str,
    gold_base: str,
    dt: str,
    cfg: ExperimentConfig = DEFAULT,
) -> None:
    """Deduped exposures and both validations of the units assigned on the day.

    Exposures are read from the day of the grace before until the last day of the window after, one
    more for events past its end, so a unit exposed after midnight or too late is seen as such. The
    day is therefore final once those days have arrived; a rerun replaces it.
    """
    assignments = read_day(spark, silver_base, "fact_assignment_canonical", dt)
    require_columns(assignments, CANONICAL_COLUMNS, "canonical assignments")
    day = date.fromisoformat(dt)
    first = day - timedelta(days=-(-cfg.pre_assignment_grace_minutes // 1440))
    last = day + timedelta(days=cfg.max_days_after_assignment + 1)
    raw = normalize(read_days(spark, raw_base, "fact_exposure", first.isoformat(), last.isoformat()))
    require_columns(
        raw, {"experiment_id", "unit_id", "variant_id", "exposed_at", "exposure_event_type", "dt"}, "raw exposures"
    )
    own = stage.stage_exposures_strict(raw).join(assignments.select(*assign.KEY), list(assign.KEY), "left_semi")
    deduped = exposure.dedupe_exposures_strict(own)
    write_day(deduped, silver_base, "int_experiment_exposures_deduped", dt=dt)
    deduped = read_day(spark, silver_base, "int_experiment_exposures_deduped", dt)
    validation = exposure.validate_exposures_any(assignments, deduped, cfg)
    write_day(validation, silver_base, "int_experiment_exposure_validation", dt=dt)
    validation = read_day(spark, silver_base, "int_experiment_exposure_validation", dt)
    write_day(quality.quality_daily(validation), gold_base, "fct_experiment_quality_metrics_daily", dt=dt)
    # The warehouse model of the same day: the first exposure after assignment counts.
    events = deduped.select(
        F.col("exposure_event_id").alias("event_id"), *exposure.DEDUPE_KEY, "exposed_at", F.lit(None).cast("timestamp_ntz").alias("ingested_at")
    )
    post = exposure.validate_exposures(assignments, events, cfg, mode="first_post")
    write_day(post, silver_base, "int_experiment_exposure_validation_post", dt=dt)
    post = read_day(spark, silver_base, "int_experiment_exposure_validation_post", dt)
    write_day(quality.quality_daily_post(post), gold_base, "fct_experiment_exposure_quality_daily", dt=dt)


def build_results(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    conversions: DataFrame,
    dt: str,
    cfg: ExperimentConfig = DEFAULT,
    anchor: str = "assignment",
    raw_base: str | None = None,
) -> None:
    """Outcomes for the day's cohort, then metrics and results (tiny tables) into gold.

    Only conversions that can fall in a window of this cohort are read: the cohort's anchor range
    (one tiny aggregate, one row to the driver) becomes literal time predicates on the conversion
    scan, which Parquet pushes down to row groups. The bound comes from the data, not from the
    partition date, so late-arriving rows and exposures far past assignment stay exact.
    """
    validation = read_day(spark, silver_base, "int_experiment_exposure_validation", dt)
    coh = cohort.cohort(validation)
    anchor_col = "assigned_at" if anchor == "assignment" else "first_exposure_at"
    conv = conversion_time_bound(normalize(conversions), coh, anchor_col, cfg)
    out = outcomes.conversion_outcomes(coh, conv, cfg, anchor=anchor)
    write_day(out, gold_base, "int_experiment_metric_outcomes", dt=dt)
    out = read_day(spark, gold_base, "int_experiment_metric_outcomes", dt)
    units = outcomes.unit_outcomes(coh, conversion_time_bound(normalize(conversions), coh, None, cfg), cfg)
    write_day(units, gold_base, "fct_experiment_unit_outcomes", dt=dt)
    units = read_day(spark, gold_base, "fct_experiment_unit_outcomes", dt)
    mbv = results.metric_by_variant(out)
    write_day(results.results(mbv, cfg), gold_base, "fct_experiment_results", dt=dt)
    report = quality_report(spark, silver_base, gold_base, dt, cfg, raw_base)
    write_day(report, gold_base, "fct_experiment_quality_report", dt=dt)
    report = read_day(spark, gold_base, "fct_experiment_quality_report", dt)
    table = read_day(spark, gold_base, "fct_experiment_results", dt).drop("dt")
    write_day(guardrails.gated_results(table, report), gold_base, "fct_experiment_results_gated", dt=dt)


def planned_variants(spark: SparkSession, raw_base: str | None, experiments: DataFrame) -> DataFrame:
    """The variant dimension of the raw layer (its last day of each arm), and the default two arms for experiments that it
    does not know."""
    default = assign.experiment_variants(experiments)
    if raw_base is None:
        return default
    path = f"{raw_base.rstrip('/')}/dim_experiment_variant"
    try:
        dim = spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return default
    day = F.col("dt") if "dt" in dim.columns else F.lit(None)
    last = F.max(F.struct(day.cast("string").alias("dt"), F.col("allocation_pct").cast("double").alias("allocation_pct")))
    plan = dim.groupBy("experiment_id", "variant_id").agg(last["allocation_pct"].alias("allocation_pct"))
    rest = default.join(plan.select("experiment_id").distinct(), "experiment_id", "left_anti")
    return plan.unionByName(rest.select("experiment_id", "variant_id", "allocation_pct"))


def quality_report(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    dt: str,
    cfg: ExperimentConfig = DEFAULT,
    raw_base: str | None = None,
) -> DataFrame:
    """Guards over all cohorts up to day ``dt``, from the written tables: repeats in the raw assignments (in the
    canonical ones where no raw layer is given), arms against the planned shares, first exposures and outcomes against the
    analysis start (first exposure after assignment, else assignment), and repeated outcome rows over all days."""
    canonical = read_days(spark, silver_base, "fact_assignment_canonical", None, dt)
    validation = read_days(spark, silver_base, "int_experiment_exposure_validation", None, dt)
    out = read_days(spark, gold_base, "int_experiment_metric_outcomes", None, dt)
    units = read_days(spark, gold_base, "fct_experiment_unit_outcomes", None, dt)
    raw = canonical if raw_base is None else normalize(read_days(spark, raw_base, "fact_assignment", None, dt))
    experiments = canonical.select("experiment_id").distinct()
    arms = planned_variants(spark, raw_base, experiments)
    # A unit has one start, so the outcome rows of a unit stay as many as they are.
    start = units.groupBy(*assign.KEY).agg(F.min("anchor_at").alias("analysis_start_at"))
    return guardrails.experiment_quality_report(
        experiments,
        guardrails.guard_assignment_unique(raw),
        guardrails.guard_srm(canonical, arms, cfg),
        guardrails.guard_exposure_order(validation),
        guardrails.guard_outcome_order(out.join(start, list(assign.KEY))),
        guardrails.guard_outcome_grain(units),
        guardrails.guard_min_sample(canonical, arms, cfg),
        dt,
    ).drop("dt")


def conversion_time_bound(
    conversions: DataFrame, cohort_df: DataFrame, anchor_col: str | None, cfg: ExperimentConfig = DEFAULT
) -> DataFrame:
    """Keep conversions in [min anchor, max anchor + conversion window) of the cohort; without an
    anchor column, the first exposure or else the assignment is the anchor."""
    anchor = F.col(anchor_col) if anchor_col else F.coalesce(F.col("first_exposure_at"), F.col("assigned_at"))
    lo, hi = cohort_df.agg(F.min(anchor), F.max(anchor)).first()
    if lo is None:
        return conversions.filter(F.lit(False))
    upper = F.lit(hi).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(int(cfg.conversion_window_days)))
    return conversions.filter((F.col("occurred_at") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("occurred_at") < upper))


def read_conversions(spark: SparkSession, raw_base: str, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Conversion events from the raw ``fact_event`` table (event type filter pushed to the scan;
    the cohort's time bound is added by ``build_results``)."""
    base = f"{raw_base.rstrip('/')}/fact_event"
    ev = normalize(spark.read.option("basePath", base).parquet(base))
    ev = ev.filter(F.col("event_type") == F.lit(cfg.conversion_event_name))
    return ev.select("event_id", "unit_id", "occurred_at", "revenue")


def run_day(
    spark: SparkSession,
    raw_base: str,
    silver_base: str,
    gold_base: str,
    conversions: DataFrame,
    dt: str,
    cfg: ExperimentConfig = DEFAULT,
) -> None:
    build_assignments(spark, raw_base, silver_base, dt)
    build_exposure_validation(spark, raw_base, silver_base, gold_base, dt, cfg)
    build_results(spark, silver_base, gold_base, conversions, dt, cfg, raw_base=raw_base)


def run_reports(spark: SparkSession, data_dir: str, out_base: str, names=None) -> list[str]:
    """Write every registered report (or ``names``) from ONE DAG whose base stages are
    checkpointed once into ``spark.checkpoint.dir``; returns the written names.

    The loop runs over report names (configuration), never over data.
    """
    from abx.plans.experiment import ExperimentDAG
    from abx.plans.registry import DAG_QUERIES

    dag = ExperimentDAG(spark, data_dir, checkpoint_stages=True)
    written = []
    for name in names or list(DAG_QUERIES):
        DAG_QUERIES[name](dag).write.mode("overwrite").parquet(f"{out_base.rstrip('/')}/{name}")
        written.append(name)
    return written
