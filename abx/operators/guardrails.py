"""Guardrails and the per-experiment quality report (specified by the reference's ADR, no code there).

Every guard returns one row per experiment. Guards aggregate first (partial aggregation before
any shuffle) and only then join, so the report joins a handful of experiment-grain tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.stats import chi2_upper_tail
from abx.functions.util import count_true

GUARDS = ("assignment_unique", "srm", "exposure_order", "outcome_order", "outcome_grain")


def guard_assignment_unique(raw_assignments: DataFrame) -> DataFrame:
    """Duplicate assignment rows (sum of count-1 per experiment x unit) on **raw** assignments."""
    per_key = raw_assignments.groupBy("experiment_id", "unit_id").agg(F.count(F.lit(1)).alias("_c"))
    g = per_key.groupBy("experiment_id").agg(
        F.sum("_c").cast("long").alias("raw_rows"),
        F.count(F.lit(1)).alias("unique_units"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("assignment_duplicates_count"),
    )
    return g.withColumn("assignment_unique_passed", F.col("assignment_duplicates_count") == 0)


def srm_arms(assignments: DataFrame, variants: DataFrame) -> DataFrame:
    """Observed against expected units per arm: a planned arm without units counts with 0 observed, an
    arm with units that is not planned with an allocation of 0 (``is_planned`` false).
    Output: experiment_id, variant_id, is_planned, observed, expected, shares."""
    obs = assignments.groupBy("experiment_id", "variant_id").agg(F.count(F.lit(1)).alias("observed"))
    arms = variants.select("experiment_id", "variant_id", "allocation_pct").join(
        obs, ["experiment_id", "variant_id"], "full"
    )
    arms = arms.select(
        "experiment_id",
        "variant_id",
        F.col("allocation_pct").isNotNull().alias("is_planned"),
        F.coalesce(F.col("allocation_pct"), F.lit(0.0)).alias("allocation_pct"),
        F.coalesce(F.col("observed"), F.lit(0)).cast("long").alias("observed"),
    )
    w = Window.partitionBy("experiment_id")  # arms of one experiment: a handful of rows
    a = arms.select(
        "*", F.sum("observed").over(w).alias("total_units"), F.sum("allocation_pct").over(w).alias("total_alloc")
    )
    exp_share = F.try_divide(F.col("allocation_pct"), F.col("total_alloc"))
    return a.select(
        "experiment_id",
        "variant_id",
        "is_planned",
        "observed",
        "total_units",
        exp_share.alias("expected_share"),
        F.try_divide(F.col("observed").cast("double"), F.col("total_units").cast("double")).alias("observed_share"),
        (F.col("total_units").cast("double") * exp_share).alias("expected"),
    )


def guard_srm(assignments: DataFrame, variants: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Sample-ratio mismatch: chi-square over arms (df = arms - 1) and the largest share deviation.

    Fails when the deviation exceeds ``cfg.srm_max_deviation_pct`` points, p < ``cfg.srm_min_p_value``,
    or an arm that is not planned holds units (named in ``unplanned_arms``).
    """
    arms = srm_arms(assignments, variants)
    dev = F.col("observed") - F.col("expected")
    contrib = F.when(F.col("expected") > 0, dev * dev / F.col("expected"))
    g = arms.groupBy("experiment_id").agg(
        F.count_if("is_planned").alias("n_arms"),
        F.array_sort(F.collect_set(F.when(~F.col("is_planned") & (F.col("observed") > 0), F.col("variant_id")))).alias(
            "unplanned_arms"
        ),
        F.first("total_units").alias("total_units"),
        F.coalesce(F.sum(contrib), F.lit(0.0)).alias("chi_square"),
        (F.max(F.abs(F.col("observed_share") - F.col("expected_share"))) * F.lit(100.0)).alias(
            "variant_allocation_deviation_pct"
        ),
    )
    g = g.withColumn("chi_square_df", (F.col("n_arms") - 1).cast("int"))
    g = g.withColumn("chi_square_p_value", chi2_upper_tail(F.col("chi_square"), F.col("chi_square_df")))
    passed = (F.coalesce(F.col("variant_allocation_deviation_pct"), F.lit(0.0)) <= F.lit(cfg.srm_max_deviation_pct)) & (
        F.coalesce(F.col("chi_square_p_value"), F.lit(1.0)) >= F.lit(cfg.srm_min_p_value)
    )
    return g.withColumn("srm_passed", passed & (F.size("unplanned_arms") == 0))


def guard_exposure_order(validation: DataFrame) -> DataFrame:
    """Units whose first exposure precedes the assignment (no grace, unlike validation)."""
    g = validation.groupBy("experiment_id").agg(
        count_true(F.col("first_exposure_any_at") < F.col("assigned_at")).alias("exposure_before_assignment_count")
    )
    return g.withColumn("exposure_order_passed", F.col("exposure_before_assignment_count") == 0)


def guard_outcome_order(outcomes: DataFrame, start_col: str = "analysis_start_at") -> DataFrame:
    """Outcomes used for a metric that occur before the analysis start (first exposure, else
    assignment). ``outcomes`` carries ``converted_at`` and the start column."""
    g = outcomes.groupBy("experiment_id").agg(
        count_true(F.col("converted_at") < F.col(start_col)).alias("outcomes_before_analysis_start_count")
    )
    return g.withColumn("outcome_order_passed", F.col("outcomes_before_analysis_start_count") == 0)


def guard_outcome_grain(unit_outcomes: DataFrame) -> DataFrame:
    """Duplicate unit-outcome rows (must be exactly one per experiment x unit)."""
    per_key = unit_outcomes.groupBy("experiment_id", "unit_id").agg(F.count(F.lit(1)).alias("_c"))
    g = per_key.groupBy("experiment_id").agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_outcome_rows_count")
    )
    return g.withColumn("outcome_grain_passed", F.col("duplicate_outcome_rows_count") == 0)


def guard_min_sample(assignments: DataFrame, variants: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Smallest arm size per experiment; below ``cfg.min_sample_per_variant`` is a warning only."""
    arms = srm_arms(assignments, variants)
    g = arms.groupBy("experiment_id").agg(
        F.min("observed").alias("min_users_per_variant"), F.max("observed").alias("max_users_per_variant")
    )
    return g.withColumn(
        "min_sample_warning", F.col("min_users_per_variant") < F.lit(cfg.min_sample_per_variant)
    )


def experiment_quality_report(
    experiments: DataFrame,
    assignment_unique: DataFrame,
    srm: DataFrame,
    exposure_order: DataFrame,
    outcome_order: DataFrame,
    outcome_grain: DataFrame,
    min_sample: DataFrame,
    dt: str,
    blocking: tuple[str, ...] = GUARDS,
) -> DataFrame:
    """One row per experiment x dt: is_valid_for_analysis, failed_guardrails, warnings, diagnostics.

    Guards of ``blocking`` decide whether an experiment is valid; the others that fail are warnings.

    The guard outputs (one row per experiment each) are stacked by name and folded with one
    ``groupBy(experiment_id)``: a single small shuffle instead of a chain of joins. Rows cover the
    experiments of ``experiments`` and of any guard; a guard without a row for an experiment
    (e.g. no outcomes) counts as passed.
    """
    parts = [
        experiments.select("experiment_id"),
        assignment_unique.select("experiment_id", "assignment_duplicates_count", "assignment_unique_passed"),
        srm.select(
            "experiment_id",
            "variant_allocation_deviation_pct",
            "chi_square",
            "chi_square_p_value",
            "unplanned_arms",
            "srm_passed",
        ),
        exposure_order.select("experiment_id", "exposure_before_assignment_count", "exposure_order_passed"),
        outcome_order.select("experiment_id", "outcomes_before_analysis_start_count", "outcome_order_passed"),
        outcome_grain.select("experiment_id", "duplicate_outcome_rows_count", "outcome_grain_passed"),
        min_sample.select("experiment_id", "min_users_per_variant", "min_sample_warning"),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    value_cols = [c for c in stacked.columns if c != "experiment_id"]
    r = stacked.groupBy("experiment_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in value_cols])

    def fail(name: str):
        return F.when(~F.coalesce(F.col(f"{name}_passed"), F.lit(True)), F.lit(name))

    unknown = sorted(set(blocking) - set(GUARDS))
    if unknown:
        raise ValueError(f"Unknown guardrails: {unknown}")
    failed = F.array_compact(F.array(*[fail(g) for g in GUARDS if g in blocking]))
    warnings = F.array_compact(
        F.array(
            *[fail(g) for g in GUARDS if g not in blocking],
            F.when(F.coalesce(F.col("min_sample_warning"), F.lit(False)), F.lit("min_sample")),
        )
    )
    return r.select(
        "experiment_id",
        F.to_date(F.lit(dt)).alias("dt"),
        (F.size(failed) == 0).alias("is_valid_for_analysis"),
        failed.cast("array<string>").alias("failed_guardrails"),
        warnings.alias("warnings"),
        "assignment_duplicates_count",
        "variant_allocation_deviation_pct",
        "chi_square_p_value",
        "unplanned_arms",
        "exposure_before_assignment_count",
        "outcomes_before_analysis_start_count",
        "duplicate_outcome_rows_count",
        "min_users_per_variant",
    )


def gated_results(results: DataFrame, report: DataFrame) -> DataFrame:
    """Results of experiments valid for analysis only (left semi join; results columns unchanged)."""
    ok = report.filter(F.col("is_valid_for_analysis")).select("experiment_id")
    return results.join(ok, "experiment_id", "left_semi")
