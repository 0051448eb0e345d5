"""Analysis cohorts (intent-to-treat, exposed, validly exposed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.functions.util import count_true

COHORT_MODES = ("itt", "exposed", "valid")

_VALIDATION_COLS = (
    "first_exposure_at",
    "first_exposure_variant_id",
    "has_post_assignment_exposure",
    "exposure_delay_seconds",
    "has_valid_exposure",
    "validation_status",
)


def cohort(validation: DataFrame, assignments: DataFrame | None = None) -> DataFrame:
    """One row per assignment with three membership flags.

    The validation table already carries every canonical assignment, so by default no join is
    needed. Passing ``assignments`` restores the warehouse left join (assignments drive the rows).
    """
    if assignments is None:
        base = validation.select("experiment_id", "unit_id", "assigned_variant_id", "assigned_at", *_VALIDATION_COLS)
    else:
        a = assignments.select(
            "experiment_id", "unit_id", F.col("variant_id").alias("assigned_variant_id"), "assigned_at"
        )
        v = validation.select("experiment_id", "unit_id", *_VALIDATION_COLS)
        base = a.join(v, ["experiment_id", "unit_id"], "left")
    return base.select(
        "*",
        F.lit(True).alias("is_in_itt_cohort"),
        F.col("has_post_assignment_exposure").alias("is_in_exposure_cohort"),
        F.col("has_valid_exposure").alias("is_in_valid_exposure_cohort"),
    )


def cohort_members(cohort_df: DataFrame, mode: str) -> DataFrame:
    """Rows of one analysis mode; the mode is required (ITT against exposed is a choice)."""
    if mode == "itt":
        return cohort_df.filter(F.col("is_in_itt_cohort"))
    if mode == "exposed":
        return cohort_df.filter(F.col("is_in_exposure_cohort"))
    if mode == "valid":
        return cohort_df.filter(F.col("is_in_valid_exposure_cohort"))
    raise ValueError(f"mode must be one of {COHORT_MODES}, got {mode!r}")


def cohort_sizes(cohort_df: DataFrame) -> DataFrame:
    """Units per experiment x assigned variant in each analysis mode (one aggregation)."""
    return cohort_df.groupBy("experiment_id", F.col("assigned_variant_id").alias("variant_id")).agg(
        count_true(F.col("is_in_itt_cohort")).alias("itt_units"),
        count_true(F.col("is_in_exposure_cohort")).alias("exposed_units"),
        count_true(F.col("is_in_valid_exposure_cohort")).alias("valid_units"),
    )
