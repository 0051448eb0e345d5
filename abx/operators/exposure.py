"""Exposure dedupe and validation.

Validation is planned as **one** left join of canonical assignments to deduped exposures,
followed by **one** aggregation per experiment x unit that computes, side by side:

- first exposure of any time          ``min(struct(time, event_id, variant))``
- first exposure after assigned-grace same, filtered by the time test (no second join)
- event count and distinct-variant count

The deduped side holds at most one row per variant for a unit, so the join cannot fan out,
and the aggregation runs on the join's partitioning (no extra exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.status import validation_status
from abx.functions.time import minus_minutes, plus_days, seconds_between
from abx.functions.util import flag

UNIT_KEY = ("experiment_id", "unit_id")
DEDUPE_KEY = ("experiment_id", "unit_id", "variant_id")


def _top1(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_exposures(staged: DataFrame) -> DataFrame:
    """Earliest event per experiment x unit x variant (a null variant is one group).

    Order: exposed_at, null ingested_at last, ingested_at, event_id. The ``= 1`` filter lets
    Spark cut each hot key to one row per map task before the shuffle (partial WindowGroupLimit).
    """
    order = [
        F.col("exposed_at").asc_nulls_last(),
        F.col("ingested_at").asc_nulls_last(),
        F.col("event_id").asc_nulls_last(),
    ]
    return _top1(staged, DEDUPE_KEY, order)


def dedupe_exposures_post_only(
    staged: DataFrame, assignments: DataFrame, cfg: ExperimentConfig = DEFAULT
) -> DataFrame:
    """The same dedupe over events from the unit's assignment (less the grace) on: an early event does
    not hide a later one that counts. Events of units without an assignment are left out."""
    known = assignments.select(*UNIT_KEY, "assigned_at")
    since = staged.join(known, list(UNIT_KEY)).filter(
        F.col("exposed_at") >= minus_minutes("assigned_at", cfg.pre_assignment_grace_minutes)
    )
    return dedupe_exposures(since.select(*staged.columns))


def dedupe_exposures_strict(staged_strict: DataFrame) -> DataFrame:
    """Batch-job dedupe: earliest per experiment x unit x variant by time, surrogate id."""
    order = [F.col("exposed_at").asc_nulls_last(), F.col("exposure_event_id").asc_nulls_last()]
    return _top1(staged_strict, DEDUPE_KEY, order)


def exposure_stats(deduped: DataFrame) -> DataFrame:
    """Per experiment x unit: event count and distinct non-null variant count."""
    return deduped.groupBy(*UNIT_KEY).agg(
        F.count(F.lit(1)).alias("exposure_event_count"),
        F.count_distinct("variant_id").alias("exposure_variation_count"),
    )


def _first(cond: Column | None, time_col: str, id_col: str) -> Column:
    s = F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("id"), F.col("variant_id").alias("v"))
    base = F.col(time_col).isNotNull()
    # The time test is required: a struct holding a null field is itself non-null and would
    # sort first in min(); unmatched left-join rows must not count as an exposure.
    keep = base if cond is None else (base & cond)
    return F.min(F.when(keep, s))


def first_exposures(
    assignments: DataFrame,
    deduped: DataFrame,
    cfg: ExperimentConfig = DEFAULT,
    id_col: str = "event_id",
) -> DataFrame:
    """Assignments left join deduped exposures -> one row per assignment with both firsts.

    Output: experiment_id, unit_id, assigned_variant_id, assigned_at, [dt], fa (struct t/id/v of
    first any exposure), fp (first exposure at or after assigned_at - grace), exposure_event_count,
    exposure_variation_count (null when the unit has no exposure, as a left join to stats gives).
    """
    a_cols = [
        F.col("experiment_id"),
        F.col("unit_id"),
        F.col("variant_id").alias("assigned_variant_id"),
        F.col("assigned_at"),
    ]
    extra = ["dt"] if "dt" in assignments.columns else []
    a = assignments.select(*a_cols, *extra)
    e = deduped.select(
        "experiment_id",
        "unit_id",
        "variant_id",
        F.col("exposed_at"),
        F.col(id_col),
    )
    j = a.join(e, list(UNIT_KEY), "left")
    grace_cut = minus_minutes(F.col("assigned_at"), cfg.pre_assignment_grace_minutes)
    n = F.count("exposed_at")
    return j.groupBy(*UNIT_KEY, "assigned_variant_id", "assigned_at", *extra).agg(
        _first(None, "exposed_at", id_col).alias("fa"),
        _first(F.col("exposed_at") >= grace_cut, "exposed_at", id_col).alias("fp"),
        F.when(n > 0, n).alias("exposure_event_count"),
        F.when(n > 0, F.count_distinct("variant_id")).alias("exposure_variation_count"),
    )


def validate_exposures(
    assignments: DataFrame,
    deduped: DataFrame,
    cfg: ExperimentConfig = DEFAULT,
    mode: str = "first_post",
    id_col: str = "event_id",
) -> DataFrame:
    """Exposure validation, one row per experiment x unit.

    ``mode="first_post"`` (warehouse model): timing, window and variant tests use the first
    exposure at or after assigned_at - grace; the pre-assignment test uses the first exposure
    of any time; ``has_valid_exposure`` does not test pre-assignment.
    ``mode="first_any"`` (batch job): every test uses the first exposure of any time and
    ``has_valid_exposure`` = exposed and no flag raised.
    """
    if mode not in ("first_post", "first_any"):
        raise ValueError(f"mode must be 'first_post' or 'first_any', got {mode!r}")
    fe = first_exposures(assignments, deduped, cfg, id_col)
    assigned = F.col("assigned_at")
    grace_cut = minus_minutes(assigned, cfg.pre_assignment_grace_minutes)
    window_end = plus_days(assigned, cfg.max_days_after_assignment)
    fa_t, fa_v = F.col("fa.t"), F.col("fa.v")
    fp_t, fp_v = F.col("fp.t"), F.col("fp.v")
    multi = flag(F.col("exposure_variation_count") > 1)
    has_any = fa_t.isNotNull()
    has_post = fp_t.isNotNull()

    if mode == "first_post":
        first_t, first_v, first_id = fp_t, fp_v, F.col("fp.id")
        valid = (
            F.when(fp_t.isNull(), F.lit(False))
            .when(fp_t > window_end, F.lit(False))
            .when(fp_v != F.col("assigned_variant_id"), F.lit(False))
            .when(F.col("exposure_variation_count") > 1, F.lit(False))
            .otherwise(F.lit(True))
        )
        is_pre = F.when(fa_t.isNull(), F.lit(False)).when(fa_t < grace_cut, F.lit(True)).otherwise(F.lit(False))
        mismatch = (
            F.when(fp_t.isNull(), F.lit(False))
            .when(fp_v != F.col("assigned_variant_id"), F.lit(True))
            .otherwise(F.lit(False))
        )
        outside = F.when(fp_t.isNull(), F.lit(False)).when(fp_t > window_end, F.lit(True)).otherwise(F.lit(False))
        delay = seconds_between(assigned, fp_t)
    else:
        first_t, first_v, first_id = fa_t, fa_v, F.col("fa.id")
        is_pre = flag(has_any & (fa_t < grace_cut))
        outside = flag(has_any & (fa_t > window_end))
        mismatch = flag(has_any & (fa_v != F.col("assigned_variant_id")))
        valid = flag(has_any & ~is_pre & ~outside & ~mismatch & ~multi)
        delay = F.when(has_any, seconds_between(assigned, fa_t))

    out = fe.select(
        *UNIT_KEY,
        "assigned_variant_id",
        "assigned_at",
        fa_t.alias("first_exposure_any_at"),
        fa_v.alias("first_exposure_any_variant_id"),
        F.col("fa.id").alias("first_exposure_any_event_id"),
        first_t.alias("first_exposure_at"),
        first_v.alias("first_exposure_variant_id"),
        first_id.alias("first_exposure_event_id"),
        delay.alias("exposure_delay_seconds"),
        "exposure_event_count",
        "exposure_variation_count",
        has_any.alias("has_any_exposure"),
        has_post.alias("has_post_assignment_exposure"),
        is_pre.alias("is_pre_assignment_exposure"),
        outside.alias("exposure_outside_window"),
        mismatch.alias("is_variant_mismatch"),
        multi.alias("has_multiple_variations_exposed"),
        valid.alias("has_valid_exposure"),
        *(["dt"] if "dt" in fe.columns else []),
    )
    return out.withColumn("validation_status", validation_status())


def validate_exposures_any(assignments: DataFrame, deduped_strict: DataFrame, cfg: ExperimentConfig = DEFAULT):
    """Batch-job validation (first exposure of any time), over strictly staged exposures."""
    return validate_exposures(assignments, deduped_strict, cfg, mode="first_any", id_col="exposure_event_id")
