"""The validation-status label as one reusable Column function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abx.functions.util import col_of

# Status labels in CASE priority order.
STATUS_NO_EXPOSURE = "no_exposure"
STATUS_MULTI = "multi_variation_exposure"
STATUS_PRE = "pre_assignment_exposure"
STATUS_OUTSIDE = "exposure_outside_window"
STATUS_MISMATCH = "variant_mismatch"
STATUS_VALID = "valid"
STATUS_OTHER = "invalid_other"
STATUS_LABELS = (
    STATUS_NO_EXPOSURE,
    STATUS_MULTI,
    STATUS_PRE,
    STATUS_OUTSIDE,
    STATUS_MISMATCH,
    STATUS_VALID,
    STATUS_OTHER,
)


def validation_status(
    has_any_exposure="has_any_exposure",
    has_multiple="has_multiple_variations_exposed",
    is_pre="is_pre_assignment_exposure",
    outside="exposure_outside_window",
    mismatch="is_variant_mismatch",
    valid="has_valid_exposure",
) -> Column:
    """First matching rule wins; comparisons with ``= true/false`` so null falls through."""
    return (
        F.when(col_of(has_any_exposure) == F.lit(False), F.lit(STATUS_NO_EXPOSURE))
        .when(col_of(has_multiple) == F.lit(True), F.lit(STATUS_MULTI))
        .when(col_of(is_pre) == F.lit(True), F.lit(STATUS_PRE))
        .when(col_of(outside) == F.lit(True), F.lit(STATUS_OUTSIDE))
        .when(col_of(mismatch) == F.lit(True), F.lit(STATUS_MISMATCH))
        .when(col_of(valid) == F.lit(True), F.lit(STATUS_VALID))
        .otherwise(F.lit(STATUS_OTHER))
    )
