"""Run parameters shared by every operator.

One frozen dataclass replaces the reference's scattered job flags and model variables;
values reach Spark only as literals (``F.lit``), never by string formatting into SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ExperimentConfig:
    # Fixed defaults, equal to the reference's defaults.
    pre_assignment_grace_minutes: int = 5
    max_days_after_assignment: int = 7
    conversion_window_days: int = 7
    control_variant_id: str = "control"
    primary_metric_id: str = "conversion_7d"
    exposure_event_name: str = "experiment_exposed"
    conversion_event_name: str = "purchase"
    alpha: float = 0.05
    min_sample_per_variant: int = 30
    # Guardrail thresholds (ADR defaults).
    srm_max_deviation_pct: float = 3.0
    srm_min_p_value: float = 0.01
    # Exposure-health bands of the audit view.
    health_critical_below: float = 0.7
    health_warning_below: float = 0.9
    # Labels of the validation status, in CASE priority order.
    status_labels: tuple[str, ...] = field(
        default=(
            "no_exposure",
            "multi_variation_exposure",
            "pre_assignment_exposure",
            "exposure_outside_window",
            "variant_mismatch",
            "valid",
            "invalid_other",
        )
    )


DEFAULT = ExperimentConfig()
