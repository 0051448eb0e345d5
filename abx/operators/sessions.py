"""Gap sessions: runs of a unit's events of which none follows the one before by more than the gap.

Events are first summed by time slots of the gap's length, combined in every task: two events of one slot are never
further apart than the gap, so a slot belongs to one session, and a unit has at most one row a slot however many events
it has. Slots are then joined to sessions at their edges by one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.time import epoch_micros, plus_days
from abx.functions.util import ratio

GAP_SECONDS = 1800


def sessions(
    events: DataFrame,
    gap_seconds: int = GAP_SECONDS,
    unit: str = "unit_id",
    at: str = "occurred_at",
    type_col: str | None = None,
    types: tuple[str, ...] = (),
) -> DataFrame:
    """One row a session: unit, ``session_no`` (from 1 by time), ``started_at``, ``ended_at`` (its first and last event),
    ``duration_seconds``, ``n_events`` and ``n_<type>`` for each of ``types``. An event exactly the gap after the one before
    goes on with its session. Events without unit or time are left out."""
    if gap_seconds < 1:
        raise ValueError("the gap must be at least one second")
    gap = gap_seconds * 1_000_000
    rows = events.select(
        F.col(unit).alias("unit_id"),
        F.col(at).alias("_t"),
        epoch_micros(at).alias("_us"),
        *([F.col(type_col).alias("_type")] if type_col else []),
    ).filter(F.col("unit_id").isNotNull() & F.col("_t").isNotNull())
    counts = {f"n_{t}": F.count_if(F.col("_type") == F.lit(t)) for t in types}
    slots = rows.groupBy("unit_id", F.floor(F.col("_us") / F.lit(gap)).alias("_slot")).agg(
        F.min("_t").alias("started_at"),
        F.max("_t").alias("ended_at"),
        F.min("_us").alias("_from"),
        F.max("_us").alias("_to"),
        F.count(F.lit(1)).alias("n_events"),
        *[c.alias(n) for n, c in counts.items()],
    )
    order = Window.partitionBy("unit_id").orderBy("_slot")
    breaks = F.coalesce((F.col("_from") - F.lag("_to").over(order) > F.lit(gap)).cast("int"), F.lit(1))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = slots.withColumn("_break", breaks).withColumn("session_no", F.sum("_break").over(upto))
    out = numbered.groupBy("unit_id", "session_no").agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        ((F.max("_to") - F.min("_from")) / F.lit(1e6)).alias("duration_seconds"),
        F.sum("n_events").alias("n_events"),
        *[F.sum(n).alias(n) for n in counts],
    )
    return out


def session_metrics(assignments: DataFrame, unit_sessions: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Per experiment and arm: units, units with a session, sessions and events a unit and mean duration, over sessions that
    start in ``[assigned_at, assigned_at + conversion window)``. A unit has one row a session here, not one an event."""
    a = assignments.select("experiment_id", "unit_id", "variant_id", "assigned_at")
    s = unit_sessions.select(F.col("unit_id").alias("_u"), "started_at", "duration_seconds", "n_events")
    inside = (
        (F.col("unit_id") == F.col("_u"))
        & (F.col("started_at") >= F.col("assigned_at"))
        & (F.col("started_at") < plus_days("assigned_at", cfg.conversion_window_days))
    )
    per_unit = a.join(s, inside, "left").groupBy("experiment_id", "variant_id", "unit_id").agg(
        F.count("started_at").alias("_n"), F.coalesce(F.sum("n_events"), F.lit(0)).alias("_e"), F.sum("duration_seconds").alias("_d")
    )
    return per_unit.groupBy("experiment_id", "variant_id").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.count_if(F.col("_n") > 0).alias("active_units"),
        F.sum("_n").alias("n_sessions"),
        ratio(F.sum("_n"), F.count(F.lit(1))).alias("sessions_per_unit"),
        ratio(F.sum("_e"), F.count(F.lit(1))).alias("events_per_unit"),
        ratio(F.sum("_d"), F.sum("_n")).alias("avg_duration_seconds"),
    )
