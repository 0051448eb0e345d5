"""As-of matches by sort and carry: each marker learns what its unit's events did before it, and which comes next.

Markers and events are one stream, range-partitioned by unit and time, so a unit of any size, even on one day,
is many partitions. Inside a partition running windows count the events before a marker and find the next one;
what crosses a partition's edge is carried by a table of the units that lie in several partitions (at most two rows an
edge, so it is broadcast). No marker is spread over days and no marker meets more than one event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.time import plus_days
from abx.operators.outcomes import ANCHOR_KEY, REVENUE_SUM_TYPE
from abx.session import cut_lineage


def carry(
    markers: DataFrame,
    events: DataFrame,
    at: str,
    unit: str = "unit_id",
    event_at: str = "occurred_at",
    value: Column | None = None,
) -> DataFrame:
    """The marker rows with ``events_before`` and ``value_before`` (events of the unit before the marker's time, and the
    exact sum of their values) and ``next_at`` (the first event at or after it, null if none).

    A marker without unit or time matches nothing: 0 events, null value and next event. Events without unit or time are
    no events.
    """
    value = F.lit(None) if value is None else value
    marks = markers.select(
        F.col(unit).alias("_u"), F.col(at).alias("_t"), F.lit(0).alias("_event"), F.struct(*[F.col(c) for c in markers.columns]).alias("_row")
    )
    evs = events.select(
        F.col(unit).alias("_u"), F.col(event_at).alias("_t"), F.lit(1).alias("_event"), value.cast(REVENUE_SUM_TYPE).alias("_v")
    ).filter(F.col("_u").isNotNull() & F.col("_t").isNotNull())
    # Markers stand before events of the same time; the row's place spreads rows that are equal otherwise.
    stream = marks.unionByName(evs, allowMissingColumns=True).withColumn("_tie", F.monotonically_increasing_id())
    ranged = stream.repartitionByRange("_u", "_t", "_event", "_tie").drop("_tie")
    ranged = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))

    is_event = F.col("_event") == 1
    parts = ranged.filter(is_event).groupBy("_u", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_v").alias("v"), F.min("_t").alias("first")
    )
    spans = ranged.groupBy("_u").agg(F.min("_part").alias("lo"), F.max("_part").alias("hi")).filter("lo < hi")
    # Every part of a unit that lies in several, also those without events; at most two a partition edge are needed
    # by markers, and a unit between two edges has its partitions for itself.
    every = spans.select("_u", F.explode(F.sequence("lo", "hi")).alias("_part")).join(parts, ["_u", "_part"], "left")
    unit_parts = Window.partitionBy("_u")
    earlier = unit_parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = unit_parts.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = every.select(
        "_u",
        "_part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n0"),
        F.sum("v").over(earlier).alias("_v0"),
        F.min("first").over(later).alias("_next0"),
    )
    here = Window.partitionBy("_u", "_part")
    upto = here.orderBy("_t", "_event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Running from the end, so that the frame grows by one row a row.
    onward = here.orderBy(F.col("_t").desc(), F.col("_event").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranged.select(
        "_u",
        "_part",
        "_t",
        "_event",
        "_row",
        F.count(F.when(is_event, 1)).over(upto).alias("_n"),
        F.sum("_v").over(upto).alias("_sum"),
        F.min(F.when(is_event, F.col("_t"))).over(onward).alias("_next"),
    ).filter(F.col("_event") == 0)
    out = seen.join(F.broadcast(edges), ["_u", "_part"], "left")
    known = F.col("_u").isNotNull() & F.col("_t").isNotNull()
    total = F.when(
        F.col("_sum").isNotNull() | F.col("_v0").isNotNull(),
        F.coalesce(F.col("_sum"), F.lit(0)) + F.coalesce(F.col("_v0"), F.lit(0)),
    )
    return out.select(
        "_row.*",
        F.when(known, F.col("_n") + F.coalesce(F.col("_n0"), F.lit(0))).otherwise(F.lit(0)).alias("events_before"),
        F.when(known, total.cast(REVENUE_SUM_TYPE)).alias("value_before"),
        F.when(known, F.coalesce(F.col("_next"), F.col("_next0"))).alias("next_at"),
    )


def first_match_after(anchors: DataFrame, events: DataFrame, anchor_col: str = "anchor_at") -> DataFrame:
    """The anchor rows with ``next_at``, the unit's first event at or after the anchor, however late."""
    return carry(anchors, events, anchor_col).drop("events_before", "value_before")


def window_outcomes(
    anchors: DataFrame,
    conversions: DataFrame,
    start_days: int,
    end_days: int,
    cfg: ExperimentConfig = DEFAULT,
    anchor_col: str = "anchor_at",
    key: tuple[str, ...] = ANCHOR_KEY,
) -> DataFrame:
    """``outcomes.window_outcomes`` (``first_at``, ``n_events``, ``revenue`` in the half-open window) from two markers an
    anchor: what lies between them is the difference of what lies before them."""
    revenue = F.col("revenue") if "revenue" in conversions.columns else F.lit(None)
    ends = F.array(
        F.struct(F.lit(False).alias("is_end"), plus_days(F.col(anchor_col), start_days).alias("mark_at")),
        F.struct(F.lit(True).alias("is_end"), plus_days(F.col(anchor_col), end_days).alias("mark_at")),
    )
    names = [f"_k{i}" for i in range(len(key))]
    marks = anchors.select(*[F.col(c).alias(n) for c, n in zip(key, names, strict=True)], "unit_id", F.inline(ends))
    seen = carry(marks, conversions, "mark_at", value=revenue)
    is_end = F.col("is_end")
    n = F.sum(F.when(is_end, F.col("events_before")).otherwise(-F.col("events_before")))
    value = F.coalesce(F.col("value_before"), F.lit(0))
    found = seen.groupBy(*names).agg(
        n.cast("long").alias("n_events"),
        F.max(F.when(~is_end, F.col("next_at"))).alias("first_at"),
        F.sum(F.when(is_end, value).otherwise(-value)).cast("double").alias("revenue"),
    )
    some = F.col("n_events") > 0
    found = found.select(
        *names, F.when(some, F.col("first_at")).alias("first_at"), "n_events", F.when(some, F.col("revenue")).alias("revenue")
    )
    same = [F.col(c) == F.col(k) for c, k in zip(key, names, strict=True)]
    out = anchors.join(found, same, "left").drop(*names)
    return out.withColumn("n_events", F.coalesce("n_events", F.lit(0)).cast("long"))
