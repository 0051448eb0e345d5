"""Staging: projection, filter and key normalization of raw event feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.util import coalesce_present, null_of

TIME_CANDIDATES = ("occurred_at", "event_timestamp", "timestamp")
UNIT_CANDIDATES = ("unit_id", "user_id", "account_id")


def bag_get(df: DataFrame, bag: str, key: str) -> Column | None:
    """Tolerant read of ``key`` from an attribute bag column, as string; null when unusable.

    JSON strings use ``get_json_object`` (null on malformed JSON); maps use ``element_at``
    (``try_element_at``: null on a missing key); structs read the field when present;
    variants use ``try_variant_get``. Returns None when the bag column is absent.
    """
    if bag not in df.columns:
        return None
    dt = df.schema[bag].dataType
    c = F.col(bag)
    if isinstance(dt, T.StringType):
        return F.get_json_object(c, f"$.{key}")
    if isinstance(dt, T.MapType):
        return F.try_element_at(c, F.lit(key)).cast("string")
    if isinstance(dt, T.StructType):
        return c.getField(key).cast("string") if key in dt.fieldNames() else None
    if isinstance(dt, T.VariantType):
        return F.try_variant_get(c, f"$.{key}", "string")
    return None


def _present(*cands):
    return [c for c in cands if c is not None]


def stage_exposures(events: DataFrame, cfg: ExperimentConfig = DEFAULT, event_name: str | None = None) -> DataFrame:
    """Exposure events with normalized keys; the variant may stay null.

    Precedence: time = occurred_at -> event_timestamp -> timestamp; unit = unit_id -> user_id
    -> account_id -> properties.user_id; experiment / variant = column -> properties ->
    event_properties. Rows without experiment, unit or time are dropped.
    Output: event_id, experiment_id, unit_id, variant_id, exposed_at, ingested_at.
    """
    name = event_name or cfg.exposure_event_name
    src = events.filter(F.col("event_name") == F.lit(name))
    occurred = coalesce_present(src, TIME_CANDIDATES)
    unit = coalesce_present(src, list(UNIT_CANDIDATES) + _present(bag_get(src, "properties", "user_id")), "string")
    exp = coalesce_present(
        src,
        ["experiment_id"]
        + _present(bag_get(src, "properties", "experiment_id"), bag_get(src, "event_properties", "experiment_id")),
        "string",
    )
    var = coalesce_present(
        src,
        ["variation_id", "variant_id"]
        + _present(bag_get(src, "properties", "variation_id"), bag_get(src, "event_properties", "variation_id")),
        "string",
    )
    ingested = F.col("ingested_at") if "ingested_at" in src.columns else null_of("timestamp_ntz")
    out = src.select(
        F.col("event_id").cast("string").alias("event_id"),
        exp.alias("experiment_id"),
        unit.alias("unit_id"),
        var.alias("variant_id"),
        occurred.alias("exposed_at"),
        ingested.alias("ingested_at"),
    )
    return out.filter(
        F.col("experiment_id").isNotNull() & F.col("unit_id").isNotNull() & F.col("exposed_at").isNotNull()
    )


def stage_conversions(events: DataFrame, cfg: ExperimentConfig = DEFAULT, event_name: str | None = None) -> DataFrame:
    """Conversion events: unit precedence stops at account_id (no attribute-bag fallback).

    Output: event_id, unit_id, occurred_at, event_name (+ revenue when present).
    """
    name = event_name or cfg.conversion_event_name
    src = events.filter(F.col("event_name") == F.lit(name))
    cols = [
        F.col("event_id").cast("string").alias("event_id"),
        coalesce_present(src, UNIT_CANDIDATES, "string").alias("unit_id"),
        coalesce_present(src, TIME_CANDIDATES).alias("occurred_at"),
        F.col("event_name"),
    ]
    if "revenue" in src.columns:
        cols.append(F.col("revenue"))
    out = src.select(*cols)
    return out.filter(F.col("unit_id").isNotNull() & F.col("occurred_at").isNotNull())


# Surrogate exposure id = sha2-256 over these fields joined by two pipes.
EXPOSURE_ID_SEPARATOR = "||"
EXPOSURE_ID_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def exposure_event_id(exposures: DataFrame, time_col: str = "exposed_at") -> Column:
    """sha2-256 of experiment || unit || variant || time || event type.

    ``concat_ws`` skips nulls (a null field can collide; strict staging removes null keys).
    Time is formatted explicitly, so the id does not depend on engine string casts.
    """
    return F.sha2(
        F.concat_ws(
            EXPOSURE_ID_SEPARATOR,
            F.col("experiment_id"),
            F.col("unit_id"),
            F.col("variant_id"),
            F.date_format(F.col(time_col), EXPOSURE_ID_TIME_FORMAT),
            F.col("exposure_event_type"),
        ),
        256,
    )


def stage_exposures_strict(raw: DataFrame) -> DataFrame:
    """Batch-job staging: add the surrogate id; experiment, unit, time **and variant** non-null."""
    return (
        raw.select("experiment_id", "unit_id", "variant_id", "exposed_at", "exposure_event_type")
        .withColumn("exposure_event_id", exposure_event_id(raw))
        .dropna(subset=["experiment_id", "unit_id", "exposed_at", "variant_id"])
    )
