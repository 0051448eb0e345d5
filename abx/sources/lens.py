"""Experiment tables derived from the driver's ``events`` testdata (the "lens").

The testdata holds no experiment tables; they derive deterministically from ``events``
(event_id, ts TIMESTAMP_NTZ, user_id, event_type, value, props JSON string):

- ``k``             integer at ``$.k`` of ``props``
- experiment_id    ``'exp_'`` followed by ``k mod 3``
- unit_id          ``user_id`` as string
- own variant      first 8 hex digits of md5(experiment_id ':' unit_id) mod 100 < 50 -> control
- assignments      ``signup`` events (repeats exercise canonicalization)
- exposures        every ``view``/``click`` event; the other variant if k >= 84
- conversions      every ``purchase`` event; revenue = value
- identity links   ``error`` events with k >= 75 name the device they happened on; k = 99 is a shared one

Every table is a lazy projection + pushed-down filter of one ``events`` scan, so its work grows
with ``events``. ``LENS_CTES`` is the same derivation in ANSI SQL for the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.sources.io import read_table

# Fixed values of the lens.
EXPERIMENT_PREFIX = "exp_"
N_EXPERIMENTS = 3
CONTROL = "control"
TREATMENT = "treatment"
ASSIGNMENT_EVENT = "signup"
EXPOSURE_EVENTS = ("view", "click")
CONVERSION_EVENT = "purchase"
MISMATCH_MIN_K = 84
EXPOSURE_EVENT_NAME = "experiment_exposed"
LINK_EVENT = "error"
LINK_MIN_K = 75
LINK_SHARED_K = 99
LINK_BLOCK = 5
LINK_DEVICES = 24
# A device that more units use is shared and tells no one apart.
MAX_DEVICE_UNITS = 10


# A props string that is exactly one flat integer field, e.g. {"k": 69}. For that shape the
# JSON value is unambiguous, so an anchored regex reads it ~4x cheaper than a JSON parse; any
# other shape falls back to the JSON parser (CASE evaluates it only for those rows).
_FLAT_K = r'^\{\s*"k"\s*:\s*(-?[0-9]{1,9})\s*\}$'


def _k() -> Column:
    fast = F.regexp_extract(F.col("props"), _FLAT_K, 1)
    return F.when(fast != F.lit(""), fast).otherwise(F.get_json_object(F.col("props"), "$.k")).cast("int")


def _experiment_id(k: Column) -> Column:
    return F.concat(F.lit(EXPERIMENT_PREFIX), (k % F.lit(N_EXPERIMENTS)).cast("string"))


def hash_bucket(*parts: Column, modulus: int = 100) -> Column:
    """First 8 hex digits of md5(parts joined by ':') as an integer, mod ``modulus``."""
    h = F.md5(F.concat_ws(":", *parts))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(modulus)).cast("int")


def _own_variant(exp: Column, unit: Column) -> Column:
    return F.when(hash_bucket(exp, unit) < 50, F.lit(CONTROL)).otherwise(F.lit(TREATMENT))


def _with_keys(ev: DataFrame) -> DataFrame:
    k = _k()
    return ev.select(
        "event_id",
        "ts",
        "event_type",
        "value",
        k.alias("k"),
        F.col("user_id").cast("string").alias("unit_id"),
        "props",
    ).withColumn("experiment_id", _experiment_id(F.col("k")))


@dataclass
class Lens:
    raw_assignments: DataFrame
    raw_exposures: DataFrame
    conversions: DataFrame
    event_feed: DataFrame
    dim_experiment: DataFrame
    dim_variant: DataFrame


def raw_assignments(events: DataFrame) -> DataFrame:
    """(experiment_id, unit_id, variant_id, assigned_at, assignment_source, dt)."""
    ev = _with_keys(events.filter(F.col("event_type") == F.lit(ASSIGNMENT_EVENT)))
    return ev.select(
        "experiment_id",
        "unit_id",
        _own_variant(F.col("experiment_id"), F.col("unit_id")).alias("variant_id"),
        F.col("ts").alias("assigned_at"),
        F.col("event_type").alias("assignment_source"),
        F.to_date("ts").alias("dt"),
    )


def raw_exposures(events: DataFrame) -> DataFrame:
    """(event_id, experiment_id, unit_id, variant_id, exposed_at, exposure_event_type, dt)."""
    return _exposure_rows(events).drop("props")


def _exposure_rows(events: DataFrame) -> DataFrame:
    ev = _with_keys(events.filter(F.col("event_type").isin(*EXPOSURE_EVENTS)))
    own = _own_variant(F.col("experiment_id"), F.col("unit_id"))
    other = F.when(own == F.lit(CONTROL), F.lit(TREATMENT)).otherwise(F.lit(CONTROL))
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        "experiment_id",
        "unit_id",
        F.when(F.col("k") >= F.lit(MISMATCH_MIN_K), other).otherwise(own).alias("variant_id"),
        F.col("ts").alias("exposed_at"),
        F.col("event_type").alias("exposure_event_type"),
        F.to_date("ts").alias("dt"),
        "props",
    )


def conversions(events: DataFrame) -> DataFrame:
    """(event_id, unit_id, occurred_at, revenue). No experiment link, as in the reference."""
    return _conversion_rows(events).drop("props")


def _conversion_rows(events: DataFrame) -> DataFrame:
    ev = events.filter(F.col("event_type") == F.lit(CONVERSION_EVENT))
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("unit_id"),
        F.col("ts").alias("occurred_at"),
        F.col("value").alias("revenue"),
        "props",
    )


def identity_links(events: DataFrame) -> DataFrame:
    """(unit_id, identifier): the device that a unit's error report names. Units of a block of five, and of two
    neighbouring blocks, may share one of its devices; one device is open to all."""
    ev = events.filter(F.col("event_type") == F.lit(LINK_EVENT)).select("user_id", _k().alias("k"))
    block = F.floor((F.col("user_id") + F.col("k") % 2) / F.lit(LINK_BLOCK)).cast("string")
    own = F.concat(F.lit("device_"), block, F.lit("_"), (F.col("k") % LINK_DEVICES).cast("string"))
    device = F.when(F.col("k") == LINK_SHARED_K, F.lit("device_shared")).otherwise(own)
    return ev.filter(F.col("k") >= LINK_MIN_K).select(F.col("user_id").cast("string").alias("unit_id"), device.alias("identifier"))


def event_feed(events: DataFrame) -> DataFrame:
    """A warehouse-style event feed: exposure and conversion rows with an attribute bag.

    Columns: event_id, event_name, occurred_at, unit_id, experiment_id, variation_id,
    properties (the raw JSON string), revenue (conversions only), ingested_at (null: the testdata
    has no ingest time).
    """
    exp = _exposure_rows(events).select(
        "event_id",
        F.lit(EXPOSURE_EVENT_NAME).alias("event_name"),
        F.col("exposed_at").alias("occurred_at"),
        "unit_id",
        "experiment_id",
        F.col("variant_id").alias("variation_id"),
        F.col("props").alias("properties"),
        F.lit(None).cast("double").alias("revenue"),
    )
    conv = _conversion_rows(events).select(
        "event_id",
        F.lit(CONVERSION_EVENT).alias("event_name"),
        "occurred_at",
        "unit_id",
        F.lit(None).cast("string").alias("experiment_id"),
        F.lit(None).cast("string").alias("variation_id"),
        F.col("props").alias("properties"),
        "revenue",
    )
    return exp.unionByName(conv).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))


def dim_experiment(events: DataFrame) -> DataFrame:
    """One row per experiment seen in assignments; start/end = first/last assignment time."""
    a = raw_assignments(events)
    return a.groupBy("experiment_id").agg(
        F.min("assigned_at").alias("start_at"),
        F.max("assigned_at").alias("end_at"),
    )


def dim_variant(events: DataFrame) -> DataFrame:
    """Variant dimension with the designed 50/50 split (the fixed two-arm template per experiment)."""
    from abx.operators.assign import experiment_variants

    return experiment_variants(dim_experiment(events))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def lens(spark: SparkSession, sf_dir: str) -> Lens:
    events = load_events(spark, sf_dir)
    return Lens(
        raw_assignments=raw_assignments(events),
        raw_exposures=raw_exposures(events),
        conversions=conversions(events),
        event_feed=event_feed(events),
        dim_experiment=dim_experiment(events),
        dim_variant=dim_variant(events),
    )


# --- the same derivation in SQL (DuckDB oracle) -------------------------------------------
_KEYED = (
    "SELECT event_id, ts, event_type, value, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
    "CAST(user_id AS VARCHAR) AS unit_id, props, "
    "'exp_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR) AS experiment_id "
    "FROM events"
)
_OWN = (
    "CASE WHEN CAST(('0x' || substr(md5(experiment_id || ':' || unit_id), 1, 8)) AS BIGINT) % 100 < 50 "
    "THEN 'control' ELSE 'treatment' END"
)

LENS_CTES = {
    "lens_keyed": _KEYED,
    "raw_assignments": (
        f"SELECT experiment_id, unit_id, {_OWN} AS variant_id, ts AS assigned_at, "
        "event_type AS assignment_source, CAST(ts AS DATE) AS dt "
        "FROM lens_keyed WHERE event_type = 'signup'"
    ),
    "raw_exposures": (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, experiment_id, unit_id, "
        f"CASE WHEN k >= 84 THEN (CASE WHEN {_OWN} = 'control' THEN 'treatment' ELSE 'control' END) "
        f"ELSE {_OWN} END AS variant_id, ts AS exposed_at, event_type AS exposure_event_type, "
        "CAST(ts AS DATE) AS dt, props "
        "FROM lens_keyed WHERE event_type IN ('view', 'click')"
    ),
    "conversions": (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS unit_id, "
        "ts AS occurred_at, value AS revenue, props FROM events "
        "WHERE event_type = 'purchase'"
    ),
    "identity_links": (
        "SELECT unit_id, CASE WHEN k = 99 THEN 'device_shared' ELSE 'device_' || "
        "CAST((CAST(unit_id AS BIGINT) + k % 2) // 5 AS VARCHAR) || '_' || CAST(k % 24 AS VARCHAR) END AS identifier "
        "FROM lens_keyed WHERE event_type = 'error' AND k >= 75"
    ),
}


def with_ctes(extra: dict[str, str] | list[tuple[str, str]], final: str, lens_names=None) -> str:
    """Compose ``WITH lens..., extra... final`` (the lens CTEs first, in dependency order)."""
    items = list(LENS_CTES.items()) if lens_names is None else [(n, LENS_CTES[n]) for n in lens_names]
    extra_items = list(extra.items()) if isinstance(extra, dict) else list(extra)
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in items + extra_items)
    return f"WITH {body}\n{final}"
