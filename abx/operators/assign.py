"""Assignments: canonicalization, duplicate diagnostics, deterministic variant assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.functions.util import count_true

KEY = ("experiment_id", "unit_id")


def canonical_assignments(raw: DataFrame, keys=KEY, time_col: str = "assigned_at") -> DataFrame:
    """One row per experiment x unit: earliest assignment, ties -> smallest variant_id.

    ``row_number() ... = 1`` lets Catalyst plan a partial ``WindowGroupLimit`` before the
    shuffle, so a hot key is cut to one row per map task before it is exchanged.
    """
    order = [F.col(time_col).asc_nulls_last(), F.col("variant_id").asc_nulls_last()]
    # Remaining orderable columns close the order, so a recomputed task (executor loss) picks the
    # same row even among rows equal on time and variant.
    rest = [
        F.col(f.name).asc_nulls_last()
        for f in sorted(raw.schema.fields, key=lambda f: f.name)
        if f.name not in (*keys, time_col, "variant_id")
        and f.dataType.typeName() not in ("map", "variant", "array", "struct", "binary")
    ]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return raw.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def assignment_quality(raw: DataFrame, keys=KEY, by: tuple[str, ...] = ()) -> DataFrame:
    """raw_rows, unique_keys, duplicate_keys_count, duplicate_rows_excess (= sum(c - 1)).

    Two-level aggregation evaluated by one action; ``by`` adds grouping columns (e.g. the
    experiment) that must be part of ``keys``.
    """
    per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("raw_rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        count_true(F.col("_c") > 1).alias("duplicate_keys_count"),
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0)).cast("long").alias(
            "duplicate_rows_excess"
        ),
    )


# The default two-arm template (variant_id, variant_name, allocation_pct, is_control).
DEFAULT_TEMPLATE = (("control", "Control", 50.0, True), ("treatment", "Treatment", 50.0, False))

TEMPLATE_SCHEMA = T.StructType(
    [
        T.StructField("variant_id", T.StringType(), False),
        T.StructField("variant_name", T.StringType(), False),
        T.StructField("allocation_pct", T.DoubleType(), False),
        T.StructField("is_control", T.BooleanType(), False),
    ]
)


def variant_template(spark: SparkSession, rows=DEFAULT_TEMPLATE) -> DataFrame:
    return spark.createDataFrame(list(rows), TEMPLATE_SCHEMA)


def experiment_variants(experiments: DataFrame, rows=DEFAULT_TEMPLATE) -> DataFrame:
    """Experiments x variant template.

    The template is configuration of fixed size; it is expanded per experiment row by ``inline``
    of a literal array (a generator, no join), so the experiment side is never shuffled.
    """
    arr = F.array(
        *[
            F.struct(
                F.lit(v).alias("variant_id"),
                F.lit(n).alias("variant_name"),
                F.lit(float(a)).alias("allocation_pct"),
                F.lit(bool(c)).alias("is_control"),
            )
            for v, n, a, c in rows
        ]
    )
    return experiments.select("experiment_id", F.inline(arr))


# Buckets reported beside an assignment; shares themselves are compared at full hash resolution.
ASSIGN_BUCKETS = 10_000
HASH_RANGE = 1 << 32


def assignment_share(experiment_id="experiment_id", unit_id="unit_id", salt: str | None = None):
    """Deterministic number in [0, 1): first 8 hex digits of md5(salt:experiment:unit) over 2^32."""
    parts = ([F.lit(salt)] if salt else []) + [F.col(experiment_id), F.col(unit_id)]
    h = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(float(HASH_RANGE))


def variant_bounds(variants: DataFrame) -> DataFrame:
    """One row per experiment: ``arms``, its variants in order with the upper end of their share of
    [0, 1) from cumulative allocation_pct. Arms without allocation are left out; the last ends at 1."""
    arm = F.struct("variant_id", F.col("allocation_pct").cast("double").alias("pct"))
    planned = variants.filter(F.col("allocation_pct") > 0)
    arms = planned.groupBy("experiment_id").agg(F.array_sort(F.collect_list(arm)).alias("_a"))
    total = F.aggregate("_a", F.lit(0.0), lambda s, x: s + x["pct"])
    upto = F.transform("_a", lambda x, i: F.aggregate(F.slice("_a", F.lit(1), i + 1), F.lit(0.0), lambda s, y: s + y["pct"]))
    ends = F.transform(upto, lambda u, i: F.when(i == F.size("_a") - 1, F.lit(1.0)).otherwise(u / total))
    return arms.select(
        "experiment_id",
        F.zip_with("_a", ends, lambda x, e: F.struct(x["variant_id"].alias("variant_id"), e.alias("upto"))).alias("arms"),
    )


def assign_variants(units: DataFrame, variants: DataFrame, salt: str | None = None) -> DataFrame:
    """Deterministic weighted assignment of a unit table (experiment_id, unit_id).

    The hash share picks the first arm whose end lies above it. The arms of an experiment are one
    array in one row, so the join is as small as the list of experiments (Spark sends it to the
    tasks if its size allows, and splits a large experiment's units otherwise).
    """
    u = units.select("experiment_id", "unit_id").withColumn("_u", assignment_share(salt=salt))
    j = u.join(variant_bounds(variants), "experiment_id")
    arm = F.filter("arms", lambda a: F.col("_u") < a["upto"])[0]
    bucket = F.floor(F.col("_u") * F.lit(ASSIGN_BUCKETS)).cast("int")
    return j.select("experiment_id", "unit_id", arm["variant_id"].alias("variant_id"), bucket.alias("bucket"))
