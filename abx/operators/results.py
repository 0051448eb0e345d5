"""Metric aggregation by variant and the two-proportion z-test against control.

Control statistics reach the other arms through a window over (experiment, metric) on the
post-aggregate table (experiments x metrics x variants rows, a handful per partition) instead of a
self-join, which would plan the whole upstream DAG twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.stats import (
    Z_95,
    normal_two_sided_p,
    normal_two_sided_p_exact,
    pooled_p,
    pooled_se,
    safe_z,
    unpooled_se,
)
from abx.functions.util import count_true, ratio


def metric_by_variant(outcomes: DataFrame) -> DataFrame:
    """n_users, conversions, conversion_rate, var_p = p(1-p)/n per experiment x metric x variant."""
    n = F.count(F.lit(1))
    c = count_true(F.col("did_convert") == F.lit(True))
    d = outcomes.groupBy("experiment_id", "metric_id", "variant_id").agg(
        n.alias("n_users"), c.alias("conversions")
    )
    rate = ratio("conversions", "n_users")
    return d.select(
        "*",
        rate.alias("conversion_rate"),
        F.try_divide(rate * (F.lit(1.0) - rate), F.col("n_users").cast("double")).alias("var_p"),
    )


def metric_by_variant_rounded(outcomes: DataFrame, digits: int = 4) -> DataFrame:
    """n_users, n_converted, conversion_rate rounded to ``digits`` (local-model parity)."""
    d = outcomes.groupBy("experiment_id", "variant_id").agg(
        F.count(F.lit(1)).alias("n_users"),
        count_true(F.col("did_convert") == F.lit(True)).alias("n_converted"),
    )
    return d.select("*", F.round(ratio("n_converted", "n_users"), digits).alias("conversion_rate"))


def _control_cols(df: DataFrame, keys: list[str], cols: dict[str, str], control: str) -> list:
    """Columns of the control row broadcast to every row of its group, by a window over the
    small post-aggregate table (no self-join, so the upstream plan runs once)."""
    w = Window.partitionBy(*keys)
    is_c = F.col("variant_id") == F.lit(control)
    return [F.max(F.when(is_c, F.col(src))).over(w).alias(dst) for src, dst in cols.items()]


def results(mbv: DataFrame, cfg: ExperimentConfig = DEFAULT, with_computed_at: bool = False) -> DataFrame:
    """Every variant (control too) against its experiment's control arm (left-join semantics).

    Pooled z, exact two-sided normal p (erfc via the incomplete gamma), unpooled 95 % CI. A
    control row gets uplift 0 and p = 1 unless se = 0 (then z, p null). A missing control gives
    nulls.
    """
    b = mbv.select("experiment_id", "metric_id", "variant_id", "n_users", "conversions", "conversion_rate")
    j = b.select(
        "*",
        *_control_cols(
            b,
            ["experiment_id", "metric_id"],
            {
                "n_users": "control_n_users",
                "conversions": "control_conversions",
                "conversion_rate": "control_conversion_rate",
            },
            cfg.control_variant_id,
        ),
    )
    diff = F.col("conversion_rate") - F.col("control_conversion_rate")
    se = pooled_se("n_users", "conversions", "control_n_users", "control_conversions")
    se_u = unpooled_se("conversion_rate", "n_users", "control_conversion_rate", "control_n_users")
    out = j.select(
        "*",
        diff.alias("uplift_abs"),
        (F.try_divide(F.col("conversion_rate"), F.nullif(F.col("control_conversion_rate"), F.lit(0.0))) - F.lit(1.0)).alias(
            "uplift_rel"
        ),
        pooled_p("n_users", "conversions", "control_n_users", "control_conversions").alias("pooled_p"),
        se.alias("se"),
    )
    out = out.withColumn("z", safe_z(F.col("uplift_abs"), F.col("se")))
    out = out.withColumn("p_value_two_sided", normal_two_sided_p_exact(F.col("z")))
    out = out.withColumn("se_unpooled", se_u)
    out = out.select(
        "*",
        (F.col("uplift_abs") - F.lit(Z_95) * F.col("se_unpooled")).alias("ci_low"),
        (F.col("uplift_abs") + F.lit(Z_95) * F.col("se_unpooled")).alias("ci_high"),
        (F.col("p_value_two_sided") < F.lit(0.05)).alias("is_statistically_significant_95"),
    )
    if with_computed_at:
        out = out.withColumn("computed_at", F.current_timestamp())
    return out


def results_pairwise(mbv_rounded: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Each non-control variant against control (inner-join semantics: arms of experiments
    without a control row are dropped): one wide row per treatment arm.

    Local-model parity: rates are the 4-dp rounded ones; pooled se for both z and CI; the p value
    is the uncapped polynomial. ``variant_id`` (the treatment arm) is kept.
    """
    ctl = cfg.control_variant_id
    m = mbv_rounded.select(
        "*",
        *_control_cols(
            mbv_rounded,
            ["experiment_id"],
            {"n_users": "n_control", "n_converted": "conv_control", "conversion_rate": "cr_control"},
            ctl,
        ),
        F.max(F.when(F.col("variant_id") == F.lit(ctl), F.lit(1))).over(Window.partitionBy("experiment_id")).alias(
            "_has_control"
        ),
    )
    t = m.filter((F.col("variant_id") != F.lit(ctl)) & (F.col("_has_control") == 1)).select(
        "experiment_id",
        "variant_id",
        "n_control",
        "conv_control",
        "cr_control",
        F.col("n_users").alias("n_treatment"),
        F.col("n_converted").alias("conv_treatment"),
        F.col("conversion_rate").alias("cr_treatment"),
    )
    uplift = F.col("cr_treatment") - F.col("cr_control")
    se = pooled_se("n_control", "conv_control", "n_treatment", "conv_treatment")
    j = t.select("*", uplift.alias("uplift_abs"), se.alias("se"))
    j = j.withColumn("z_score", safe_z(F.col("uplift_abs"), F.col("se")))
    return j.select(
        "experiment_id",
        "variant_id",
        "n_control",
        "conv_control",
        "cr_control",
        "n_treatment",
        "conv_treatment",
        "cr_treatment",
        "uplift_abs",
        "se",
        "z_score",
        normal_two_sided_p(F.col("z_score"), cap=False).alias("p_value_two_sided"),
        (F.col("uplift_abs") - F.lit(Z_95) * F.col("se")).alias("ci_low"),
        (F.col("uplift_abs") + F.lit(Z_95) * F.col("se")).alias("ci_high"),
    )


def governed_results(pairwise: DataFrame) -> DataFrame:
    """Published results view: a column subset, ``p_value_two_sided`` renamed to ``p_value``."""
    return pairwise.select(
        "experiment_id",
        "variant_id",
        "n_control",
        "cr_control",
        "n_treatment",
        "cr_treatment",
        "uplift_abs",
        "z_score",
        F.col("p_value_two_sided").alias("p_value"),
        "ci_low",
        "ci_high",
    )


def treatment_won(governed: DataFrame, alpha: float | None = None, experiment_id: str | None = None) -> DataFrame:
    """did_treatment_win = p < alpha and uplift > 0, else false (null -> false)."""
    a = DEFAULT.alpha if alpha is None else alpha
    g = governed if experiment_id is None else governed.filter(F.col("experiment_id") == F.lit(experiment_id))
    won = F.when((F.col("p_value") < F.lit(a)) & (F.col("uplift_abs") > F.lit(0.0)), F.lit(True)).otherwise(
        F.lit(False)
    )
    return g.withColumn("did_treatment_win", won)


def verdict(governed: DataFrame, cfg: ExperimentConfig = DEFAULT, alpha: float | None = None) -> DataFrame:
    """Verdict per experiment arm: won flag, whether the CI includes 0, small-sample flag."""
    w = treatment_won(governed, alpha if alpha is not None else cfg.alpha)
    ci0 = (F.col("ci_low") <= F.lit(0.0)) & (F.lit(0.0) <= F.col("ci_high"))
    small = (F.col("n_control") < F.lit(cfg.min_sample_per_variant)) | (
        F.col("n_treatment") < F.lit(cfg.min_sample_per_variant)
    )
    return w.select(
        "experiment_id",
        "variant_id",
        "uplift_abs",
        "p_value",
        "ci_low",
        "ci_high",
        "did_treatment_win",
        F.coalesce(ci0, F.lit(False)).alias("ci_includes_zero"),
        F.coalesce(small, F.lit(False)).alias("is_small_sample"),
        F.when(F.col("did_treatment_win"), F.lit("treatment_won")).otherwise(F.lit("not_won")).alias("verdict"),
    )
