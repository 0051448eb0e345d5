"""Extensions the reference names as next steps or limitations.

Continuous metrics (Welch), CUPED covariate adjustment, Benjamini-Hochberg adjusted p-values,
minimum detectable effect, metric definitions as rows and the unit x metric spine, and the
union of event feeds with different columns. All built-in Column math, no UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from abx.config import DEFAULT, ExperimentConfig
from abx.functions.stats import Z_95, normal_two_sided_p, safe_z, student_t_two_sided_p


# ---- continuous metric: Welch t --------------------------------------------------------------
def _arm_moments(units: DataFrame, value_col: str) -> DataFrame:
    v = F.col(value_col).cast("double")
    return units.groupBy("experiment_id", "variant_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var")
    )


def metric_mean_welch(units: DataFrame, cfg: ExperimentConfig = DEFAULT, value_col: str = "revenue") -> DataFrame:
    """Each non-control arm against control on a per-unit continuous value.

    Welch t, Welch-Satterthwaite df and SE are exact; ``p_value_t`` is the exact Student-t tail at
    the Welch df (incomplete beta), ``p_value_normal_approx`` the normal tail; the 95 % CI uses
    the normal quantile 1.96.
    """
    m = _arm_moments(units, value_col)
    w = Window.partitionBy("experiment_id")
    is_c = F.col("variant_id") == F.lit(cfg.control_variant_id)
    m = m.select(
        "*",
        *[F.max(F.when(is_c, F.col(c))).over(w).alias(f"{c}_c") for c in ("n", "mean", "var")],
        F.max(F.when(is_c, F.lit(1))).over(w).alias("_has_control"),
    )
    j = m.filter(~is_c & (F.col("_has_control") == 1)).select(
        "experiment_id", "variant_id", F.col("n_c").alias("n_control"), F.col("mean_c").alias("mean_control"),
        F.col("var_c").alias("var_control"), F.col("n").alias("n_treatment"), F.col("mean").alias("mean_treatment"),
        F.col("var").alias("var_treatment"),
    )
    a = F.try_divide(F.col("var_treatment"), F.col("n_treatment").cast("double"))
    b = F.try_divide(F.col("var_control"), F.col("n_control").cast("double"))
    j = j.select("*", (F.col("mean_treatment") - F.col("mean_control")).alias("diff"), F.sqrt(a + b).alias("se"))
    den = F.try_divide(a * a, (F.col("n_treatment") - 1).cast("double")) + F.try_divide(
        b * b, (F.col("n_control") - 1).cast("double")
    )
    j = j.withColumn("t_stat", safe_z(F.col("diff"), F.col("se")))
    out = j.select(
        "experiment_id", "variant_id", "n_control", "mean_control", "var_control", "n_treatment",
        "mean_treatment", "var_treatment", "diff", "se", "t_stat",
        F.try_divide(F.pow(a + b, 2), F.nullif(den, F.lit(0.0))).alias("welch_df"),
        normal_two_sided_p(F.col("t_stat")).alias("p_value_normal_approx"),
    ).select(
        "*",
        student_t_two_sided_p(F.col("t_stat"), F.col("welch_df")).alias("p_value_t"),
    )
    return out.select(
        "*",
        (F.col("diff") - F.lit(Z_95) * F.col("se")).alias("ci_low"),
        (F.col("diff") + F.lit(Z_95) * F.col("se")).alias("ci_high"),
    )


# ---- CUPED -----------------------------------------------------------------------------------
def cuped(units: DataFrame, cfg: ExperimentConfig = DEFAULT, x_col: str = "pre_revenue", y_col: str = "revenue"):
    """CUPED by arm: theta = cov(x, y) / var(x) pooled over the experiment's units.

    Per arm the adjusted mean is mean_y - theta (mean_x_arm - mean_x_all) and the adjusted
    variance var_y + theta^2 var_x - 2 theta cov_xy. One aggregation over the unit rows gives each
    arm's moments; the experiment-level co-moments are combined from them exactly (parallel
    variance formula: M2 = sum M2_i + sum n_i (mean_i - mean)^2) by windows over the arm table, so
    the unit rows are read once.
    """
    x = F.coalesce(F.col(x_col).cast("double"), F.lit(0.0))
    y = F.coalesce(F.col(y_col).cast("double"), F.lit(0.0))
    u = units.select("experiment_id", "variant_id", x.alias("_x"), y.alias("_y"))
    arm = u.groupBy("experiment_id", "variant_id").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.avg("_x").alias("mean_pre"),
        F.avg("_y").alias("mean_post"),
        F.var_samp("_x").alias("_vx"),
        F.var_samp("_y").alias("var_post"),
        F.covar_samp("_x", "_y").alias("_cxy"),
    )
    w = Window.partitionBy("experiment_id")  # the arms of one experiment: a handful of rows
    n = F.col("n_units").cast("double")
    arm = arm.select(
        "*",
        (F.sum(n * F.col("mean_pre")).over(w) / F.sum(n).over(w)).alias("_mx_all"),
        (F.sum(n * F.col("mean_post")).over(w) / F.sum(n).over(w)).alias("_my_all"),
    )
    dx = F.col("mean_pre") - F.col("_mx_all")
    dy = F.col("mean_post") - F.col("_my_all")
    m2x = F.sum(F.coalesce(F.col("_vx"), F.lit(0.0)) * (n - 1) + n * dx * dx).over(w)
    cxy = F.sum(F.coalesce(F.col("_cxy"), F.lit(0.0)) * (n - 1) + n * dx * dy).over(w)
    arm = arm.withColumn("theta", F.try_divide(cxy, F.nullif(m2x, F.lit(0.0))))
    th = F.coalesce(F.col("theta"), F.lit(0.0))
    return arm.select(
        "experiment_id", "variant_id", "n_units", "mean_pre", "mean_post", "theta",
        (F.col("mean_post") - th * (F.col("mean_pre") - F.col("_mx_all"))).alias("mean_post_adjusted"),
        "var_post",
        (F.col("var_post") + th * th * F.col("_vx") - F.lit(2.0) * th * F.col("_cxy")).alias("var_post_adjusted"),
    )


# ---- multiple testing ------------------------------------------------------------------------
def p_adjusted(results: DataFrame, p_col: str = "p_value_two_sided", family=("experiment_id",),
               cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Benjamini-Hochberg adjusted p within each family (default: one experiment's arms x metrics).

    Control rows and rows without a p value are not tests and are left out. Windows run on the
    small results table, partitioned by family.
    """
    r = results.filter((F.col("variant_id") != F.lit(cfg.control_variant_id)) & F.col(p_col).isNotNull())
    keys = [F.col(c) for c in family]
    order = [F.col(p_col).asc(), F.col("metric_id").asc(), F.col("variant_id").asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    wall = Window.partitionBy(*keys)
    r = r.select(
        "experiment_id", "metric_id", "variant_id", F.col(p_col).alias("p_value"),
        F.row_number().over(w).cast("long").alias("p_rank"), F.count(F.lit(1)).over(wall).alias("n_tests"),
    )
    raw = F.col("p_value") * F.col("n_tests") / F.col("p_rank")
    wdesc = Window.partitionBy(*keys).orderBy(F.col("p_rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return r.withColumn("p_value_bh", F.least(F.min(raw).over(wdesc), F.lit(1.0)))


# ---- power -----------------------------------------------------------------------------------
def power_mde(mbv: DataFrame, cfg: ExperimentConfig = DEFAULT, alpha: float | None = None, power: float = 0.8):
    """Minimum detectable absolute / relative effect per arm at the observed sizes.

    mde = (z_{1-alpha/2} + z_{power}) * sqrt(p_c (1 - p_c) (1/n_c + 1/n_t)); quantiles are
    computed once on the driver from the parameters (constants, not data).
    """
    a = cfg.alpha if alpha is None else alpha
    zsum = NormalDist().inv_cdf(1.0 - a / 2.0) + NormalDist().inv_cdf(power)
    w = Window.partitionBy("experiment_id", "metric_id")
    is_c = F.col("variant_id") == F.lit(cfg.control_variant_id)
    m = mbv.select(
        "*",
        F.max(F.when(is_c, F.col("n_users"))).over(w).alias("n_control"),
        F.max(F.when(is_c, F.col("conversion_rate"))).over(w).alias("baseline_rate"),
        F.max(F.when(is_c, F.lit(1))).over(w).alias("_has_control"),
    )
    j = m.filter(~is_c & (F.col("_has_control") == 1)).select(
        "experiment_id", "metric_id", "variant_id", "n_control", F.col("n_users").alias("n_treatment"), "baseline_rate"
    )
    p = F.col("baseline_rate")
    se0 = F.sqrt(p * (F.lit(1.0) - p) * (F.try_divide(F.lit(1.0), F.col("n_control").cast("double"))
                                         + F.try_divide(F.lit(1.0), F.col("n_treatment").cast("double"))))
    mde = F.lit(zsum) * se0
    return j.select(
        "experiment_id", "metric_id", "variant_id", "n_control", "n_treatment", "baseline_rate",
        mde.alias("mde_abs"), F.try_divide(mde, F.nullif(p, F.lit(0.0))).alias("mde_rel"),
    )


# ---- metric definitions and spine ---------------------------------------------------------------
@dataclass(frozen=True)
class MetricDefinition:
    metric_id: str
    event_name: str
    window_days: int
    anchor: str  # "exposure" | "assignment"
    kind: str  # "binary" | "continuous"


DEFAULT_METRICS = (
    MetricDefinition("conversion_7d", "purchase", 7, "exposure", "binary"),
    MetricDefinition("revenue_7d", "purchase", 7, "exposure", "continuous"),
    MetricDefinition("conversion_itt_7d", "purchase", 7, "assignment", "binary"),
)


def _metrics_array(metrics=DEFAULT_METRICS):
    return F.array(*[
        F.struct(
            F.lit(m.metric_id).alias("metric_id"), F.lit(m.event_name).alias("event_name"),
            F.lit(int(m.window_days)).alias("window_days"), F.lit(m.anchor).alias("anchor"),
            F.lit(m.kind).alias("kind"),
        )
        for m in metrics
    ])


def metric_definitions(spark: SparkSession, metrics=DEFAULT_METRICS) -> DataFrame:
    return spark.range(1).select(F.inline(_metrics_array(metrics)))


def metric_spine(cohort_df: DataFrame, metrics=DEFAULT_METRICS) -> DataFrame:
    """Unit x metric rows with eligibility and the attribution window.

    The metric list is configuration of fixed size, expanded per row by ``inline`` of a literal
    array (a generator, not a join), so the cohort is never shuffled for it.
    """
    s = cohort_df.select(
        "experiment_id", "unit_id", F.col("assigned_variant_id").alias("variant_id"), "assigned_at",
        "first_exposure_at", F.inline(_metrics_array(metrics)),
    )
    anchor_at = F.when(F.col("anchor") == F.lit("exposure"), F.col("first_exposure_at")).otherwise(F.col("assigned_at"))
    s = s.withColumn("anchor_at", anchor_at)
    return s.select(
        "experiment_id", "unit_id", "variant_id", "metric_id", "event_name", "kind", "anchor", "window_days",
        "anchor_at", F.col("anchor_at").isNotNull().alias("is_eligible"),
        F.col("anchor_at").alias("window_start_at"),
        (F.col("anchor_at") + F.make_dt_interval(days=F.col("window_days"))).alias("window_end_at"),
    )


# ---- feeds -----------------------------------------------------------------------------------
def union_event_feeds(*feeds: DataFrame) -> DataFrame:
    """Union feeds with different columns by name; missing columns become null."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
