"""Registered queries: name -> (Spark callable(spark, sf_dir), DuckDB oracle SQL or None).

Every query reads ``events`` (or tables Spark derives from it) over the whole data folder.
Double columns of statistical outputs are rounded to 9 dp on both sides so value hashes are
stable across engines (sqrt/exp chains may differ in the last bit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.config import DEFAULT
from abx.functions.util import round_doubles
from abx.operators import asof as AS
from abx.operators import assign, bootstrap, cohort, exposure, profile, results, versions
from abx.operators import identity as ID
from abx.operators import rollups as RO
from abx.operators import sessions as SE
from abx.operators import survival as SV
from abx.plans import oracle as O
from abx.plans.experiment import ExperimentDAG
from abx.streaming import first_exposure as FE

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DAG_QUERIES: dict[str, Callable[[ExperimentDAG], DataFrame]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[ExperimentDAG], DataFrame]) -> Callable[[ExperimentDAG], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ExperimentDAG(spark, sf_dir, DEFAULT))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        DAG_QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = O.build(sql)
        return fn

    return deco


def _r9(df: DataFrame) -> DataFrame:
    return round_doubles(df, 9)


def _sql_r9(table: str, all_cols: list[str], double_cols: list[str]) -> str:
    keep = [c for c in all_cols if c not in double_cols]
    return O.round9(double_cols, table, keep)


# ---- 2.2 staging ---------------------------------------------------------------------------
@register("stage_exposures", "SELECT event_id, experiment_id, unit_id, variant_id, exposed_at, ingested_at FROM staged")
def _stage_exposures(d: ExperimentDAG) -> DataFrame:
    return d.staged


@register("stage_conversions", "SELECT event_id, unit_id, occurred_at, event_name, revenue FROM conv")
def _stage_conversions(d: ExperimentDAG) -> DataFrame:
    return d.conversions


@register(
    "exposure_event_id",
    """SELECT experiment_id, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_ids,
              CAST(count_if(contents > 1) AS BIGINT) AS colliding_ids,
              CAST(count_if(exposure_event_id IS NULL) AS BIGINT) AS null_ids
       FROM (SELECT experiment_id, exposure_event_id, count(*) AS n,
                    count(DISTINCT (unit_id, variant_id, exposed_at, exposure_event_type)) AS contents
             FROM staged_strict GROUP BY 1, 2) GROUP BY 1""",
)
def _exposure_event_id(d: ExperimentDAG) -> DataFrame:
    """Surrogate ids by experiment: how many, how many stand for several events, how many are null."""
    content = F.struct("unit_id", "variant_id", "exposed_at", "exposure_event_type")
    per_id = d.staged_strict.groupBy("experiment_id", "exposure_event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(content).alias("contents")
    )
    return per_id.groupBy("experiment_id").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("contents") > 1).alias("colliding_ids"),
        F.count_if(F.col("exposure_event_id").isNull()).alias("null_ids"),
    )


@register(
    "stage_exposures_strict",
    "SELECT experiment_id, unit_id, variant_id, exposed_at, exposure_event_type, exposure_event_id FROM staged_strict",
)
def _stage_exposures_strict(d: ExperimentDAG) -> DataFrame:
    return d.staged_strict


# ---- 2.3 dedupe and validation -------------------------------------------------------------
@register(
    "canonical_assignments",
    "SELECT experiment_id, unit_id, variant_id, assigned_at, assignment_source, dt FROM canonical",
)
def _canonical(d: ExperimentDAG) -> DataFrame:
    return d.canonical


@register(
    "assignment_quality",
    """SELECT CAST(sum(c) AS BIGINT) AS raw_rows, count(*) AS unique_keys,
              CAST(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys_count,
              CAST(COALESCE(sum(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS duplicate_rows_excess
       FROM (SELECT experiment_id, unit_id, count(*) AS c FROM raw_assignments GROUP BY 1, 2)""",
)
def _assignment_quality(d: ExperimentDAG) -> DataFrame:
    return assign.assignment_quality(d.raw_assignments)


@register(
    "dedupe_exposures",
    "SELECT event_id, experiment_id, unit_id, variant_id, exposed_at, ingested_at FROM deduped",
)
def _dedupe(d: ExperimentDAG) -> DataFrame:
    return d.deduped


@register(
    "dedupe_exposures_post_only",
    f"""SELECT event_id, experiment_id, unit_id, variant_id, exposed_at, ingested_at FROM (
          SELECT s.*, row_number() OVER (PARTITION BY s.experiment_id, s.unit_id, s.variant_id
                   ORDER BY s.exposed_at, s.ingested_at NULLS LAST, s.event_id) AS rn
          FROM staged s JOIN canonical a ON s.experiment_id = a.experiment_id AND s.unit_id = a.unit_id
          WHERE s.exposed_at >= a.assigned_at - {O.GRACE}) WHERE rn = 1""",
)
def _dedupe_post_only(d: ExperimentDAG) -> DataFrame:
    return exposure.dedupe_exposures_post_only(d.staged, d.canonical, d.cfg)


@register(
    "dedupe_exposures_strict",
    "SELECT experiment_id, unit_id, variant_id, exposed_at, exposure_event_type, exposure_event_id FROM deduped_strict",
)
def _dedupe_strict(d: ExperimentDAG) -> DataFrame:
    return d.deduped_strict


@register(
    "exposure_stats",
    "SELECT experiment_id, unit_id, exposure_event_count, exposure_variation_count FROM vw_stats",
)
def _exposure_stats(d: ExperimentDAG) -> DataFrame:
    return exposure.exposure_stats(d.deduped)


@register(
    "first_exposure_any",
    """SELECT experiment_id, unit_id, first_exposure_any_at, first_exposure_any_variant_id,
              first_exposure_any_event_id, has_any_exposure FROM validation""",
)
def _first_any(d: ExperimentDAG) -> DataFrame:
    return d.validation.select(
        "experiment_id",
        "unit_id",
        "first_exposure_any_at",
        "first_exposure_any_variant_id",
        "first_exposure_any_event_id",
        "has_any_exposure",
    )


@register(
    "first_exposure_post",
    """SELECT experiment_id, unit_id, first_exposure_at, first_exposure_variant_id, first_exposure_event_id,
              has_post_assignment_exposure, exposure_delay_seconds FROM validation""",
)
def _first_post(d: ExperimentDAG) -> DataFrame:
    return d.validation.select(
        "experiment_id",
        "unit_id",
        "first_exposure_at",
        "first_exposure_variant_id",
        "first_exposure_event_id",
        "has_post_assignment_exposure",
        "exposure_delay_seconds",
    )


_VALIDATION_COLS = [
    "experiment_id",
    "unit_id",
    "assigned_variant_id",
    "assigned_at",
    "first_exposure_any_at",
    "first_exposure_any_variant_id",
    "first_exposure_any_event_id",
    "first_exposure_at",
    "first_exposure_variant_id",
    "first_exposure_event_id",
    "exposure_delay_seconds",
    "exposure_event_count",
    "exposure_variation_count",
    "has_any_exposure",
    "has_post_assignment_exposure",
    "is_pre_assignment_exposure",
    "exposure_outside_window",
    "is_variant_mismatch",
    "has_multiple_variations_exposed",
    "has_valid_exposure",
    "validation_status",
    "dt",
]


@register("validation_status", "SELECT experiment_id, unit_id, validation_status FROM validation")
def _status(d: ExperimentDAG) -> DataFrame:
    return d.validation.select("experiment_id", "unit_id", "validation_status")


@register("validate_exposures", f"SELECT {', '.join(_VALIDATION_COLS)} FROM validation")
def _validate(d: ExperimentDAG) -> DataFrame:
    return d.validation.select(*_VALIDATION_COLS)


@register("validate_exposures_any", f"SELECT {', '.join(_VALIDATION_COLS)} FROM validation_any")
def _validate_any(d: ExperimentDAG) -> DataFrame:
    return d.validation_any.select(*_VALIDATION_COLS)


# ---- 2.4 quality ---------------------------------------------------------------------------
_QD_COUNTS = [
    "experiment_id",
    "date_day",
    "assigned_units",
    "exposed_units",
    "valid_exposed_units",
    "missing_exposure_units",
    "variant_mismatch_units",
    "multi_variation_units",
    "pre_assignment_units",
    "outside_window_units",
    "avg_exposure_delay_seconds",
]
_QD_RATES = [
    "exposure_rate",
    "valid_exposure_rate",
    "mismatch_rate",
    "percent_missing_exposure",
    "percent_multiple_exposures",
    "pre_assignment_rate",
    "outside_window_rate",
]


@register("quality_daily_counts", _sql_r9("quality_daily_counts", _QD_COUNTS, ["avg_exposure_delay_seconds"]))
def _qd_counts(d: ExperimentDAG) -> DataFrame:
    from abx.operators.quality import quality_daily_counts

    return _r9(quality_daily_counts(d.validation_any))


@register("quality_daily", _sql_r9("quality_daily", _QD_COUNTS + _QD_RATES, ["avg_exposure_delay_seconds"] + _QD_RATES))
def _qd(d: ExperimentDAG) -> DataFrame:
    return _r9(d.quality_daily)


_QDP = [
    "experiment_id",
    "date_day",
    "assigned_units",
    "exposed_units",
    "valid_exposed_units",
    "exposure_rate",
    "valid_exposure_rate",
    "variant_mismatch_rate",
    "multi_variation_rate",
    "pre_assignment_rate",
    "outside_window_rate",
    "avg_exposure_delay_seconds",
]
_QDP_D = [c for c in _QDP[5:]]


@register("quality_daily_post", _sql_r9("quality_daily_post", _QDP, _QDP_D))
def _qdp(d: ExperimentDAG) -> DataFrame:
    return _r9(d.quality_daily_post)


_AUDIT = [
    "experiment_id",
    "date_day",
    "assigned_units",
    "exposed_units",
    "valid_exposed_units",
    "exposure_rate",
    "valid_exposure_rate",
    "mismatch_units",
    "multi_variation_units",
    "pre_assignment_units",
    "outside_window_units",
    "avg_exposure_delay_seconds",
    "exposure_health",
]


@register(
    "exposure_audit",
    _sql_r9("exposure_audit", _AUDIT, ["exposure_rate", "valid_exposure_rate", "avg_exposure_delay_seconds"]),
)
def _audit(d: ExperimentDAG) -> DataFrame:
    from abx.operators.quality import exposure_audit

    return _r9(exposure_audit(d.validation, d.cfg))


# ---- 2.5 cohorts and outcomes ----------------------------------------------------------------
_COHORT = [
    "experiment_id",
    "unit_id",
    "assigned_variant_id",
    "assigned_at",
    "first_exposure_at",
    "first_exposure_variant_id",
    "has_post_assignment_exposure",
    "exposure_delay_seconds",
    "has_valid_exposure",
    "validation_status",
    "is_in_itt_cohort",
    "is_in_exposure_cohort",
    "is_in_valid_exposure_cohort",
]


@register("cohort", f"SELECT {', '.join(_COHORT)} FROM cohort")
def _cohort(d: ExperimentDAG) -> DataFrame:
    return d.cohort.select(*_COHORT)


@register(
    "cohort_sizes",
    """SELECT experiment_id, assigned_variant_id AS variant_id,
              CAST(sum(CASE WHEN is_in_itt_cohort THEN 1 ELSE 0 END) AS BIGINT) AS itt_units,
              CAST(sum(CASE WHEN is_in_exposure_cohort THEN 1 ELSE 0 END) AS BIGINT) AS exposed_units,
              CAST(sum(CASE WHEN is_in_valid_exposure_cohort THEN 1 ELSE 0 END) AS BIGINT) AS valid_units
       FROM cohort GROUP BY 1, 2""",
)
def _cohort_sizes(d: ExperimentDAG) -> DataFrame:
    return cohort.cohort_sizes(d.cohort)


_OUT = ["experiment_id", "unit_id", "variant_id", "anchor_at", "metric_id", "window_days", "did_convert", "converted_at"]


@register("outcomes_exposed", f"SELECT {', '.join(_OUT)} FROM outcomes_exposed")
def _outcomes_exposed(d: ExperimentDAG) -> DataFrame:
    return d.outcomes_exposed


@register("outcomes_itt", f"SELECT {', '.join(_OUT)} FROM outcomes_itt")
def _outcomes_itt(d: ExperimentDAG) -> DataFrame:
    return d.outcomes_itt


# ---- 2.6 metrics and statistics --------------------------------------------------------------
_MBV = ["experiment_id", "metric_id", "variant_id", "n_users", "conversions", "conversion_rate", "var_p"]


@register("metric_by_variant", _sql_r9("mbv", _MBV, ["conversion_rate", "var_p"]))
def _mbv(d: ExperimentDAG) -> DataFrame:
    return _r9(d.metric_by_variant)


@register(
    "metric_by_variant_rounded",
    "SELECT experiment_id, variant_id, n_users, n_converted, conversion_rate FROM mbv_rounded",
)
def _mbv_rounded(d: ExperimentDAG) -> DataFrame:
    return d.metric_by_variant_rounded


_RES = [
    "experiment_id",
    "metric_id",
    "variant_id",
    "n_users",
    "conversions",
    "conversion_rate",
    "control_n_users",
    "control_conversions",
    "control_conversion_rate",
    "uplift_abs",
    "uplift_rel",
    "pooled_p",
    "se",
    "z",
    "p_value_two_sided",
    "se_unpooled",
    "ci_low",
    "ci_high",
    "is_statistically_significant_95",
]
_RES_D = [
    "conversion_rate",
    "control_conversion_rate",
    "uplift_abs",
    "uplift_rel",
    "pooled_p",
    "se",
    "z",
    "p_value_two_sided",
    "se_unpooled",
    "ci_low",
    "ci_high",
]


@register("results", _sql_r9("results", _RES, _RES_D))
def _results(d: ExperimentDAG) -> DataFrame:
    return _r9(d.results.select(*_RES))


_PW = [
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
    "p_value_two_sided",
    "ci_low",
    "ci_high",
]
_PW_D = ["cr_control", "cr_treatment", "uplift_abs", "se", "z_score", "p_value_two_sided", "ci_low", "ci_high"]


@register("results_pairwise", _sql_r9("pairwise", _PW, _PW_D))
def _pairwise(d: ExperimentDAG) -> DataFrame:
    return _r9(d.results_pairwise)


_GOV = [
    "experiment_id",
    "variant_id",
    "n_control",
    "cr_control",
    "n_treatment",
    "cr_treatment",
    "uplift_abs",
    "z_score",
    "p_value",
    "ci_low",
    "ci_high",
]
_GOV_D = ["cr_control", "cr_treatment", "uplift_abs", "z_score", "p_value", "ci_low", "ci_high"]


@register("governed_results", _sql_r9("governed", _GOV, _GOV_D))
def _governed(d: ExperimentDAG) -> DataFrame:
    return _r9(d.governed_results)


@register("treatment_won", _sql_r9("won", _GOV + ["did_treatment_win"], _GOV_D))
def _won(d: ExperimentDAG) -> DataFrame:
    return _r9(results.treatment_won(d.governed_results, d.cfg.alpha))


@register(
    "verdict",
    """SELECT experiment_id, variant_id, round(uplift_abs, 9) AS uplift_abs, round(p_value, 9) AS p_value,
              round(ci_low, 9) AS ci_low, round(ci_high, 9) AS ci_high, did_treatment_win,
              COALESCE(ci_low <= 0 AND 0 <= ci_high, false) AS ci_includes_zero,
              COALESCE(n_control < 30 OR n_treatment < 30, false) AS is_small_sample,
              CASE WHEN did_treatment_win THEN 'treatment_won' ELSE 'not_won' END AS verdict
       FROM won""",
)
def _verdict(d: ExperimentDAG) -> DataFrame:
    return _r9(results.verdict(d.governed_results, d.cfg))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Did treatment win? Canonical assignments -> ITT outcomes -> rounded metrics -> z-test."""
    return QUERIES["treatment_won"](spark, sf_dir)


__all__ = ["QUERIES", "ORACLES", "flagship", "F"]


# ---- 2.9 contracts -------------------------------------------------------------------------
from abx.functions.status import STATUS_LABELS  # noqa: E402
from abx.operators import contracts as C  # noqa: E402
from abx.operators import extensions as X  # noqa: E402
from abx.operators import governance as G  # noqa: E402
from abx.operators import guardrails as GR  # noqa: E402
from abx.operators import quality as Q  # noqa: E402
from abx.operators import reports as R  # noqa: E402

# Fixed report parameters for the registered runs (the testdata covers January 2024).
AS_OF = "2024-01-31"
# The quality report and what it gates are built as of a day inside the data.
REPORT_DT = "2024-01-24"
REPORT_EXPERIMENT = "exp_0"

_NN_VALIDATION = ["experiment_id", "unit_id", "assigned_variant_id", "assigned_at", "validation_status"]
_NN_MARTS = {
    "cohort": ["experiment_id", "unit_id", "assigned_variant_id", "assigned_at", "is_in_itt_cohort"],
    "mbv": ["experiment_id", "metric_id", "variant_id", "n_users", "conversions"],
    "results": ["experiment_id", "metric_id", "variant_id", "n_users", "conversion_rate"],
    "exposure_audit": ["experiment_id", "date_day", "assigned_units"],
    "raw_assignments": ["experiment_id", "unit_id", "variant_id", "assigned_at"],
}
_NN_DEDUPED = ["event_id", "experiment_id", "unit_id", "variant_id", "exposed_at"]


def _nn_sql(table: str, prefix: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{prefix}.not_null.{c}' AS \"check\", CAST(count_if({c} IS NULL) AS BIGINT) AS failing_rows FROM {table}"
        for c in cols
    )


@register(
    "contract_not_null",
    " UNION ALL ".join(
        [_nn_sql("validation", "validation", _NN_VALIDATION), _nn_sql("deduped", "deduped", _NN_DEDUPED)]
        + [_nn_sql(t, t, cols) for t, cols in _NN_MARTS.items()]
    ),
)
def _contract_not_null(d: ExperimentDAG) -> DataFrame:
    d = d.once()
    marts = {
        "cohort": d.cohort,
        "mbv": d.metric_by_variant,
        "results": d.results,
        "exposure_audit": Q.exposure_audit(d.validation, d.cfg),
        "raw_assignments": d.raw_assignments,
    }
    return C.union_checks(
        [
            C.contract_not_null(d.validation, _NN_VALIDATION, "validation"),
            C.contract_not_null(d.deduped, _NN_DEDUPED, "deduped"),
            *[C.contract_not_null(df, _NN_MARTS[name], name) for name, df in marts.items()],
        ]
    )


_VARIANTS = ("control", "treatment")


def _av_sql(table: str, prefix: str, col: str, values) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return (
        f"SELECT '{prefix}.accepted_values.{col}' AS \"check\", "
        f"CAST(count_if({col} IS NOT NULL AND {col} NOT IN ({vals})) AS BIGINT) AS failing_rows FROM {table}"
    )


@register(
    "contract_accepted_values",
    " UNION ALL ".join(
        [
            _av_sql("validation", "validation", "validation_status", STATUS_LABELS),
            _av_sql("validation", "validation", "assigned_variant_id", _VARIANTS),
            _av_sql("deduped", "deduped", "variant_id", _VARIANTS),
        ]
    ),
)
def _contract_accepted(d: ExperimentDAG) -> DataFrame:
    return C.union_checks(
        [
            C.contract_accepted_values(d.validation, "validation_status", STATUS_LABELS, "validation"),
            C.contract_accepted_values(d.validation, "assigned_variant_id", _VARIANTS, "validation"),
            C.contract_accepted_values(d.deduped, "variant_id", _VARIANTS, "deduped"),
        ]
    )


_UNIQUE = [
    ("canonical", "canonical", ["experiment_id", "unit_id"]),
    ("validation", "validation", ["experiment_id", "unit_id"]),
    ("deduped", "deduped", ["experiment_id", "unit_id", "variant_id"]),
    ("quality_daily", "quality_daily", ["experiment_id", "date_day"]),
    ("outcomes_exposed", "outcomes_exposed", ["experiment_id", "unit_id", "metric_id"]),
    ("cohort", "cohort", ["experiment_id", "unit_id"]),
    ("exposure_audit", "exposure_audit", ["experiment_id", "date_day"]),
    ("mbv", "mbv", ["experiment_id", "metric_id", "variant_id"]),
    ("results", "results", ["experiment_id", "metric_id", "variant_id"]),
]


@register(
    "contract_unique_key",
    " UNION ALL ".join(
        f"SELECT '{name}.unique.{'+'.join(keys)}' AS \"check\", CAST(count_if(c > 1) AS BIGINT) AS failing_rows "
        f"FROM (SELECT {', '.join(keys)}, count(*) AS c FROM {table} GROUP BY ALL)"
        for name, table, keys in _UNIQUE
    ),
)
def _contract_unique(d: ExperimentDAG) -> DataFrame:
    d = d.once()
    tables = {
        "canonical": d.canonical,
        "validation": d.validation,
        "deduped": d.deduped,
        "quality_daily": d.quality_daily,
        "outcomes_exposed": d.outcomes_exposed,
        "cohort": d.cohort,
        "exposure_audit": Q.exposure_audit(d.validation, d.cfg),
        "mbv": d.metric_by_variant,
        "results": d.results,
    }
    return C.union_checks([C.contract_unique_key(tables[t], keys, name) for name, t, keys in _UNIQUE])


@register(
    "contract_not_too_early",
    " UNION ALL ".join(
        f"SELECT '{t}.not_too_early.first_exposure_at' AS \"check\", "
        f"CAST(count_if(first_exposure_at IS NOT NULL AND first_exposure_at < assigned_at - {O.GRACE}) AS BIGINT) "
        f"AS failing_rows FROM {t}"
        for t in ("validation", "validation_any")
    ),
)
def _contract_early(d: ExperimentDAG) -> DataFrame:
    g = d.cfg.pre_assignment_grace_minutes
    return C.union_checks(
        [
            C.contract_not_too_early(d.validation, "assigned_at", "first_exposure_at", g, "validation"),
            C.contract_not_too_early(d.validation_any, "assigned_at", "first_exposure_at", g, "validation_any"),
        ]
    )


# ---- 2.7 smoke queries -----------------------------------------------------------------------
@register(
    "reconcile_counts",
    "SELECT (SELECT count(*) FROM canonical) AS assignment_rows, (SELECT count(*) FROM validation) AS validation_rows",
)
def _reconcile(d: ExperimentDAG) -> DataFrame:
    return R.reconcile_counts(d.canonical, d.validation)


@register(
    "lowest_exposure",
    f"""SELECT experiment_id, round(avg(exposure_rate), 9) AS avg_exposure_rate_7d FROM quality_daily_post
        WHERE date_day >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1
        ORDER BY avg_exposure_rate_7d ASC NULLS LAST, experiment_id LIMIT 10""",
)
def _lowest(d: ExperimentDAG) -> DataFrame:
    return _r9(R.lowest_exposure(d.quality_daily_post, AS_OF))


_STATUS_SAMPLE_COLS = _VALIDATION_COLS


@register(
    "status_samples",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT {', '.join(_VALIDATION_COLS)} FROM validation WHERE validation_status = '{s}' "
        f"ORDER BY experiment_id, unit_id LIMIT 50)"
        for s in ("variant_mismatch", "pre_assignment_exposure")
    ),
)
def _status_samples(d: ExperimentDAG) -> DataFrame:
    return R.status_samples(d.validation.select(*_VALIDATION_COLS))


@register(
    "delay_histogram",
    f"""SELECT CASE WHEN exposure_delay_seconds IS NULL THEN NULL
                    WHEN exposure_delay_seconds < 0 THEN 0
                    WHEN exposure_delay_seconds >= 86400 THEN 25
                    ELSE CAST(floor(exposure_delay_seconds / 3600.0) AS BIGINT) + 1 END AS delay_bucket,
               count(*) AS n
        FROM validation WHERE experiment_id = '{REPORT_EXPERIMENT}' AND has_any_exposure = true GROUP BY 1""",
)
def _delay_hist(d: ExperimentDAG) -> DataFrame:
    return R.delay_histogram(d.validation, REPORT_EXPERIMENT)


@register(
    "recent_results",
    f"""SELECT experiment_id, metric_id, variant_id, n_users, round(conversion_rate, 9) AS conversion_rate,
               round(uplift_abs, 9) AS uplift_abs, round(p_value_two_sided, 9) AS p_value_two_sided
        FROM results WHERE experiment_id = '{REPORT_EXPERIMENT}' ORDER BY metric_id, variant_id LIMIT 50""",
)
def _recent(d: ExperimentDAG) -> DataFrame:
    return _r9(R.recent_results(d.results, REPORT_EXPERIMENT))


@register(
    "exposure_vs_results",
    f"""SELECT e.experiment_id, round(e.avg_exposure_rate_7d, 9) AS avg_exposure_rate_7d, r.result_rows
        FROM (SELECT experiment_id, avg(exposure_rate) AS avg_exposure_rate_7d FROM quality_daily_post
              WHERE date_day >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1) e
        LEFT JOIN (SELECT experiment_id, count(*) AS result_rows FROM results GROUP BY 1) r
          ON e.experiment_id = r.experiment_id""",
)
def _exp_vs_results(d: ExperimentDAG) -> DataFrame:
    return _r9(R.exposure_vs_results(d.quality_daily_post, d.results, AS_OF))


@register(
    "significant_uplift",
    """SELECT experiment_id, metric_id, variant_id, round(uplift_abs, 9) AS uplift_abs,
              round(p_value_two_sided, 9) AS p_value_two_sided, round(ci_low, 9) AS ci_low, round(ci_high, 9) AS ci_high
       FROM results WHERE p_value_two_sided < 0.05 AND abs(uplift_abs) > 0.01
       ORDER BY p_value_two_sided, experiment_id, metric_id, variant_id LIMIT 50""",
)
def _significant(d: ExperimentDAG) -> DataFrame:
    return _r9(R.significant_uplift(d.results))


@register(
    "mismatch_gate",
    f"""SELECT m.experiment_id, round(m.avg_mismatch_rate_7d, 9) AS avg_mismatch_rate_7d, r.result_rows
        FROM (SELECT experiment_id, avg(variant_mismatch_rate) AS avg_mismatch_rate_7d FROM quality_daily_post
              WHERE date_day >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1 HAVING avg(variant_mismatch_rate) > 0.02) m
        JOIN (SELECT experiment_id, count(*) AS result_rows FROM results GROUP BY 1) r
          ON m.experiment_id = r.experiment_id""",
)
def _mismatch_gate(d: ExperimentDAG) -> DataFrame:
    return _r9(R.mismatch_gate(d.quality_daily_post, d.results, AS_OF))


@register(
    "exposure_health_report",
    f"""SELECT experiment_id, date_day, round(exposure_rate, 9) AS exposure_rate,
               round(valid_exposure_rate, 9) AS valid_exposure_rate, round(mismatch_rate, 9) AS mismatch_rate
        FROM quality_daily WHERE experiment_id = '{REPORT_EXPERIMENT}' ORDER BY date_day""",
)
def _health_report(d: ExperimentDAG) -> DataFrame:
    return _r9(R.exposure_health_report(d.quality_daily, REPORT_EXPERIMENT))


# ---- 2.11 guardrails -------------------------------------------------------------------------
@register("unit_outcomes", O.round9(["revenue"], "unit_outcomes", [
    "experiment_id", "unit_id", "variant_id", "anchor_at", "anchor_type", "window_days", "converted", "converted_at",
    "conversion_events"]))
def _unit_outcomes(d: ExperimentDAG) -> DataFrame:
    return _r9(d.unit_outcomes)


@register(
    "guard_assignment_unique",
    "SELECT experiment_id, raw_rows, unique_units, assignment_duplicates_count, assignment_unique_passed FROM g_assign",
)
def _g_assign(d: ExperimentDAG) -> DataFrame:
    return GR.guard_assignment_unique(d.raw_assignments)


@register(
    "guard_srm",
    """SELECT experiment_id, n_arms, total_units, round(chi_square, 9) AS chi_square,
              round(variant_allocation_deviation_pct, 9) AS variant_allocation_deviation_pct, chi_square_df,
              round(chi_square_p_value, 9) AS chi_square_p_value, unplanned_arms, srm_passed FROM srm""",
)
def _g_srm(d: ExperimentDAG) -> DataFrame:
    return _r9(GR.guard_srm(d.canonical, d.dim_variant, d.cfg))


@register(
    "guard_exposure_order",
    "SELECT experiment_id, exposure_before_assignment_count, exposure_order_passed FROM g_exposure_order",
)
def _g_exposure_order(d: ExperimentDAG) -> DataFrame:
    return GR.guard_exposure_order(d.validation)


@register(
    "guard_outcome_order",
    "SELECT experiment_id, outcomes_before_analysis_start_count, outcome_order_passed FROM g_outcome_order",
)
def _g_outcome_order(d: ExperimentDAG) -> DataFrame:
    """Conversions of the intent-to-treat window that come before the unit's first exposure."""
    return GR.guard_outcome_order(d.outcomes_from_start)


@register(
    "guard_outcome_grain",
    "SELECT experiment_id, duplicate_outcome_rows_count, outcome_grain_passed FROM g_outcome_grain",
)
def _g_outcome_grain(d: ExperimentDAG) -> DataFrame:
    """Outcome rows beyond one a unit, over the outcomes of raw assignments."""
    return GR.guard_outcome_grain(d.outcomes_of_raw)


@register(
    "guard_min_sample",
    "SELECT experiment_id, min_users_per_variant, max_users_per_variant, min_sample_warning FROM g_min_sample",
)
def _g_min_sample(d: ExperimentDAG) -> DataFrame:
    return GR.guard_min_sample(d.canonical, d.dim_variant, d.cfg)


@register("experiment_quality_report", "SELECT * FROM quality_report")
def _quality_report(d: ExperimentDAG) -> DataFrame:
    return _r9(d.quality_report(REPORT_DT))


@register("experiment_quality_report_valid", "SELECT * FROM quality_report_valid")
def _quality_report_valid(d: ExperimentDAG) -> DataFrame:
    """The report over validly exposed units: canonical assignments, and outcomes of those units."""
    return _r9(d.quality_report(REPORT_DT, valid_only=True))


@register(
    "gated_results",
    O.round9(_RES_D, "results", [c for c in _RES if c not in _RES_D])
    + " WHERE experiment_id IN (SELECT experiment_id FROM quality_report WHERE is_valid_for_analysis)",
)
def _gated(d: ExperimentDAG) -> DataFrame:
    now = d.at(REPORT_DT)
    return _r9(GR.gated_results(now.results.select(*_RES), now.quality_report(REPORT_DT)))


@register(
    "gated_results_valid",
    O.round9(_RES_D, "results_valid", [c for c in _RES if c not in _RES_D])
    + " WHERE experiment_id IN (SELECT experiment_id FROM quality_report_valid WHERE is_valid_for_analysis)",
)
def _gated_valid(d: ExperimentDAG) -> DataFrame:
    now = d.at(REPORT_DT)
    return _r9(GR.gated_results(now.results_valid.select(*_RES), now.quality_report(REPORT_DT, valid_only=True)))


@register(
    "gated_results_srm",
    O.round9(_RES_D, "results", [c for c in _RES if c not in _RES_D])
    + " WHERE experiment_id IN (SELECT experiment_id FROM quality_report WHERE NOT list_contains(failed_guardrails, 'srm'))",
)
def _gated_srm(d: ExperimentDAG) -> DataFrame:
    """The gate over the same unfiltered input where sample-ratio mismatch alone stops an experiment."""
    now = d.at(REPORT_DT)
    return _r9(GR.gated_results(now.results.select(*_RES), now.quality_report(REPORT_DT, blocking=("srm",))))


def _as_of(name: str) -> None:
    """Let the query's SQL see the events up to the end of the report day only."""
    seen = f"FROM (SELECT * FROM events WHERE ts < TIMESTAMP '{REPORT_DT}' + INTERVAL 1 DAY) events"
    ORACLES[name] = ORACLES[name].replace("FROM events", seen)


for _name in ("experiment_quality_report", "experiment_quality_report_valid", "gated_results", "gated_results_valid",
              "gated_results_srm"):
    _as_of(_name)


# ---- 2.8 governance --------------------------------------------------------------------------
@register("query_log_assets", "SELECT query_id, unnest(referenced_assets) AS asset_name FROM qrefs")
def _qlog_assets(d: ExperimentDAG) -> DataFrame:
    return G.query_log_assets(d.query_log)


@register("query_log_audit", "SELECT query_id, referenced_assets, violations, ok FROM qaudit")
def _qlog_audit(d: ExperimentDAG) -> DataFrame:
    return G.query_log_audit(d.query_log, G.allowed_assets(d.spark))


# ---- 2.10 assignment helpers and feeds ---------------------------------------------------------
@register("assign_variants", "SELECT experiment_id, unit_id, variant_id, bucket FROM assigned_variants")
def _assign_variants(d: ExperimentDAG) -> DataFrame:
    return assign.assign_variants(d.canonical.select("experiment_id", "unit_id"), d.dim_variant)


@register(
    "experiment_variants",
    "SELECT experiment_id, variant_id, variant_name, allocation_pct, is_control FROM dim_variant",
)
def _experiment_variants(d: ExperimentDAG) -> DataFrame:
    return d.dim_variant


@register(
    "union_event_feeds",
    """SELECT event_id, experiment_id, unit_id, variant_id, exposed_at, exposure_event_type, dt FROM raw_exposures
       UNION ALL BY NAME
       SELECT event_id, unit_id, occurred_at, revenue FROM conversions""",
)
def _union_feeds(d: ExperimentDAG) -> DataFrame:
    from abx.sources import lens as L

    return X.union_event_feeds(d.raw_exposures, L.conversions(d.events))


# ---- 2.12 extensions -------------------------------------------------------------------------
def _r6(df: DataFrame) -> DataFrame:
    return round_doubles(df, 6)


_WELCH = ["experiment_id", "variant_id", "n_control", "mean_control", "var_control", "n_treatment", "mean_treatment",
          "var_treatment", "diff", "se", "t_stat", "welch_df", "p_value_normal_approx", "p_value_t", "ci_low",
          "ci_high"]
_WELCH_D = [c for c in _WELCH if c not in ("experiment_id", "variant_id", "n_control", "n_treatment")]


@register("metric_mean_welch", "SELECT " + ", ".join(
    [c if c not in _WELCH_D else f"round({c}, 6) AS {c}" for c in _WELCH]) + " FROM welch")
def _welch(d: ExperimentDAG) -> DataFrame:
    return _r6(X.metric_mean_welch(d.unit_outcomes, d.cfg))


_QDV = _QD_COUNTS[:2] + ["assigned_variant_id"] + _QD_COUNTS[2:] + _QD_RATES


@register("quality_daily_by_variant", _sql_r9("quality_daily_by_variant", _QDV, ["avg_exposure_delay_seconds"] + _QD_RATES))
def _qd_by_variant(d: ExperimentDAG) -> DataFrame:
    return _r9(Q.quality_daily_by_variant(d.validation_any))


_ANOM = ["experiment_id", "date_day", "metric", "rate", "prev_rate", "trailing_avg_rate", "day_over_day_change",
         "change_vs_trailing", "is_anomaly"]


@register("quality_anomalies", _sql_r9("anomalies", _ANOM, _ANOM[3:8]))
def _anomalies(d: ExperimentDAG) -> DataFrame:
    return _r9(Q.quality_anomalies(d.quality_daily_post, ("exposure_rate", "variant_mismatch_rate")))


_SPINE = ["experiment_id", "unit_id", "variant_id", "metric_id", "event_name", "kind", "anchor", "window_days",
          "anchor_at", "is_eligible", "window_start_at", "window_end_at"]


@register("metric_spine", f"SELECT {', '.join(_SPINE)} FROM spine")
def _spine(d: ExperimentDAG) -> DataFrame:
    return X.metric_spine(d.cohort)


_MDE = ["experiment_id", "metric_id", "variant_id", "n_control", "n_treatment", "baseline_rate", "mde_abs", "mde_rel"]
_ZSUM = X.NormalDist().inv_cdf(1.0 - DEFAULT.alpha / 2.0) + X.NormalDist().inv_cdf(0.8)


@register(
    "power_mde",
    f"""SELECT experiment_id, metric_id, variant_id, n_control, n_treatment, round(baseline_rate, 9) AS baseline_rate,
               round(mde, 9) AS mde_abs, round(mde / NULLIF(baseline_rate, 0), 9) AS mde_rel
        FROM (SELECT t.experiment_id, t.metric_id, t.variant_id, c.n_users AS n_control, t.n_users AS n_treatment,
                     c.conversion_rate AS baseline_rate,
                     CAST('{_ZSUM!r}' AS DOUBLE) * sqrt(c.conversion_rate * (1.0 - c.conversion_rate)
                       * (1.0 / CAST(c.n_users AS DOUBLE) + 1.0 / CAST(t.n_users AS DOUBLE))) AS mde
              FROM (SELECT * FROM mbv WHERE variant_id != 'control') t
              JOIN (SELECT * FROM mbv WHERE variant_id = 'control') c
                ON t.experiment_id = c.experiment_id AND t.metric_id = c.metric_id)""",
)
def _power(d: ExperimentDAG) -> DataFrame:
    return _r9(X.power_mde(d.metric_by_variant, d.cfg))


@register(
    "p_adjusted",
    "SELECT experiment_id, metric_id, variant_id, round(p_value, 9) AS p_value, p_rank, n_tests, "
    "round(p_value_bh, 9) AS p_value_bh FROM bh",
)
def _p_adjusted(d: ExperimentDAG) -> DataFrame:
    return _r9(X.p_adjusted(d.results))


_CUPED = ["experiment_id", "variant_id", "n_units", "mean_pre", "mean_post", "theta", "mean_post_adjusted", "var_post",
          "var_post_adjusted"]


@register("cuped", "SELECT " + ", ".join(
    [c if c in ("experiment_id", "variant_id", "n_units") else f"round({c}, 6) AS {c}" for c in _CUPED]) + " FROM cuped")
def _cuped(d: ExperimentDAG) -> DataFrame:
    return _r6(X.cuped(d.cuped_units, d.cfg))


_MO = ["experiment_id", "unit_id", "variant_id", "metric_id", "kind", "is_eligible", "did_convert", "converted_at",
       "events"]


@register("metric_outcomes", O.round9(["value"], "metric_outcomes", _MO))
def _metric_outcomes(d: ExperimentDAG) -> DataFrame:
    from abx.operators import outcomes as OUT

    return _r9(
        OUT.metric_outcomes(X.metric_spine(d.cohort), d.conversions, d.cfg, prefilter=d.checkpoint_stages)
    )


# ---- time to event, sessions, identity, rollups ----------------------------------------------
@register(
    "first_match_after",
    """SELECT c.experiment_id, c.unit_id, c.variant_id, c.assigned_at AS anchor_at, min(v.occurred_at) AS next_at
       FROM canonical c LEFT JOIN conv v ON v.unit_id = c.unit_id AND v.occurred_at >= c.assigned_at GROUP BY ALL""",
)
def _first_match(d: ExperimentDAG) -> DataFrame:
    """Each canonical assignment with the unit's next conversion, however late."""
    return AS.first_match_after(d.itt_anchors, d.conversions)


@register(
    "window_outcomes_carry",
    f"""SELECT c.experiment_id, c.unit_id, c.variant_id, c.assigned_at AS anchor_at, min(v.occurred_at) AS first_at,
               count(v.occurred_at) AS n_events,
               round(CAST(sum(CAST(v.revenue AS DECIMAL(38, 10))) AS DOUBLE), 9) AS revenue
        FROM canonical c LEFT JOIN conv v ON v.unit_id = c.unit_id AND v.occurred_at >= c.assigned_at
         AND v.occurred_at < c.assigned_at + {O.CONVDAYS} GROUP BY 1, 2, 3, 4""",
)
def _window_carry(d: ExperimentDAG) -> DataFrame:
    """Windowed outcomes of every assignment without spreading anchors over days."""
    return _r9(AS.window_outcomes(d.itt_anchors, d.conversions, 0, d.cfg.conversion_window_days, d.cfg))


_KM = ["experiment_id", "variant_id", "steps", "at_risk", "events", "censored"]


@register("survival_curve", O.round9(["survival", "std_error", "cumulative_hazard"], "km", _KM))
def _survival_curve(d: ExperimentDAG) -> DataFrame:
    return _r9(SV.survival_curve(d.times_to_event))


@register(
    "survival_summary",
    """SELECT experiment_id, variant_id, max(at_risk) AS n_units, CAST(sum(events) AS BIGINT) AS n_events,
              min(CASE WHEN survival <= 0.5 THEN steps END) AS median_steps, max(steps) AS last_steps,
              round(min(survival), 9) AS last_survival FROM km GROUP BY 1, 2""",
)
def _survival_summary(d: ExperimentDAG) -> DataFrame:
    return _r9(SV.survival_summary(d.times_to_event))


_CHI = "(power(observed - expected, 2) / NULLIF(variance, 0))"


@register(
    "logrank_test",
    f"""SELECT experiment_id, variant_id, observed, round(expected, 9) AS expected, round(variance, 9) AS variance,
               round({_CHI}, 9) AS chi_square, round({O._p_exact(f"sqrt({_CHI})")}, 9) AS p_value,
               round(observed * (e_both - expected) / NULLIF((e_both - observed) * expected, 0), 9) AS hazard_ratio FROM logrank""",
)
def _logrank(d: ExperimentDAG) -> DataFrame:
    return _r9(SV.logrank_test(d.times_to_event, d.cfg))


_SESSION = ["unit_id", "session_no", "started_at", "ended_at", "n_events", "n_view", "n_click", "n_purchase"]


@register("sessions", O.round9(["duration_seconds"], "sessions", _SESSION))
def _sessions(d: ExperimentDAG) -> DataFrame:
    return _r9(d.sessions)


_SM = ["experiment_id", "variant_id", "n_units", "active_units", "n_sessions"]


@register(
    "session_metrics", O.round9(["sessions_per_unit", "events_per_unit", "avg_duration_seconds"], "session_metrics", _SM)
)
def _session_metrics(d: ExperimentDAG) -> DataFrame:
    own = d.sessions.withColumn("unit_id", F.col("unit_id").cast("string"))
    return _r9(SE.session_metrics(d.canonical, own, d.cfg))


@register("stitched_ids", "SELECT unit_id, person_id, n_units FROM stitched")
def _stitched_ids(d: ExperimentDAG) -> DataFrame:
    """The person of every unit, tied by devices that few units share."""
    return d.stitched_ids


@register(
    "stitched_assignments",
    "SELECT experiment_id, person_id, unit_id, variant_id, assigned_at, n_units, n_variants, is_conflicted "
    "FROM stitched_assignments",
)
def _stitched_assignments(d: ExperimentDAG) -> DataFrame:
    return ID.stitched_assignments(d.canonical, d.stitched_ids)


_ROLL = ["experiment_id", "date_day", "assigned_variant_id", "grouping_level", "assigned_units", "exposed_units",
         "valid_exposed_units", "variant_mismatch_units", "multi_variation_units", "pre_assignment_units",
         "outside_window_units"]


@register("quality_rollup", O.round9(["exposure_rate", "valid_exposure_rate", "mismatch_rate"], "quality_rollup", _ROLL))
def _quality_rollup(d: ExperimentDAG) -> DataFrame:
    return _r9(RO.quality_rollup(d.validation_any))


@register(
    "sketch_accuracy",
    """SELECT experiment_id, count(DISTINCT unit_id) AS exact_units,
              count(DISTINCT CASE WHEN NOT has_any_exposure THEN unit_id END) AS exact_unexposed,
              count(CASE WHEN has_any_exposure THEN exposure_delay_seconds END) AS n_delays,
              true AS units_within, true AS theta_within, true AS unexposed_within, true AS quantiles_within
       FROM validation_any GROUP BY 1""",
)
def _sketch_accuracy(d: ExperimentDAG) -> DataFrame:
    """Stored daily sketches merged over all days, beside exact counts."""
    return RO.sketch_accuracy(d.validation_any, RO.daily_sketches(d.validation_any))


# ---- resampling, versions, attribute bags ------------------------------------------------------
@register(
    "bootstrap_intervals",
    O.round9(
        ["control", "treatment", "diff", "std_error", "ci_low", "ci_high"],
        "boot",
        ["experiment_id", "variant_id", "statistic", "n_replicates"],
    ),
)
def _bootstrap(d: ExperimentDAG) -> DataFrame:
    """Revenue a unit and a conversion: arms against control, with intervals of 200 resampled tables."""
    return _r9(bootstrap.bootstrap_intervals(d.unit_outcomes, cfg=d.cfg))


@register("version_diff", "SELECT experiment_id, unit_id, change, old_rows, new_rows FROM version_diff")
def _version_diff(d: ExperimentDAG) -> DataFrame:
    """Canonical assignments as kept until one day against those kept from a later first day on."""
    old = assign.canonical_assignments(d.raw_assignments.filter(F.col("dt") <= F.lit(O.VERSION_UNTIL).cast("date")))
    new = assign.canonical_assignments(d.raw_assignments.filter(F.col("dt") >= F.lit(O.VERSION_FROM).cast("date")))
    return versions.version_diff(old, new, ["experiment_id", "unit_id"])


@register(
    "attribute_profile",
    O.round9(["min_number", "max_number"], "attribute_profile", ["event_type", "path", "value_type", "n_values"]),
)
def _attribute_profile(d: ExperimentDAG) -> DataFrame:
    """Paths and types of every event's properties by event type."""
    return _r9(profile.attribute_profile(d.events, "props", ["event_type"]))


@register(
    "first_exposures_stream",
    """SELECT experiment_id, unit_id, variant_id, min(exposed_at) AS first_exposed_at, count(*) > 0 AS is_final
       FROM raw_exposures GROUP BY 1, 2, 3""",
)
def _first_exposures_stream(d: ExperimentDAG) -> DataFrame:
    """Earliest exposure of each key as a stream leaves it that reads the feed in shuffled order, four batches long."""
    return FE.replay(d.raw_exposures, batches=4)
