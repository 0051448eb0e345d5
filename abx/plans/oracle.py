"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle follows the reference's own relational shape (separate first-any / first-post
``row_number`` joins, stats joined back, ``CASE`` flags), not the one-pass Spark plan, so the two
implementations check each other. CTEs are declared once and pulled in by dependency.
"""

from __future__ import annotations

import re

from abx.sources.lens import LENS_CTES

GRACE = "INTERVAL 5 MINUTE"
MAXDAYS = "INTERVAL 7 DAY"
CONVDAYS = "INTERVAL 7 DAY"
EPOCH_S = "(epoch_us({x}) // 1000000)"


def _epoch(x: str) -> str:
    return EPOCH_S.format(x=x)


def _p_two_sided(z: str, cap: bool) -> str:
    """A&S 26.2.17 polynomial, same evaluation order as the Spark Column expression."""
    za = f"abs({z})"
    t = f"(1.0 / (1.0 + 0.2316419 * {za}))"
    poly = (
        f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * "
        f"(-1.821255978 + {t} * 1.330274429)))))"
    )
    pdf = f"(exp(-0.5 * {za} * {za}) / sqrt(2 * pi()))"
    p = f"(2.0 * {pdf} * {poly})"
    return f"CASE WHEN {z} IS NULL THEN NULL ELSE LEAST({p}, 1.0) END" if cap else p


def _p_exact(z: str) -> str:
    """Two-sided normal tail by Simpson integration of the density on [0, |z|] (4000 intervals),
    independent of the incomplete-gamma form used in Spark; |z| > 10 gives p < 1e-23 -> 0."""
    za = f"abs({z})"
    simpson = (
        f"(SELECT sum(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
        f" * exp(-0.5 * pow(i * {za} / 4000.0, 2))) FROM range(0, 4001) r(i))"
    )
    p = f"GREATEST(LEAST(1.0 - 2.0 * {simpson} * {za} / 4000.0 / 3.0 / sqrt(2 * pi()), 1.0), 0.0)"
    return f"CASE WHEN {z} IS NULL THEN NULL WHEN {za} > 10 THEN 0.0 ELSE {p} END"


CTES: dict[str, str] = dict(LENS_CTES)

CTES["canonical"] = """
SELECT experiment_id, unit_id, variant_id, assigned_at, assignment_source, dt FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, unit_id
                               ORDER BY assigned_at ASC NULLS LAST, variant_id ASC NULLS LAST,
                                        assignment_source ASC NULLS LAST, dt ASC NULLS LAST) AS rn
  FROM raw_assignments) WHERE rn = 1"""

CTES["event_feed"] = """
SELECT event_id, 'experiment_exposed' AS event_name, exposed_at AS occurred_at, unit_id, experiment_id,
       variant_id AS variation_id, props AS properties, CAST(NULL AS DOUBLE) AS revenue,
       CAST(NULL AS TIMESTAMP) AS ingested_at
FROM raw_exposures
UNION ALL
SELECT event_id, 'purchase', occurred_at, unit_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), props, revenue,
       CAST(NULL AS TIMESTAMP)
FROM conversions"""

CTES["staged"] = """
SELECT * FROM (
  SELECT event_id,
         COALESCE(experiment_id, json_extract_string(properties, '$.experiment_id')) AS experiment_id,
         COALESCE(unit_id, json_extract_string(properties, '$.user_id')) AS unit_id,
         COALESCE(variation_id, json_extract_string(properties, '$.variation_id')) AS variant_id,
         occurred_at AS exposed_at, ingested_at
  FROM event_feed WHERE event_name = 'experiment_exposed')
WHERE experiment_id IS NOT NULL AND unit_id IS NOT NULL AND exposed_at IS NOT NULL"""

CTES["conv"] = """
SELECT event_id, unit_id, occurred_at, event_name, revenue
FROM event_feed WHERE event_name = 'purchase' AND unit_id IS NOT NULL AND occurred_at IS NOT NULL"""

CTES["deduped"] = """
SELECT event_id, experiment_id, unit_id, variant_id, exposed_at, ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, unit_id, variant_id
       ORDER BY exposed_at ASC NULLS LAST, CASE WHEN ingested_at IS NULL THEN 1 ELSE 0 END, ingested_at ASC NULLS LAST,
                event_id ASC NULLS LAST) AS rn
  FROM staged) WHERE rn = 1"""

CTES["staged_strict"] = """
SELECT experiment_id, unit_id, variant_id, exposed_at, exposure_event_type,
       sha256(concat_ws('||', experiment_id, unit_id, variant_id, strftime(exposed_at, '%Y-%m-%d %H:%M:%S.%f'),
                        exposure_event_type)) AS exposure_event_id
FROM raw_exposures
WHERE experiment_id IS NOT NULL AND unit_id IS NOT NULL AND exposed_at IS NOT NULL AND variant_id IS NOT NULL"""

CTES["deduped_strict"] = """
SELECT experiment_id, unit_id, variant_id, exposed_at, exposure_event_type, exposure_event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, unit_id, variant_id
                               ORDER BY exposed_at ASC NULLS LAST, exposure_event_id ASC NULLS LAST) AS rn
  FROM staged_strict) WHERE rn = 1"""


def _validation_ctes(prefix: str, exposures: str, id_col: str) -> None:
    CTES[f"{prefix}_stats"] = f"""
SELECT experiment_id, unit_id, count(*) AS exposure_event_count,
       count(DISTINCT variant_id) AS exposure_variation_count
FROM {exposures} GROUP BY experiment_id, unit_id"""
    for kind, extra in (("any", ""), ("post", f" AND e.exposed_at >= a.assigned_at - {GRACE}")):
        CTES[f"{prefix}_{kind}"] = f"""
SELECT experiment_id, unit_id, exposure_at, exposure_variant_id, exposure_event_id FROM (
  SELECT a.experiment_id, a.unit_id, e.exposed_at AS exposure_at, e.variant_id AS exposure_variant_id,
         e.{id_col} AS exposure_event_id,
         row_number() OVER (PARTITION BY a.experiment_id, a.unit_id
                            ORDER BY e.exposed_at ASC NULLS LAST, e.{id_col} ASC NULLS LAST) AS rn
  FROM canonical a LEFT JOIN {exposures} e
    ON a.experiment_id = e.experiment_id AND a.unit_id = e.unit_id{extra}) WHERE rn = 1"""


_validation_ctes("vw", "deduped", "event_id")
_validation_ctes("vj", "deduped_strict", "exposure_event_id")

_STATUS = """CASE
  WHEN has_any_exposure = false THEN 'no_exposure'
  WHEN has_multiple_variations_exposed = true THEN 'multi_variation_exposure'
  WHEN is_pre_assignment_exposure = true THEN 'pre_assignment_exposure'
  WHEN exposure_outside_window = true THEN 'exposure_outside_window'
  WHEN is_variant_mismatch = true THEN 'variant_mismatch'
  WHEN has_valid_exposure = true THEN 'valid'
  ELSE 'invalid_other' END"""

CTES["validation_flags"] = f"""
SELECT a.experiment_id, a.unit_id, a.variant_id AS assigned_variant_id, a.assigned_at,
  fa.exposure_at AS first_exposure_any_at, fa.exposure_variant_id AS first_exposure_any_variant_id,
  fa.exposure_event_id AS first_exposure_any_event_id,
  fp.exposure_at AS first_exposure_at, fp.exposure_variant_id AS first_exposure_variant_id,
  fp.exposure_event_id AS first_exposure_event_id,
  {_epoch('fp.exposure_at')} - {_epoch('a.assigned_at')} AS exposure_delay_seconds,
  es.exposure_event_count, es.exposure_variation_count,
  CASE WHEN fa.exposure_at IS NOT NULL THEN true ELSE false END AS has_any_exposure,
  CASE WHEN fp.exposure_at IS NOT NULL THEN true ELSE false END AS has_post_assignment_exposure,
  CASE WHEN fp.exposure_at IS NULL THEN false
       WHEN fp.exposure_at > a.assigned_at + {MAXDAYS} THEN false
       WHEN fp.exposure_variant_id != a.variant_id THEN false
       WHEN es.exposure_variation_count > 1 THEN false
       ELSE true END AS has_valid_exposure,
  CASE WHEN fa.exposure_at IS NULL THEN false
       WHEN fa.exposure_at < a.assigned_at - {GRACE} THEN true ELSE false END AS is_pre_assignment_exposure,
  CASE WHEN fp.exposure_at IS NULL THEN false
       WHEN fp.exposure_variant_id != a.variant_id THEN true ELSE false END AS is_variant_mismatch,
  CASE WHEN es.exposure_variation_count > 1 THEN true ELSE false END AS has_multiple_variations_exposed,
  CASE WHEN fp.exposure_at IS NULL THEN false
       WHEN fp.exposure_at > a.assigned_at + {MAXDAYS} THEN true ELSE false END AS exposure_outside_window,
  a.dt
FROM canonical a
LEFT JOIN vw_any fa ON a.experiment_id = fa.experiment_id AND a.unit_id = fa.unit_id
LEFT JOIN vw_post fp ON a.experiment_id = fp.experiment_id AND a.unit_id = fp.unit_id
LEFT JOIN vw_stats es ON a.experiment_id = es.experiment_id AND a.unit_id = es.unit_id"""

CTES["validation"] = f"SELECT *, {_STATUS} AS validation_status FROM validation_flags"

CTES["validation_any_flags"] = f"""
SELECT *,
  CASE WHEN has_any_exposure AND NOT is_pre_assignment_exposure AND NOT exposure_outside_window
            AND NOT is_variant_mismatch AND NOT has_multiple_variations_exposed THEN true ELSE false END
    AS has_valid_exposure
FROM (
SELECT a.experiment_id, a.unit_id, a.variant_id AS assigned_variant_id, a.assigned_at,
  fa.exposure_at AS first_exposure_any_at, fa.exposure_variant_id AS first_exposure_any_variant_id,
  fa.exposure_event_id AS first_exposure_any_event_id,
  fa.exposure_at AS first_exposure_at, fa.exposure_variant_id AS first_exposure_variant_id,
  fa.exposure_event_id AS first_exposure_event_id,
  CASE WHEN fa.exposure_at IS NOT NULL THEN {_epoch('fa.exposure_at')} - {_epoch('a.assigned_at')} END
    AS exposure_delay_seconds,
  es.exposure_event_count, es.exposure_variation_count,
  fa.exposure_at IS NOT NULL AS has_any_exposure,
  fp.exposure_at IS NOT NULL AS has_post_assignment_exposure,
  CASE WHEN fa.exposure_at IS NOT NULL AND fa.exposure_at < a.assigned_at - {GRACE} THEN true ELSE false END
    AS is_pre_assignment_exposure,
  CASE WHEN fa.exposure_at IS NOT NULL AND fa.exposure_at > a.assigned_at + {MAXDAYS} THEN true ELSE false END
    AS exposure_outside_window,
  CASE WHEN fa.exposure_at IS NOT NULL AND fa.exposure_variant_id != a.variant_id THEN true ELSE false END
    AS is_variant_mismatch,
  CASE WHEN es.exposure_variation_count > 1 THEN true ELSE false END AS has_multiple_variations_exposed,
  a.dt
FROM canonical a
LEFT JOIN vj_any fa ON a.experiment_id = fa.experiment_id AND a.unit_id = fa.unit_id
LEFT JOIN vj_post fp ON a.experiment_id = fp.experiment_id AND a.unit_id = fp.unit_id
LEFT JOIN vj_stats es ON a.experiment_id = es.experiment_id AND a.unit_id = es.unit_id)"""

CTES["validation_any"] = f"SELECT *, {_STATUS} AS validation_status FROM validation_any_flags"


def _sum_if(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _rate(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def _quality_counts(src: str, extra_keys: str = "") -> str:
    k = f", {extra_keys}" if extra_keys else ""
    return f"""
SELECT experiment_id, CAST(assigned_at AS DATE) AS date_day{k},
  count(*) AS assigned_units,
  {_sum_if('has_any_exposure')} AS exposed_units,
  {_sum_if('has_valid_exposure')} AS valid_exposed_units,
  {_sum_if('NOT has_any_exposure')} AS missing_exposure_units,
  {_sum_if('is_variant_mismatch')} AS variant_mismatch_units,
  {_sum_if('has_multiple_variations_exposed')} AS multi_variation_units,
  {_sum_if('is_pre_assignment_exposure')} AS pre_assignment_units,
  {_sum_if('exposure_outside_window')} AS outside_window_units,
  avg(CASE WHEN has_any_exposure THEN exposure_delay_seconds END) AS avg_exposure_delay_seconds
FROM {src} GROUP BY ALL"""


_QUALITY_RATES = f"""
SELECT *,
  {_rate('exposed_units', 'assigned_units')} AS exposure_rate,
  {_rate('valid_exposed_units', 'assigned_units')} AS valid_exposure_rate,
  {_rate('variant_mismatch_units', 'exposed_units')} AS mismatch_rate,
  {_rate('missing_exposure_units', 'assigned_units')} AS percent_missing_exposure,
  {_rate('multi_variation_units', 'assigned_units')} AS percent_multiple_exposures,
  {_rate('pre_assignment_units', 'assigned_units')} AS pre_assignment_rate,
  {_rate('outside_window_units', 'assigned_units')} AS outside_window_rate
FROM {{src}}"""

CTES["quality_daily_counts"] = _quality_counts("validation_any")
CTES["quality_daily"] = _QUALITY_RATES.format(src="quality_daily_counts")
CTES["quality_daily_by_variant_counts"] = _quality_counts("validation_any", "assigned_variant_id")
CTES["quality_daily_by_variant"] = _QUALITY_RATES.format(src="quality_daily_by_variant_counts")

CTES["quality_daily_post"] = f"""
SELECT experiment_id, CAST(assigned_at AS DATE) AS date_day,
  count(*) AS assigned_units,
  {_sum_if('has_post_assignment_exposure')} AS exposed_units,
  {_sum_if('has_valid_exposure')} AS valid_exposed_units,
  {_rate(_sum_if('has_post_assignment_exposure'), 'count(*)')} AS exposure_rate,
  {_rate(_sum_if('has_valid_exposure'), 'count(*)')} AS valid_exposure_rate,
  {_rate(_sum_if('is_variant_mismatch'), 'count(*)')} AS variant_mismatch_rate,
  {_rate(_sum_if('has_multiple_variations_exposed'), 'count(*)')} AS multi_variation_rate,
  {_rate(_sum_if('is_pre_assignment_exposure'), 'count(*)')} AS pre_assignment_rate,
  {_rate(_sum_if('exposure_outside_window'), 'count(*)')} AS outside_window_rate,
  avg(CASE WHEN has_any_exposure THEN exposure_delay_seconds END) AS avg_exposure_delay_seconds
FROM validation GROUP BY ALL"""

CTES["exposure_audit"] = f"""
SELECT *, CASE WHEN exposure_rate < 0.7 THEN 'critical' WHEN exposure_rate < 0.9 THEN 'warning' ELSE 'ok' END
  AS exposure_health
FROM (
SELECT experiment_id, CAST(assigned_at AS DATE) AS date_day,
  count(*) AS assigned_units,
  {_sum_if('has_post_assignment_exposure')} AS exposed_units,
  {_sum_if('has_valid_exposure')} AS valid_exposed_units,
  {_rate(_sum_if('has_post_assignment_exposure'), 'count(*)')} AS exposure_rate,
  {_rate(_sum_if('has_valid_exposure'), 'count(*)')} AS valid_exposure_rate,
  {_sum_if('is_variant_mismatch')} AS mismatch_units,
  {_sum_if('has_multiple_variations_exposed')} AS multi_variation_units,
  {_sum_if('is_pre_assignment_exposure')} AS pre_assignment_units,
  {_sum_if('exposure_outside_window')} AS outside_window_units,
  avg(CASE WHEN has_post_assignment_exposure THEN exposure_delay_seconds END) AS avg_exposure_delay_seconds
FROM validation GROUP BY ALL)"""

CTES["cohort"] = """
SELECT a.experiment_id, a.unit_id, a.variant_id AS assigned_variant_id, a.assigned_at,
  v.first_exposure_at, v.first_exposure_variant_id, v.has_post_assignment_exposure, v.exposure_delay_seconds,
  v.has_valid_exposure, v.validation_status,
  true AS is_in_itt_cohort, v.has_post_assignment_exposure AS is_in_exposure_cohort,
  v.has_valid_exposure AS is_in_valid_exposure_cohort
FROM canonical a LEFT JOIN validation v ON a.experiment_id = v.experiment_id AND a.unit_id = v.unit_id"""

CTES["outcomes_exposed"] = f"""
SELECT experiment_id, unit_id, variant_id, anchor_at, 'conversion_7d' AS metric_id, 7 AS window_days,
       converted_at IS NOT NULL AS did_convert, converted_at
FROM (
  SELECT c.experiment_id, c.unit_id, c.assigned_variant_id AS variant_id, c.first_exposure_at AS anchor_at,
         min(cv.occurred_at) AS converted_at
  FROM (SELECT * FROM cohort WHERE has_post_assignment_exposure = true) c
  LEFT JOIN conv cv ON c.unit_id = cv.unit_id AND cv.occurred_at >= c.first_exposure_at
                   AND cv.occurred_at < c.first_exposure_at + {CONVDAYS}
  GROUP BY 1, 2, 3, 4)"""

CTES["outcomes_itt"] = f"""
SELECT experiment_id, unit_id, variant_id, anchor_at, 'conversion_7d' AS metric_id, 7 AS window_days,
       max(is_converted) = 1 AS did_convert,
       min(CASE WHEN is_converted = 1 THEN occurred_at END) AS converted_at
FROM (
  SELECT c.experiment_id, c.unit_id, c.assigned_variant_id AS variant_id, c.assigned_at AS anchor_at,
         cv.occurred_at,
         CASE WHEN cv.occurred_at IS NOT NULL AND cv.occurred_at >= c.assigned_at
                   AND cv.occurred_at < c.assigned_at + {CONVDAYS} THEN 1 ELSE 0 END AS is_converted
  FROM cohort c LEFT JOIN conv cv ON c.unit_id = cv.unit_id)
GROUP BY 1, 2, 3, 4"""

CTES["mbv"] = f"""
SELECT experiment_id, metric_id, variant_id, n_users, conversions,
       {_rate('conversions', 'n_users')} AS conversion_rate,
       {_rate('conversions', 'n_users')} * (1.0 - {_rate('conversions', 'n_users')}) / NULLIF(CAST(n_users AS DOUBLE), 0)
         AS var_p
FROM (SELECT experiment_id, metric_id, variant_id, count(*) AS n_users, {_sum_if('did_convert')} AS conversions
      FROM outcomes_exposed GROUP BY ALL)"""

CTES["mbv_rounded"] = f"""
SELECT experiment_id, variant_id, n_users, n_converted, round({_rate('n_converted', 'n_users')}, 4) AS conversion_rate
FROM (SELECT experiment_id, variant_id, count(*) AS n_users, {_sum_if('did_convert')} AS n_converted
      FROM outcomes_itt GROUP BY ALL)"""

CTES["results1"] = """
SELECT b.experiment_id, b.metric_id, b.variant_id, b.n_users, b.conversions, b.conversion_rate,
       c.n_users AS control_n_users, c.conversions AS control_conversions, c.conversion_rate AS control_conversion_rate,
       b.conversion_rate - c.conversion_rate AS uplift_abs,
       b.conversion_rate / NULLIF(c.conversion_rate, 0) - 1.0 AS uplift_rel,
       CAST(b.conversions + c.conversions AS DOUBLE) / NULLIF(CAST(b.n_users + c.n_users AS DOUBLE), 0) AS pooled_p
FROM mbv b LEFT JOIN (SELECT * FROM mbv WHERE variant_id = 'control') c
  ON b.experiment_id = c.experiment_id AND b.metric_id = c.metric_id"""

CTES["results2"] = """
SELECT *, sqrt(pooled_p * (1.0 - pooled_p) * (1.0 / NULLIF(CAST(n_users AS DOUBLE), 0)
                                              + 1.0 / NULLIF(CAST(control_n_users AS DOUBLE), 0))) AS se,
       sqrt(conversion_rate * (1.0 - conversion_rate) / NULLIF(CAST(n_users AS DOUBLE), 0)
            + control_conversion_rate * (1.0 - control_conversion_rate) / NULLIF(CAST(control_n_users AS DOUBLE), 0))
         AS se_unpooled
FROM results1"""

CTES["results3"] = "SELECT *, uplift_abs / NULLIF(se, 0) AS z FROM results2"

CTES["results"] = f"""
SELECT *, uplift_abs - 1.96 * se_unpooled AS ci_low, uplift_abs + 1.96 * se_unpooled AS ci_high,
       p_value_two_sided < 0.05 AS is_statistically_significant_95
FROM (SELECT *, {_p_exact('z')} AS p_value_two_sided FROM results3)"""

CTES["pairwise1"] = """
SELECT t.experiment_id, t.variant_id, c.n_users AS n_control, c.n_converted AS conv_control,
       c.conversion_rate AS cr_control, t.n_users AS n_treatment, t.n_converted AS conv_treatment,
       t.conversion_rate AS cr_treatment, t.conversion_rate - c.conversion_rate AS uplift_abs,
       CAST(c.n_converted + t.n_converted AS DOUBLE) / NULLIF(CAST(c.n_users + t.n_users AS DOUBLE), 0) AS p_pool
FROM (SELECT * FROM mbv_rounded WHERE variant_id != 'control') t
JOIN (SELECT * FROM mbv_rounded WHERE variant_id = 'control') c ON t.experiment_id = c.experiment_id"""

CTES["pairwise2"] = """
SELECT *, sqrt(p_pool * (1.0 - p_pool) * (1.0 / NULLIF(CAST(n_control AS DOUBLE), 0)
                                          + 1.0 / NULLIF(CAST(n_treatment AS DOUBLE), 0))) AS se
FROM pairwise1"""

CTES["pairwise"] = f"""
SELECT experiment_id, variant_id, n_control, conv_control, cr_control, n_treatment, conv_treatment, cr_treatment,
       uplift_abs, se, z_score, {_p_two_sided('z_score', cap=False)} AS p_value_two_sided,
       uplift_abs - 1.96 * se AS ci_low, uplift_abs + 1.96 * se AS ci_high
FROM (SELECT *, uplift_abs / NULLIF(se, 0) AS z_score FROM pairwise2)"""

CTES["governed"] = """
SELECT experiment_id, variant_id, n_control, cr_control, n_treatment, cr_treatment, uplift_abs, z_score,
       p_value_two_sided AS p_value, ci_low, ci_high
FROM pairwise"""

CTES["won"] = """
SELECT *, CASE WHEN p_value < 0.05 AND uplift_abs > 0 THEN true ELSE false END AS did_treatment_win FROM governed"""


def _deps(sql: str) -> list[str]:
    names = set(re.findall(r"\b([a-z_][a-z0-9_]*)\b", sql))
    return [n for n in CTES if n in names]


def build(final: str) -> str:
    """``WITH <needed CTEs in dependency order> <final>``."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d)
        order.append(name)

    for n in _deps(final):
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {body}\n{final.strip()}"


def round9(cols: list[str], table: str, keep: list[str]) -> str:
    """SELECT keep..., round(col, 9) AS col ... FROM table."""
    parts = list(keep) + [f"round({c}, 9) AS {c}" for c in cols]
    return f"SELECT {', '.join(parts)} FROM {table}"


# ---- dimensions, guardrails ----------------------------------------------------------------
CTES["dim_experiment"] = """
SELECT experiment_id, min(assigned_at) AS start_at, max(assigned_at) AS end_at FROM raw_assignments GROUP BY 1"""

CTES["dim_variant"] = """
SELECT e.experiment_id, t.variant_id, t.variant_name, CAST(t.allocation_pct AS DOUBLE) AS allocation_pct, t.is_control
FROM dim_experiment e
CROSS JOIN (VALUES ('control', 'Control', 50.0, true), ('treatment', 'Treatment', 50.0, false))
  AS t(variant_id, variant_name, allocation_pct, is_control)"""

CTES["srm_obs"] = """
SELECT COALESCE(d.experiment_id, o.experiment_id) AS experiment_id, COALESCE(d.variant_id, o.variant_id) AS variant_id,
       d.variant_id IS NOT NULL AS is_planned, COALESCE(d.allocation_pct, 0.0) AS allocation_pct,
       CAST(COALESCE(o.observed, 0) AS BIGINT) AS observed
FROM dim_variant d
FULL JOIN (SELECT experiment_id, variant_id, count(*) AS observed FROM canonical GROUP BY 1, 2) o
  ON d.experiment_id = o.experiment_id AND d.variant_id = o.variant_id"""

CTES["srm_arms"] = """
SELECT a.*, t.total_units, t.n_arms, t.unplanned_arms,
       a.allocation_pct / NULLIF(t.total_alloc, 0) AS expected_share,
       CAST(a.observed AS DOUBLE) / NULLIF(CAST(t.total_units AS DOUBLE), 0) AS observed_share,
       CAST(t.total_units AS DOUBLE) * (a.allocation_pct / NULLIF(t.total_alloc, 0)) AS expected
FROM srm_obs a
JOIN (SELECT experiment_id, CAST(sum(observed) AS BIGINT) AS total_units, sum(allocation_pct) AS total_alloc,
             CAST(count_if(is_planned) AS BIGINT) AS n_arms,
             COALESCE(list_sort(list(DISTINCT variant_id) FILTER (NOT is_planned AND observed > 0)), []) AS unplanned_arms
      FROM srm_obs GROUP BY 1) t
  ON a.experiment_id = t.experiment_id"""

CTES["srm1"] = """
SELECT experiment_id, n_arms, total_units, unplanned_arms,
       COALESCE(sum(CASE WHEN expected > 0 THEN (observed - expected) * (observed - expected) / expected END), 0.0)
         AS chi_square,
       max(abs(observed_share - expected_share)) * 100.0 AS variant_allocation_deviation_pct,
       CAST(n_arms - 1 AS INTEGER) AS chi_square_df
FROM srm_arms GROUP BY experiment_id, n_arms, total_units, unplanned_arms"""


def _chi2_tail(x: str, df: str) -> str:
    h = f"({x} / 2.0)"
    odd = (
        f"({_p_exact(f'sqrt({x})')} + exp(-{h}) * COALESCE((SELECT sum(exp((i - 0.5) * ln({h}) - "
        f"lgamma(i + 0.5))) FROM range(1, CAST(({df} - 1) // 2 AS BIGINT) + 1) r(i)), 0.0))"
    )
    even = (
        f"(exp(-{h}) * (1.0 + COALESCE((SELECT sum(exp(i * ln({h}) - lgamma(i + 1))) "
        f"FROM range(1, CAST({df} // 2 AS BIGINT)) r(i)), 0.0)))"
    )
    q = f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {df} % 2 = 1 THEN {odd} ELSE {even} END"
    return f"CASE WHEN {x} IS NULL OR {df} IS NULL OR {df} < 1 THEN NULL ELSE LEAST(GREATEST({q}, 0.0), 1.0) END"


CTES["srm"] = f"""
SELECT *, COALESCE(variant_allocation_deviation_pct, 0.0) <= 3.0 AND COALESCE(chi_square_p_value, 1.0) >= 0.01
         AND len(unplanned_arms) = 0 AS srm_passed
FROM (SELECT *, {_chi2_tail('chi_square', 'chi_square_df')} AS chi_square_p_value FROM srm1)"""

CTES["g_assign"] = """
SELECT experiment_id, CAST(sum(c) AS BIGINT) AS raw_rows, count(*) AS unique_units,
       CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS assignment_duplicates_count,
       COALESCE(sum(c - 1), 0) = 0 AS assignment_unique_passed
FROM (SELECT experiment_id, unit_id, count(*) AS c FROM raw_assignments GROUP BY 1, 2) GROUP BY 1"""

CTES["g_exposure_order"] = f"""
SELECT experiment_id, {_sum_if('first_exposure_any_at < assigned_at')} AS exposure_before_assignment_count,
       {_sum_if('first_exposure_any_at < assigned_at')} = 0 AS exposure_order_passed
FROM validation GROUP BY 1"""

CTES["g_outcome_order"] = f"""
SELECT o.experiment_id, {_sum_if('o.converted_at < COALESCE(c.first_exposure_at, c.assigned_at)')}
         AS outcomes_before_analysis_start_count,
       {_sum_if('o.converted_at < COALESCE(c.first_exposure_at, c.assigned_at)')} = 0 AS outcome_order_passed
FROM outcomes_itt o JOIN cohort c ON c.experiment_id = o.experiment_id AND c.unit_id = o.unit_id GROUP BY 1"""

CTES["g_outcome_order_valid"] = f"""
SELECT experiment_id, {_sum_if('converted_at < anchor_at')} AS outcomes_before_analysis_start_count,
       {_sum_if('converted_at < anchor_at')} = 0 AS outcome_order_passed
FROM outcomes_exposed_valid GROUP BY 1"""

CTES["unit_outcomes"] = f"""
SELECT experiment_id, unit_id, variant_id, anchor_at, anchor_type, 7 AS window_days,
       converted_at IS NOT NULL AS converted, converted_at, conversion_events, revenue
FROM (
  SELECT c.experiment_id, c.unit_id, c.assigned_variant_id AS variant_id,
         COALESCE(c.first_exposure_at, c.assigned_at) AS anchor_at,
         CASE WHEN c.first_exposure_at IS NOT NULL THEN 'exposure' ELSE 'assignment' END AS anchor_type,
         min(cv.occurred_at) AS converted_at, count(cv.occurred_at) AS conversion_events,
         COALESCE(CAST(sum(CAST(cv.revenue AS DECIMAL(38, 10))) AS DOUBLE), 0.0) AS revenue
  FROM cohort c LEFT JOIN conv cv ON c.unit_id = cv.unit_id
       AND cv.occurred_at >= COALESCE(c.first_exposure_at, c.assigned_at)
       AND cv.occurred_at < COALESCE(c.first_exposure_at, c.assigned_at) + {CONVDAYS}
  GROUP BY 1, 2, 3, 4, 5)"""

CTES["raw_outcome_rows"] = "SELECT DISTINCT experiment_id, unit_id, variant_id, assigned_at FROM raw_assignments"

CTES["g_outcome_grain"] = """
SELECT experiment_id, CAST(COALESCE(sum(c - 1), 0) AS BIGINT) AS duplicate_outcome_rows_count,
       COALESCE(sum(c - 1), 0) = 0 AS outcome_grain_passed
FROM (SELECT experiment_id, unit_id, count(*) AS c FROM raw_outcome_rows GROUP BY 1, 2) GROUP BY 1"""

CTES["g_min_sample"] = """
SELECT experiment_id, min(observed) AS min_users_per_variant, max(observed) AS max_users_per_variant,
       min(observed) < 30 AS min_sample_warning
FROM srm_arms GROUP BY 1"""

CTES["quality_report"] = """
SELECT e.experiment_id, DATE '2024-01-24' AS dt,
  len(failed) = 0 AS is_valid_for_analysis, failed AS failed_guardrails, warnings,
  assignment_duplicates_count, round(variant_allocation_deviation_pct, 9) AS variant_allocation_deviation_pct,
  round(chi_square_p_value, 9) AS chi_square_p_value, unplanned_arms, exposure_before_assignment_count,
  outcomes_before_analysis_start_count, duplicate_outcome_rows_count, min_users_per_variant
FROM (
  SELECT e.experiment_id, a.assignment_duplicates_count, s.variant_allocation_deviation_pct, s.chi_square_p_value, s.unplanned_arms,
         x.exposure_before_assignment_count, o.outcomes_before_analysis_start_count, g.duplicate_outcome_rows_count,
         m.min_users_per_variant,
         list_filter([CASE WHEN NOT COALESCE(a.assignment_unique_passed, true) THEN 'assignment_unique' END,
                      CASE WHEN NOT COALESCE(s.srm_passed, true) THEN 'srm' END,
                      CASE WHEN NOT COALESCE(x.exposure_order_passed, true) THEN 'exposure_order' END,
                      CASE WHEN NOT COALESCE(o.outcome_order_passed, true) THEN 'outcome_order' END,
                      CASE WHEN NOT COALESCE(g.outcome_grain_passed, true) THEN 'outcome_grain' END],
                     lambda v: v IS NOT NULL) AS failed,
         list_filter([CASE WHEN COALESCE(m.min_sample_warning, false) THEN 'min_sample' END], lambda v: v IS NOT NULL)
           AS warnings
  FROM (SELECT DISTINCT experiment_id FROM dim_experiment) e
  LEFT JOIN g_assign a ON e.experiment_id = a.experiment_id
  LEFT JOIN srm s ON e.experiment_id = s.experiment_id
  LEFT JOIN g_exposure_order x ON e.experiment_id = x.experiment_id
  LEFT JOIN g_outcome_order o ON e.experiment_id = o.experiment_id
  LEFT JOIN g_outcome_grain g ON e.experiment_id = g.experiment_id
  LEFT JOIN g_min_sample m ON e.experiment_id = m.experiment_id) e"""

# The same guards over validly exposed units: every stage of theirs gets a twin with suffix _valid.
CTES["cohort_valid"] = "SELECT * FROM cohort WHERE is_in_valid_exposure_cohort AND validation_status = 'valid'"
CTES["units_valid"] = "SELECT experiment_id, unit_id, assigned_variant_id AS variant_id FROM cohort_valid"
CTES["validation_valid"] = "SELECT * FROM validation WHERE validation_status = 'valid'"
_TWINS = {
    "outcomes_exposed": {"cohort": "cohort_valid"},
    "mbv": {"outcomes_exposed": "outcomes_exposed_valid"},
    "results1": {"mbv": "mbv_valid"},
    "results2": {"results1": "results1_valid"},
    "results3": {"results2": "results2_valid"},
    "results": {"results3": "results3_valid"},
    "unit_outcomes": {"cohort": "cohort_valid"},
    "g_assign": {"raw_assignments": "units_valid"},
    "srm_obs": {"canonical": "units_valid"},
    "srm_arms": {"srm_obs": "srm_obs_valid"},
    "srm1": {"srm_arms": "srm_arms_valid"},
    "srm": {"srm1": "srm1_valid"},
    "g_exposure_order": {"validation": "validation_valid"},
    "g_outcome_grain": {"raw_outcome_rows": "unit_outcomes_valid"},
    "g_min_sample": {"srm_arms": "srm_arms_valid"},
    "quality_report": {
        t: f"{t}_valid" for t in ("g_assign", "srm", "g_exposure_order", "g_outcome_order", "g_outcome_grain", "g_min_sample")
    },
}
for _name, _renames in _TWINS.items():
    _sql = CTES[_name]
    for _old, _new in _renames.items():
        _sql = re.sub(rf"\b(FROM|JOIN) {_old}\b", rf"\1 {_new}", _sql)
    CTES[f"{_name}_valid"] = _sql

# ---- governance ----------------------------------------------------------------------------
from abx.operators import governance as _G  # noqa: E402


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


CTES["allowed_assets"] = "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join([_sql_str(r[0]), _sql_str(r[1]), _sql_str(r[2]), _sql_str(r[3]), "true" if r[4] else "false",
                     _sql_str(r[5])]) + ")"
    for r in _G.ALLOWED_ASSET_ROWS
) + ") AS t(asset_type, asset_name, grain, primary_keys, is_allowed_for_ai, description)"

CTES["qlog"] = """
SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS query_id, text AS sql_text FROM conversations"""

CTES["qrefs"] = f"""
SELECT query_id, sql_text,
       list_sort(list_distinct(list_transform(regexp_extract_all(sql_text, {_sql_str(_G.ASSET_PATTERN)}, 1),
                                              lambda x: lower(x)))) AS referenced_assets,
       lower(regexp_replace(sql_text, {_sql_str(_G.LEADING_TRAILING_WS)}, '', 'g')) AS s
FROM qlog"""

_KW_CASES = ", ".join(
    f"CASE WHEN regexp_matches(s, {_sql_str(_G.keyword_pattern(k))}) THEN 'blocked_keyword:{k}' END"
    for k in _G.BLOCKED_KEYWORDS
)

CTES["qaudit"] = f"""
SELECT query_id, referenced_assets, violations, len(violations) = 0 AS ok FROM (
  SELECT query_id, referenced_assets,
    list_concat(
      list_filter([CASE WHEN NOT (starts_with(s, 'select') OR starts_with(s, 'with')) THEN 'only_select_allowed' END,
                   CASE WHEN regexp_matches(s, {_sql_str(_G.SELECT_STAR_PATTERN)}) THEN 'select_star_blocked' END,
                   {_KW_CASES}], lambda v: v IS NOT NULL),
      list_transform(list_filter(referenced_assets, lambda a: NOT list_contains(al.allowed, a)),
                     lambda a: 'non_allowlisted_asset:' || a)) AS violations
  FROM qrefs,
       (SELECT list(lower(asset_name)) AS allowed FROM allowed_assets WHERE is_allowed_for_ai) al)"""

# ---- assignment helpers, feeds ---------------------------------------------------------------
CTES["av_bounds"] = """
SELECT experiment_id, variant_id, (cum - allocation_pct) / total AS lo,
       CASE WHEN rn = n THEN 1.0 ELSE cum / total END AS hi
FROM (SELECT experiment_id, variant_id, allocation_pct,
             row_number() OVER (PARTITION BY experiment_id ORDER BY variant_id) AS rn,
             count(*) OVER (PARTITION BY experiment_id) AS n,
             sum(allocation_pct) OVER (PARTITION BY experiment_id ORDER BY variant_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             sum(allocation_pct) OVER (PARTITION BY experiment_id) AS total
      FROM dim_variant WHERE allocation_pct > 0)"""

CTES["assigned_variants"] = """
SELECT u.experiment_id, u.unit_id, b.variant_id, CAST(floor(u.share * 10000) AS INTEGER) AS bucket
FROM (SELECT experiment_id, unit_id,
             CAST(CAST(('0x' || substr(md5(experiment_id || ':' || unit_id), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0
               AS share
      FROM canonical) u
JOIN av_bounds b ON u.experiment_id = b.experiment_id AND u.share >= b.lo AND u.share < b.hi"""

# ---- extensions ------------------------------------------------------------------------------
CTES["welch_arms"] = """
SELECT experiment_id, variant_id, count(*) AS n, avg(revenue) AS mean, var_samp(revenue) AS var
FROM unit_outcomes GROUP BY 1, 2"""

CTES["welch1"] = """
SELECT t.experiment_id, t.variant_id, c.n AS n_control, c.mean AS mean_control, c.var AS var_control,
       t.n AS n_treatment, t.mean AS mean_treatment, t.var AS var_treatment, t.mean - c.mean AS diff,
       t.var / CAST(t.n AS DOUBLE) AS a, c.var / CAST(c.n AS DOUBLE) AS b
FROM (SELECT * FROM welch_arms WHERE variant_id != 'control') t
JOIN (SELECT * FROM welch_arms WHERE variant_id = 'control') c ON t.experiment_id = c.experiment_id"""

# Student-t tail by numeric integration (independent of the continued fraction used in Spark):
# p = 1 - 2 / B(1/2, a) * int_0^W (1 - w^2)^(a - 1) dw,  a = df / 2,  W = |t| / sqrt(df + t^2),
# Simpson's rule with 4000 intervals on a smooth integrand.
_T_TAIL = """CASE WHEN t_stat IS NULL OR welch_df IS NULL OR welch_df <= 0 THEN NULL
  ELSE LEAST(GREATEST(1.0 - 2.0 * exp(lgamma(welch_df / 2.0 + 0.5) - lgamma(0.5) - lgamma(welch_df / 2.0))
    * (SELECT sum(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                  * pow(1.0 - pow(i * (abs(t_stat) / sqrt(welch_df + t_stat * t_stat)) / 4000.0, 2),
                        welch_df / 2.0 - 1.0))
       FROM range(0, 4001) r(i)) * (abs(t_stat) / sqrt(welch_df + t_stat * t_stat)) / 4000.0 / 3.0, 0.0), 1.0) END"""

CTES["welch"] = f"""
SELECT experiment_id, variant_id, n_control, mean_control, var_control, n_treatment, mean_treatment, var_treatment,
       diff, se, t_stat, welch_df, {_p_two_sided('t_stat', cap=True)} AS p_value_normal_approx,
       {_T_TAIL} AS p_value_t,
       diff - 1.96 * se AS ci_low, diff + 1.96 * se AS ci_high
FROM (SELECT *, diff / NULLIF(se, 0) AS t_stat,
             (a + b) * (a + b) / NULLIF(a * a / (n_treatment - 1) + b * b / (n_control - 1), 0) AS welch_df
      FROM (SELECT *, sqrt(a + b) AS se FROM welch1))"""

CTES["cuped_units"] = f"""
SELECT c.experiment_id, c.unit_id, c.assigned_variant_id AS variant_id,
       COALESCE(CAST(sum(CASE WHEN cv.occurred_at < c.assigned_at THEN CAST(cv.revenue AS DECIMAL(38, 10)) END)
                     AS DOUBLE), 0.0) AS x,
       COALESCE(CAST(sum(CASE WHEN cv.occurred_at >= c.assigned_at THEN CAST(cv.revenue AS DECIMAL(38, 10)) END)
                     AS DOUBLE), 0.0) AS y
FROM cohort c LEFT JOIN conv cv ON c.unit_id = cv.unit_id
     AND cv.occurred_at >= c.assigned_at - {CONVDAYS} AND cv.occurred_at < c.assigned_at + {CONVDAYS}
GROUP BY 1, 2, 3"""

CTES["cuped"] = """
SELECT u.experiment_id, u.variant_id, count(*) AS n_units, avg(u.x) AS mean_pre, avg(u.y) AS mean_post, t.theta,
       avg(u.y - COALESCE(t.theta, 0.0) * (u.x - t.mx)) AS mean_post_adjusted,
       var_samp(u.y) AS var_post, var_samp(u.y - COALESCE(t.theta, 0.0) * u.x) AS var_post_adjusted
FROM cuped_units u
JOIN (SELECT experiment_id, covar_samp(x, y) / NULLIF(var_samp(x), 0) AS theta, avg(x) AS mx
      FROM cuped_units GROUP BY 1) t ON u.experiment_id = t.experiment_id
GROUP BY u.experiment_id, u.variant_id, t.theta"""

CTES["bh"] = """
SELECT experiment_id, metric_id, variant_id, p_value, p_rank, n_tests,
       LEAST(min(p_value * n_tests / p_rank) OVER (PARTITION BY experiment_id ORDER BY p_rank DESC
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0) AS p_value_bh
FROM (SELECT experiment_id, metric_id, variant_id, p_value_two_sided AS p_value,
             row_number() OVER (PARTITION BY experiment_id ORDER BY p_value_two_sided, metric_id, variant_id) AS p_rank,
             count(*) OVER (PARTITION BY experiment_id) AS n_tests
      FROM results WHERE variant_id != 'control' AND p_value_two_sided IS NOT NULL)"""

CTES["daily_rates"] = """
SELECT experiment_id, date_day, 'exposure_rate' AS metric, exposure_rate AS rate FROM quality_daily_post
UNION ALL
SELECT experiment_id, date_day, 'variant_mismatch_rate', variant_mismatch_rate FROM quality_daily_post"""

CTES["anomalies"] = """
SELECT d.experiment_id, d.date_day, d.metric, d.rate, p.rate AS prev_rate, t.trailing_avg_rate,
       d.rate - p.rate AS day_over_day_change, d.rate - t.trailing_avg_rate AS change_vs_trailing,
       COALESCE(abs(d.rate - p.rate) > 0.1, false) OR COALESCE(abs(d.rate - t.trailing_avg_rate) > 0.1, false)
         AS is_anomaly
FROM daily_rates d
LEFT JOIN daily_rates p ON p.experiment_id = d.experiment_id AND p.metric = d.metric
                       AND p.date_day = d.date_day - INTERVAL 1 DAY
LEFT JOIN (SELECT a.experiment_id, a.metric, a.date_day, avg(b.rate) AS trailing_avg_rate
           FROM daily_rates a JOIN daily_rates b
             ON b.experiment_id = a.experiment_id AND b.metric = a.metric
            AND b.date_day < a.date_day AND b.date_day >= a.date_day - INTERVAL 7 DAY
           GROUP BY 1, 2, 3) t
  ON t.experiment_id = d.experiment_id AND t.metric = d.metric AND t.date_day = d.date_day"""

CTES["spine"] = """
SELECT c.experiment_id, c.unit_id, c.assigned_variant_id AS variant_id, m.metric_id, m.event_name, m.kind, m.anchor,
       m.window_days,
       CASE WHEN m.anchor = 'exposure' THEN c.first_exposure_at ELSE c.assigned_at END AS anchor_at,
       (CASE WHEN m.anchor = 'exposure' THEN c.first_exposure_at ELSE c.assigned_at END) IS NOT NULL AS is_eligible,
       CASE WHEN m.anchor = 'exposure' THEN c.first_exposure_at ELSE c.assigned_at END AS window_start_at,
       (CASE WHEN m.anchor = 'exposure' THEN c.first_exposure_at ELSE c.assigned_at END) + to_days(m.window_days)
         AS window_end_at
FROM cohort c
CROSS JOIN (VALUES ('conversion_7d', 'purchase', 7, 'exposure', 'binary'),
                   ('revenue_7d', 'purchase', 7, 'exposure', 'continuous'),
                   ('conversion_itt_7d', 'purchase', 7, 'assignment', 'binary'))
  AS m(metric_id, event_name, window_days, anchor, kind)"""

CTES["metric_outcomes"] = """
SELECT s.experiment_id, s.unit_id, s.variant_id, s.metric_id, s.kind, s.is_eligible,
       min(cv.occurred_at) IS NOT NULL AS did_convert, min(cv.occurred_at) AS converted_at,
       count(cv.occurred_at) AS events,
       COALESCE(CAST(sum(CAST(cv.revenue AS DECIMAL(38, 10))) AS DOUBLE), 0.0) AS value
FROM spine s LEFT JOIN conv cv
  ON s.unit_id = cv.unit_id AND s.event_name = cv.event_name
 AND cv.occurred_at >= s.anchor_at AND cv.occurred_at < s.anchor_at + to_days(s.window_days)
GROUP BY s.experiment_id, s.unit_id, s.variant_id, s.metric_id, s.kind, s.is_eligible"""

# ---- time to event, sessions, identity, rollups ---------------------------------------------------
CTES["times"] = """
SELECT experiment_id, unit_id, variant_id, is_event,
       CAST(floor((epoch_us(CASE WHEN is_event THEN next_at ELSE until END) - epoch_us(assigned_at)) / 3600000000.0)
            AS BIGINT) AS steps
FROM (SELECT c.experiment_id, c.unit_id, c.variant_id, c.assigned_at, u.until, min(v.occurred_at) AS next_at,
             COALESCE(min(v.occurred_at) <= u.until, false) AS is_event
      FROM canonical c CROSS JOIN (SELECT max(ts) AS until FROM events) u
      LEFT JOIN conv v ON v.unit_id = c.unit_id AND v.occurred_at >= c.assigned_at
      WHERE c.assigned_at <= u.until GROUP BY 1, 2, 3, 4, 5)"""

CTES["event_table"] = """
SELECT *, CAST(sum(events + censored) OVER (PARTITION BY experiment_id, variant_id ORDER BY steps DESC) AS BIGINT) AS at_risk
FROM (SELECT experiment_id, variant_id, steps, CAST(count_if(is_event) AS BIGINT) AS events,
             CAST(count_if(NOT is_event) AS BIGINT) AS censored FROM times GROUP BY 1, 2, 3)"""

CTES["km"] = """
SELECT experiment_id, variant_id, steps, at_risk, events, censored, survival,
       CASE WHEN NOT none_left THEN survival * sqrt(greenwood) END AS std_error, cumulative_hazard
FROM (SELECT *, product(1.0 - CAST(events AS DOUBLE) / at_risk) OVER w AS survival,
             sum(CAST(events AS DOUBLE) / at_risk) OVER w AS cumulative_hazard,
             sum(CASE WHEN at_risk > events THEN CAST(events AS DOUBLE) / (CAST(at_risk AS DOUBLE) * (at_risk - events))
                 ELSE 0.0 END) OVER w AS greenwood,
             bool_or(events = at_risk) OVER w AS none_left
      FROM event_table WINDOW w AS (PARTITION BY experiment_id, variant_id ORDER BY steps))"""

# At every time of either arm: units of an arm that are still observed then, counted directly.
CTES["logrank"] = """
SELECT experiment_id, variant_id, CAST(sum(e1) AS BIGINT) AS observed, sum(r1 * e / r) AS expected,
       sum(CASE WHEN r > 1 THEN r1 * (r - r1) * e * (r - e) / (r * r * (r - 1.0)) ELSE 0.0 END) AS variance,
       CAST(sum(e) AS DOUBLE) AS e_both
FROM (SELECT p.experiment_id, p.variant_id, p.steps,
             count_if(t.is_event AND t.steps = p.steps AND t.variant_id = p.variant_id) AS e1,
             CAST(count_if(t.is_event AND t.steps = p.steps) AS DOUBLE) AS e,
             CAST(count_if(t.variant_id = p.variant_id) AS DOUBLE) AS r1, CAST(count(*) AS DOUBLE) AS r
      FROM (SELECT DISTINCT a.experiment_id, a.variant_id, b.steps
            FROM (SELECT DISTINCT experiment_id, variant_id FROM times WHERE variant_id <> 'control') a
            JOIN times b ON b.experiment_id = a.experiment_id AND b.variant_id IN (a.variant_id, 'control')) p
      JOIN times t ON t.experiment_id = p.experiment_id AND t.variant_id IN (p.variant_id, 'control') AND t.steps >= p.steps
      GROUP BY 1, 2, 3)
WHERE experiment_id IN (SELECT experiment_id FROM times WHERE variant_id = 'control')
GROUP BY 1, 2"""

CTES["session_rows"] = """
SELECT unit_id, session_no, ts, event_type FROM (
  SELECT *, sum(is_new) OVER (PARTITION BY unit_id ORDER BY ts, event_id) AS session_no FROM (
    SELECT user_id AS unit_id, event_id, ts, event_type,
           CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS is_new
    FROM events))"""

CTES["sessions"] = """
SELECT unit_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS started_at, max(ts) AS ended_at,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_seconds, count(*) AS n_events,
       CAST(count_if(event_type = 'view') AS BIGINT) AS n_view, CAST(count_if(event_type = 'click') AS BIGINT) AS n_click,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchase
FROM session_rows GROUP BY 1, 2"""

CTES["session_metrics"] = f"""
SELECT experiment_id, variant_id, count(*) AS n_units, CAST(count_if(n > 0) AS BIGINT) AS active_units,
       CAST(sum(n) AS BIGINT) AS n_sessions, CAST(sum(n) AS DOUBLE) / count(*) AS sessions_per_unit,
       CAST(sum(e) AS DOUBLE) / count(*) AS events_per_unit, sum(d) / NULLIF(sum(n), 0) AS avg_duration_seconds
FROM (SELECT a.experiment_id, a.variant_id, a.unit_id, count(s.started_at) AS n, COALESCE(sum(s.n_events), 0) AS e,
             sum(s.duration_seconds) AS d
      FROM canonical a LEFT JOIN sessions s ON CAST(s.unit_id AS VARCHAR) = a.unit_id
       AND s.started_at >= a.assigned_at AND s.started_at < a.assigned_at + {CONVDAYS} GROUP BY 1, 2, 3)
GROUP BY 1, 2"""

# Every unit with all it reaches over devices that few units share. DuckDB's recursion needs its own WITH.
CTES["reached"] = """
WITH RECURSIVE own AS (
  SELECT DISTINCT unit_id, identifier FROM identity_links
  WHERE identifier IN (SELECT identifier FROM identity_links GROUP BY 1 HAVING count(DISTINCT unit_id) <= 10)),
walk AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS a, CAST(user_id AS VARCHAR) AS b FROM events
  UNION
  SELECT w.a, y.unit_id FROM walk w JOIN own x ON x.unit_id = w.b JOIN own y ON y.identifier = x.identifier)
SELECT a, b FROM walk"""

CTES["stitched"] = """
SELECT a AS unit_id, min(b) AS person_id, count(*) AS n_units FROM reached GROUP BY 1"""

CTES["stitched_assignments"] = """
SELECT experiment_id, person_id, unit_id, variant_id, assigned_at, n_units, n_variants, n_variants > 1 AS is_conflicted
FROM (SELECT c.experiment_id, i.person_id, c.unit_id, c.variant_id, c.assigned_at,
             count(*) OVER p AS n_units, (SELECT count(DISTINCT d.variant_id) FROM canonical d JOIN stitched j
               ON j.unit_id = d.unit_id WHERE d.experiment_id = c.experiment_id AND j.person_id = i.person_id) AS n_variants,
             row_number() OVER (PARTITION BY c.experiment_id, i.person_id
                                ORDER BY c.assigned_at NULLS LAST, c.variant_id, c.unit_id) AS rn
      FROM canonical c JOIN stitched i ON i.unit_id = c.unit_id
      WINDOW p AS (PARTITION BY c.experiment_id, i.person_id)) WHERE rn = 1"""

CTES["quality_rollup"] = f"""
SELECT experiment_id, date_day, assigned_variant_id, CAST(GROUPING_ID(experiment_id, date_day, assigned_variant_id) AS BIGINT)
         AS grouping_level, count(*) AS assigned_units,
  {_sum_if('has_any_exposure')} AS exposed_units, {_sum_if('has_valid_exposure')} AS valid_exposed_units,
  {_sum_if('is_variant_mismatch')} AS variant_mismatch_units,
  {_sum_if('has_multiple_variations_exposed')} AS multi_variation_units,
  {_sum_if('is_pre_assignment_exposure')} AS pre_assignment_units,
  {_sum_if('exposure_outside_window')} AS outside_window_units,
  {_rate(_sum_if('has_any_exposure'), 'count(*)')} AS exposure_rate,
  {_rate(_sum_if('has_valid_exposure'), 'count(*)')} AS valid_exposure_rate,
  {_rate(_sum_if('is_variant_mismatch'), _sum_if('has_any_exposure'))} AS mismatch_rate
FROM (SELECT *, CAST(assigned_at AS DATE) AS date_day FROM validation_any)
GROUP BY GROUPING SETS ((experiment_id, date_day, assigned_variant_id), (experiment_id, date_day),
                        (experiment_id, assigned_variant_id), (experiment_id), (date_day), ())"""

# ---- resampling, versions, attribute bags ---------------------------------------------------------
CTES["poisson_cuts"] = """
SELECT * FROM (SELECT round(65536 * sum(exp(-1) / factorial(CAST(k AS INTEGER))) OVER (ORDER BY k)) AS cut FROM range(0, 15) r(k)) WHERE cut < 65536"""

CTES["boot_weights"] = """
SELECT unit_id, b * 8 + i + 1 AS replicate,
       (SELECT count(*) FROM poisson_cuts WHERE cut <= CAST('0x' || substr(md5(unit_id || '::' || b), i * 4 + 1, 4) AS INTEGER)) AS w
FROM (SELECT DISTINCT unit_id FROM unit_outcomes), range(0, 25) x(b), range(0, 8) y(i)
UNION ALL SELECT DISTINCT unit_id, 0, 1 FROM unit_outcomes"""

CTES["boot_stats"] = """
SELECT experiment_id, variant_id, replicate, unnest(['mean', 'ratio']) AS statistic,
       unnest([v / NULLIF(n, 0), v / NULLIF(p, 0)]) AS stat
FROM (SELECT u.experiment_id, u.variant_id, w.replicate, CAST(sum(w.w) AS DOUBLE) AS n, CAST(sum(w.w * u.conversion_events) AS DOUBLE) AS p,
             CAST(sum(CAST(w.w AS DECIMAL(3, 0)) * CAST(u.revenue AS DECIMAL(28, 10))) AS DOUBLE) AS v
      FROM unit_outcomes u JOIN boot_weights w ON w.unit_id = u.unit_id GROUP BY 1, 2, 3)"""

CTES["boot"] = """
SELECT experiment_id, variant_id, statistic, max(CASE WHEN replicate = 0 THEN c END) AS control,
       max(CASE WHEN replicate = 0 THEN t END) AS treatment, max(CASE WHEN replicate = 0 THEN t - c END) AS diff,
       stddev_samp(t - c) FILTER (replicate > 0) AS std_error, quantile_cont(t - c, 0.025) FILTER (replicate > 0) AS ci_low,
       quantile_cont(t - c, 0.975) FILTER (replicate > 0) AS ci_high,
       count(CASE WHEN replicate > 0 THEN t - c END) AS n_replicates
FROM (SELECT a.experiment_id, a.variant_id, a.statistic, a.replicate, a.stat AS t, b.stat AS c
      FROM boot_stats a LEFT JOIN boot_stats b ON b.experiment_id = a.experiment_id AND b.replicate = a.replicate
       AND b.statistic = a.statistic AND b.variant_id = 'control' WHERE a.variant_id <> 'control')
GROUP BY 1, 2, 3"""

# Days of January 2024 that the two compared versions keep: the first until one day, the second from another on.
VERSION_UNTIL = "2024-01-20"
VERSION_FROM = "2024-01-06"


def _kept(rule: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id, unit_id
                               ORDER BY assigned_at NULLS LAST, variant_id NULLS LAST, assignment_source NULLS LAST) AS rn
  FROM raw_assignments WHERE {rule}) WHERE rn = 1"""


CTES["version_old"] = _kept(f"dt <= DATE '{VERSION_UNTIL}'")
CTES["version_new"] = _kept(f"dt >= DATE '{VERSION_FROM}'")
CTES["version_diff"] = """
SELECT COALESCE(o.experiment_id, n.experiment_id) AS experiment_id, COALESCE(o.unit_id, n.unit_id) AS unit_id,
       CASE WHEN o.unit_id IS NULL THEN 'added' WHEN n.unit_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       CAST(o.unit_id IS NOT NULL AS BIGINT) AS old_rows, CAST(n.unit_id IS NOT NULL AS BIGINT) AS new_rows
FROM version_old o FULL JOIN version_new n ON n.experiment_id = o.experiment_id AND n.unit_id = o.unit_id
WHERE (o.variant_id, o.assigned_at, o.assignment_source, o.dt) IS DISTINCT FROM (n.variant_id, n.assigned_at, n.assignment_source, n.dt)"""

CTES["attribute_profile"] = """
SELECT event_type, regexp_replace(fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path,
       CASE WHEN type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'integer' WHEN type = 'DOUBLE' THEN 'number' WHEN type = 'VARCHAR' THEN 'string'
            ELSE lower(type) END AS value_type, count(*) AS n_values,
       min(CASE WHEN type IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN CAST(value AS DOUBLE) END) AS min_number,
       max(CASE WHEN type IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN CAST(value AS DOUBLE) END) AS max_number
FROM (SELECT e.event_type, t.fullkey, t.type, t.value FROM events e, json_tree(CASE WHEN json_valid(e.props) THEN e.props END) t)
GROUP BY 1, 2, 3
UNION ALL
SELECT event_type, '$', CASE WHEN props IS NULL THEN 'missing' ELSE 'invalid' END, count(*), NULL, NULL
FROM events WHERE props IS NULL OR NOT json_valid(props) GROUP BY 1, 2, 3"""

