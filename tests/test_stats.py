"""Column-expression statistics against closed forms and numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.functions import stats
from abx.operators import extensions as X
from abx.operators import guardrails as G


def test_normal_tail_against_erfc(spark):
    zs = [0.0, 0.1, 0.5, 1.0, 1.644854, 1.959964, 2.5, 3.0, 4.0, -1.3]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r.p for r in df.select(stats.normal_two_sided_p(F.col("z")).alias("p")).collect()]
    for z, p in zip(zs, got):
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-6)
    (r,) = spark.createDataFrame([(None,)], "z double").select(stats.normal_two_sided_p(F.col("z")).alias("p")).collect()
    assert r.p is None


@pytest.mark.parametrize(
    "x,df,p",
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05),
     (6.634897, 1, 0.01), (0.0, 2, 1.0), (2.0, 2, math.exp(-1.0))],
)
def test_chi2_tail(spark, x, df, p):
    (r,) = spark.createDataFrame([(x, df)], "x double, df int").select(
        stats.chi2_upper_tail(F.col("x"), F.col("df")).alias("p")).collect()
    assert r.p == pytest.approx(p, abs=2e-6)


def _variants(spark, rows):
    return spark.createDataFrame(rows, "experiment_id string, variant_id string, allocation_pct double")


def _units(spark, counts):
    rows = []
    for exp, var, n in counts:
        rows += [(exp, f"{var}-{i}", var) for i in range(n)]
    return spark.createDataFrame(rows, "experiment_id string, unit_id string, variant_id string")


def test_srm_cases(spark):
    v = _variants(spark, [(e, a, 50.0) for e in ("even", "biased", "empty") for a in ("control", "treatment")]
                  + [("three", a, 100 / 3) for a in ("a", "b", "c")])
    u = _units(spark, [("even", "control", 500), ("even", "treatment", 500), ("biased", "control", 600),
                       ("biased", "treatment", 400), ("empty", "control", 50), ("three", "a", 100),
                       ("three", "b", 100), ("three", "c", 160)])
    got = {r.experiment_id: r for r in G.guard_srm(u, v).collect()}
    assert got["even"].srm_passed is True and got["even"].chi_square == 0.0
    assert got["biased"].srm_passed is False and got["biased"].chi_square == pytest.approx(40.0)
    assert got["empty"].n_arms == 2 and got["empty"].srm_passed is False
    t = got["three"]
    assert t.chi_square_df == 2 and t.chi_square == pytest.approx(20.0)
    assert t.chi_square_p_value == pytest.approx(math.exp(-10.0), rel=1e-6)


def test_benjamini_hochberg(spark):
    ps = [0.01, 0.04, 0.03, 0.20]
    rows = [("x", "m", f"v{i}", p) for i, p in enumerate(ps)] + [("x", "m", "control", 1.0)]
    df = spark.createDataFrame(rows, "experiment_id string, metric_id string, variant_id string, p_value_two_sided double")
    got = {r.variant_id: r.p_value_bh for r in X.p_adjusted(df).collect()}
    order = np.argsort(ps)
    m = len(ps)
    adj = np.minimum.accumulate((np.array(ps)[order] * m / np.arange(1, m + 1))[::-1])[::-1]
    expect = {f"v{order[i]}": min(adj[i], 1.0) for i in range(m)}
    for k, v in expect.items():
        assert got[k] == pytest.approx(v)


def test_welch_and_cuped_against_numpy(spark):
    rng = np.random.default_rng(3)
    xs = {v: rng.gamma(2.0, 10.0, size=200) for v in ("control", "treatment")}
    ys = {v: 0.6 * xs[v] + rng.normal(5 if v == "treatment" else 0, 3, size=200) for v in xs}
    rows = [("e", f"{v}{i}", v, float(xs[v][i]), float(ys[v][i])) for v in xs for i in range(200)]
    units = spark.createDataFrame(rows, "experiment_id string, unit_id string, variant_id string, pre_revenue double, revenue double")
    (w,) = X.metric_mean_welch(units).collect()
    yc, yt = ys["control"], ys["treatment"]
    a, b = yt.var(ddof=1) / 200, yc.var(ddof=1) / 200
    assert w.diff == pytest.approx(yt.mean() - yc.mean())
    assert w.se == pytest.approx(math.sqrt(a + b))
    assert w.welch_df == pytest.approx((a + b) ** 2 / (a * a / 199 + b * b / 199))
    cu = {r.variant_id: r for r in X.cuped(units).collect()}
    allx = np.concatenate([xs["control"], xs["treatment"]])
    ally = np.concatenate([ys["control"], ys["treatment"]])
    theta = np.cov(allx, ally, ddof=1)[0, 1] / allx.var(ddof=1)
    for v in xs:
        adj = ys[v] - theta * (xs[v] - allx.mean())
        assert cu[v].theta == pytest.approx(theta)
        assert cu[v].mean_post_adjusted == pytest.approx(adj.mean())
        assert cu[v].var_post_adjusted == pytest.approx(adj.var(ddof=1))
        assert cu[v].var_post_adjusted < cu[v].var_post


@pytest.mark.parametrize(
    "t,df,p",
    [(2.0, 10.0, 0.0733880), (2.228139, 10.0, 0.05), (1.0, 1.0, 0.5), (12.706205, 1.0, 0.05), (2.575829, 1e7, 0.01),
     (0.0, 3.0, 1.0), (-3.5, 150.0, 0.000612851788)],
)
def test_student_t_tail(spark, t, df, p):
    (r,) = spark.createDataFrame([(t, df)], "t double, df double").select(
        stats.student_t_two_sided_p(F.col("t"), F.col("df")).alias("p")).collect()
    assert r.p == pytest.approx(p, rel=2e-4, abs=1e-7)


def plain_t_tail(t, df):
    """Two-sided tail by fine trapezoids of the bare density, scaled by its own integral."""
    far = 60.0 if df >= 100 else 5e4
    x = np.concatenate([np.linspace(0, 10, 400_001), np.geomspace(10, far, 400_001)[1:], [abs(t)]])
    x.sort()
    f = np.exp(-(df + 1) / 2 * np.log1p(x * x / df))
    area = np.concatenate([[0.0], np.cumsum((f[1:] + f[:-1]) / 2 * np.diff(x))])
    return 1 - area[np.searchsorted(x, abs(t))] / area[-1]


def test_student_t_tail_for_any_df(spark):
    pairs = [(t, df) for t in (0.1, 1.0, 1.96, 4.0) for df in (10.0, 1e3, 1e5, 1e9, 1e11)]
    got = spark.createDataFrame(pairs, "t double, df double").select("t", "df", stats.student_t_two_sided_p("t", "df").alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(plain_t_tail(r.t, r.df), abs=1e-7), (r.t, r.df)


def test_log_gamma(spark):
    xs = [0.5, 1.0, 2.5, 10.0, 123.4, 5e5]
    got = [r.g for r in spark.createDataFrame([(x,) for x in xs], "x double").select(
        stats.log_gamma(F.col("x")).alias("g")).collect()]
    for x, g in zip(xs, got):
        assert g == pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-12)


def test_exact_normal_tail_against_erfc(spark):
    zs = [0.0, 0.3, 1.0, 1.959964, 2.5, 4.0, 6.0, 9.0, -3.3]
    got = [r.p for r in spark.createDataFrame([(z,) for z in zs], "z double").select(
        stats.normal_two_sided_p_exact(F.col("z")).alias("p")).collect()]
    for z, p in zip(zs, got):
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-12, abs=1e-300)
