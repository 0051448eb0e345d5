from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import ann as A


def brute(rows, asked, k=20):
    """Exact search over usable rows, ties to the smaller id."""
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.asarray(v, np.float32).astype(float)
    dim = max(map(len, good.values()))
    ids = np.asarray(sorted(good))
    m = np.stack([np.pad(good[i], (0, dim - len(good[i]))) for i in ids])
    out = {}
    for i in ids[[asked(i) for i in ids]]:
        s = np.einsum("j,ij->i", m[ids == i][0], m)
        order = [x for x in np.lexsort((ids, -s)) if ids[x] != i][:k]
        out[int(i)] = [(int(ids[x]), s[x]) for x in order]
    return out


def recall(got, want):
    by: dict = {}
    for r in got:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(by.get(q, set()) & {i for i, _ in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_and_scores_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    got = A.search(df, is_query=F.col("vec_id") % 20 == 0).collect()
    assert recall(got, want) >= 0.93
    vectors = {i: np.asarray(v, np.float32).astype(float) for i, v in rows}
    for q in want:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and q not in {r.vec_id for r in own}
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        for r in own:
            assert r.score == pytest.approx(vectors[q] @ vectors[r.vec_id], abs=1e-12)


def test_all_probes_are_exact(spark):
    """With every bucket probed the search is exact, for any norms, copies, ties and broken rows."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) * rng.uniform(0.1, 5)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 2.0]) for i in range(60)]
    rows += [(400, None), (401, [0.0] * 6), (402, [1.0, None]), (403, [float("nan"), 1.0]), (404, [float("inf")]), (405, []), (None, [1.0]), (406, [3.0, 1.0]), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    want = brute(rows, lambda i: i % 3 == 0)
    got = A.search(df, is_query=F.col("vec_id") % 3 == 0, tables=1, probes=10_000).collect()
    by: dict = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in by[q]] == [i for i, _ in near]
        assert [s for _, s in by[q]] == pytest.approx([s for _, s in near])


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    ask = F.col("vec_id") % 20 == 0
    want = sorted(map(tuple, A.search(df, is_query=ask).collect()))
    monkeypatch.setattr(A, "BLOCK", 7)
    assert sorted(map(tuple, A.search(df, is_query=ask).collect())) == want


def test_small_tables(spark):
    """Every query gets all candidates, or as many as it asks for; what the pilot covers whole meets its target."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for n in (10, 21, 40, 60):
        got = A.search(df.filter(F.col("vec_id") < n)).collect()
        want = brute(rows[:n], lambda i: True)
        assert recall(got, want) >= (A.TARGET if n > 21 else 1) and len(got) == n * min(20, n - 1)


def _pairs(x, hashes, tables, probes, asked):
    """Share of all query-vector pairs that the buckets bring together."""
    h = A.CrossPolytope(x.shape[1], tables, A.AXES, hashes)
    norm = np.linalg.norm(x, axis=1)
    top = norm.max() * A.RANGE ** -np.floor(np.log(norm.max() / norm) / np.log(A.RANGE))
    total = 0
    for t in range(tables):
        held = np.bincount(h.buckets(x, top, t), minlength=h.signed**hashes)
        total += sum(int(held[h.probes(x[asked[a : a + 100]], t, probes)].sum()) for a in range(0, len(asked), 100))
    return total / (len(asked) * len(x))


def _clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 50, 64))[rng.integers(0, n // 50, n)] + 0.3 * rng.normal(size=(n, 64))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_clustered_vectors_meet_few(spark, monkeypatch):
    x = _clustered(50_000).astype(np.float32)
    used, measured = [], A._measured
    monkeypatch.setattr(A, "_measured", lambda *a: used.append(measured(*a)) or used[-1])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = A.search(df, is_query=F.col("vec_id") % 100 == 0).collect()
    asked = np.arange(0, len(x), 100)
    s = x[asked].astype(float) @ x.T.astype(float)
    s[np.arange(len(asked)), asked] = -np.inf
    want = {int(q): [(int(i), 0) for i in near] for q, near in zip(asked, np.argpartition(-s, 20, axis=1)[:, :20], strict=True)}
    assert recall(got, want) >= 0.9 and len(got) == 20 * len(want)
    assert _pairs(x.astype(float), *used[0], asked) <= 0.05


@pytest.mark.parametrize("n", [5_000, 50_000, 200_000])
def test_pairs_by_size(n):
    """Settings measured on clustered vectors bring a small share of the pairs together, the smaller the larger the table."""
    x = _clustered(n)
    pilot, asked = np.arange(A.PILOT) * (n // A.PILOT), np.arange(0, n, n // 500)
    s = x[pilot] @ x.T
    s[np.arange(len(pilot)), pilot] = -np.inf
    near = np.argpartition(-s, 20, axis=1)[:, :20].ravel()
    found = A.settings(x[pilot], x[near], np.full(len(near), 1 + 1e-9), np.repeat(np.arange(len(pilot)), 20), n)
    assert _pairs(x, *found, asked) <= {5_000: 0.1, 50_000: 0.02, 200_000: 0.01}[n]


def test_probes_are_the_best_buckets():
    rng = np.random.default_rng(3)
    h = A.CrossPolytope(6, 1, 4, 2)
    x = rng.normal(size=(9, 6))
    every = h.probes(x, 0, h.signed**2)
    assert all(sorted(r) == list(range(h.signed**2)) for r in every)
    for p in (1, 3, 20):
        assert (h.probes(x, 0, p) == every[:, :p]).all()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (h.buckets(unit, np.ones(9), 0) == every[:, 0]).all()


def test_many_equal_scores_and_broken_rows_through_the_hashes(spark):
    """Copies, and vectors that differ only across the query, score alike: ties go to the smaller id."""
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 2 else [1.0, float(i), 0.0, 0.0]) for i in range(80)]
    rows += [(500, None), (501, [0.0] * 4), (502, [1.0, None]), (503, [float("inf")] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = A.search(df, is_query=F.col("vec_id") == 1, tables=3, probes=10_000, hashes=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 1.0) for i in [0, *range(2, 21)]]


@pytest.mark.parametrize("norms", ["one long", "lognormal"])
def test_recall_with_skewed_norms(spark, norms):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.where(np.arange(len(x)) == 7, 100, 1)[:, None] if norms == "one long" else rng.lognormal(0, 0.25, len(x))[:, None]
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got = A.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), is_query=F.col("vec_id") % 100 == 0).collect()
    want = brute(rows, lambda i: i % 100 == 0)
    assert recall(got, want) >= 0.9 and len(got) == 20 * len(want)


def test_short_queries_meet_all_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(30)]
    got = A.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tables=1, probes=1).collect()
    assert len(got) == 20 * 30 and recall(got, brute(rows, lambda i: True)) == 1


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in A.search(df, is_query=F.col("vec_id") == 0).collect()] == [(0, 1, 1, 4.0)]
    assert A.search(df.filter(F.lit(False))).count() == 0
    assert A.search(df, is_query=F.lit(False)).count() == 0
