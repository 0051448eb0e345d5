from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from abx.llm import mixing as M


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Give shares by weight, freeze those above their cap, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        above = {s for s in free if rest * w[s] / total > cap * sizes[s]}
        if not above:
            goal.update({s: rest * w[s] / total for s in free})
            break
        goal.update({s: cap * sizes[s] for s in above})
        rest -= sum(cap * sizes[s] for s in above)
        free -= above
    return goal


def docs(spark, n=400, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["b", "a", None, "ö", "z", "b", "b", "b"])
        rows.append((i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 30, 200]))), source, "x"))
    rows += [(None, "a b c", "a", "y"), (7, None, "z", "y"), (3, "a b", "a", "y"), (3, "a b", "a", "y"), (999, "long " * 50_000, "b", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_against_resharing(spark):
    for sizes in ({"a": 10, "b": 100, "c": 1000, None: 5}, {"a": 1000, "b": 1, "c": 1}, {"x": 7}, {"a": 0, "b": 0}, {"é": 3, "z": 50, "Z": 4}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in M.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix_against_sql(spark):
    df = docs(spark)
    got = M.mix(df).collect()
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [tuple(r) for r in df.select("doc_id", "text", "source").collect()])
    want = con.sql(M.ORACLE).fetchall()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    assert len(got) == df.count()
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and a[4:] == b[4:] and a[3] == pytest.approx(b[3])


def test_copies_and_words(spark):
    df = docs(spark).filter("size = 'x'")
    rows = M.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    taken, goal, largest = Counter(), {}, Counter()
    for r in rows:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        goal[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in goal.items():
        assert abs(taken[s] - t) <= largest[s]


def test_inclusion_follows_probability(spark):
    """Over many seeds each document is taken about as often as its inclusion probability says."""
    df = docs(spark, 120, 2).filter("doc_id < 900 AND source = 'b' AND text IS NOT NULL AND length(text) > 50").select("doc_id", "text", "source")
    second = df.withColumn("source", F.lit("c")).withColumn("doc_id", F.col("doc_id") + 1000)
    both = df.union(second).repartition(2).cache()
    hits, want = Counter(), {}
    for seed in range(12):
        rows, planned = M.plan(both, "doc_id", "text", "source", (5, 1), 1.0, 2, f"s{seed}")
        out = M._with_plan(rows, planned, ["source", "class"])
        n = M._copies(F.col("whole"), F.col("p"), F.col("u"), F.col("size"), F.col("id_text"))
        for r in out.select("source", "size", (F.col("whole") + F.col("p")).alias("e"), n.alias("n")).collect():
            hits[r.source] += r.n * r.size
            want[r.source] = want.get(r.source, 0) + r.e * r.size
    for s in want:
        assert hits[s] == pytest.approx(want[s], rel=0.1)


def test_resample_agrees_and_keeps_columns(spark):
    df = docs(spark)
    out = M.resample(df)
    assert out.columns == df.columns
    got = Counter(r.doc_id for r in out.collect())
    want: Counter = Counter()
    for r in M.mix(df).collect():
        want[r.doc_id] += r.copies
    assert got == +want
    assert got == Counter(r.doc_id for r in M.resample(df.repartition(3)).collect())


def test_empty_table(spark):
    df = docs(spark, 5).filter(F.lit(False))
    assert M.mix(df).count() == 0 and M.resample(df).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in M.mix(blank).collect()] == [0, 0]
