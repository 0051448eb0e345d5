"""Version differences by digest trees equal a full outer join; equal versions move no row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from abx.operators import versions as V

SCHEMA = "k string, j long, a string, b double"
OLD = [("x", 1, "p", 1.0), ("x", 2, None, 2.0), ("y", 1, "q", None), ("z", 1, "r", 0.5), (None, 1, "n", 1.0), ("d", 1, "s", 1.0), ("d", 1, "s", 1.0)]
NEW = [("x", 1, "p", 1.0), ("x", 2, "", 2.0), ("y", 1, None, None), ("w", 1, "r", 0.5), (None, 1, "n", 2.0), ("d", 1, "s", 1.0)]


def _diff(spark, old, new):
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    return {(r.k, r.j): (r.change, r.old_rows, r.new_rows) for r in V.version_diff(a, b, ["k", "j"]).collect()}


def test_added_removed_changed_null_keys_and_repeats(spark):
    assert _diff(spark, OLD, NEW) == {
        ("x", 2): ("changed", 1, 1), ("y", 1): ("changed", 1, 1), ("z", 1): ("removed", 1, 0), ("w", 1): ("added", 0, 1),
        (None, 1): ("changed", 1, 1), ("d", 1): ("changed", 2, 1),
    }


def test_nulls_do_not_trade_places(spark):
    assert _diff(spark, [("k", 1, "v", None)], [("k", 1, None, 1.0)]) == {("k", 1): ("changed", 1, 1)}
    assert _diff(spark, [("k", None, "v", 1.0)], [(None, 1, "v", 1.0)]) == {("k", None): ("removed", 1, 0), (None, 1): ("added", 0, 1)}


def test_empty_tables(spark):
    assert _diff(spark, [], []) == {}
    assert _diff(spark, [], NEW[:2]) == {("x", 1): ("added", 0, 1), ("x", 2): ("added", 0, 1)}
    with pytest.raises(ValueError):
        V.version_diff(spark.createDataFrame(OLD, SCHEMA), spark.range(1), ["k"])


def test_equals_a_full_outer_join(spark):
    old = spark.range(30_000).selectExpr("id AS k", "id % 13 AS v", "CAST(id AS STRING) AS s")
    new = spark.range(40, 30_070).selectExpr("id AS k", "CASE WHEN id % 997 = 5 THEN -1 ELSE id % 13 END AS v", "CAST(id AS STRING) AS s")
    got = {(r.k, r.change) for r in V.version_diff(old, new.repartition(9), ["k"]).collect()}
    a, b = old.alias("a"), new.alias("b")
    j = a.join(b, F.expr("a.k = b.k"), "full").filter("NOT (a.v <=> b.v AND a.s <=> b.s)")
    want = j.select(F.expr("coalesce(a.k, b.k)"), F.expr("CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END"))
    assert got == {tuple(r) for r in want.collect()} and len(got) > 100


def test_stored_trees_and_equal_versions_move_no_row(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.range(5000).selectExpr("id AS k", "id * 3 AS v").write.parquet(path)
    t = spark.read.parquet(path)
    V.digest_tree(t, ["k"]).write.parquet(str(tmp_path / "tree"))
    tree = spark.read.parquet(str(tmp_path / "tree"))
    assert tree.groupBy("level").agg(F.sum("n_rows")).filter("`sum(n_rows)` = 5000").count() == len(V.BITS)
    assert V.differing_leaves(tree, V.digest_tree(t.repartition(5), ["k"])).count() == 0
    changed = t.withColumn("v", F.when(F.col("k") == 7, -1).otherwise(F.col("v")))
    assert V.differing_leaves(tree, V.digest_tree(changed, ["k"])).count() == 1
    same = V.version_diff(t, spark.read.parquet(path), ["k"], tree, tree)
    assert same.collect() == []
    # No leaf differs, so the running plan drops both tables: no shuffle of rows is left in it.
    assert "AQEShuffleRead" not in same._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
