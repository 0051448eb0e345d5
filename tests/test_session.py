"""Checkpoint folder rule and lineage cuts."""

from __future__ import annotations

import pytest

from abx.session import cut_lineage, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d
    assert ensure_checkpoint_dir(spark) == d  # stable: never replaced once set


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_cut_lineage_is_a_reliable_checkpoint(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice").filter("id % 3 = 0")
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().analyzed().toString()
    assert "Filter" not in plan  # upstream operators are gone from the lineage
    assert sorted(r.id for r in cut.collect()) == list(range(0, 100, 3))
