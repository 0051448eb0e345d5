"""Physical-plan shape: pushdown, pruning, partial top-1, exchange counts."""

from __future__ import annotations

import re

from abx.plans.experiment import ExperimentDAG

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_scan_is_pruned_and_filtered(spark):
    d = ExperimentDAG(spark, SF)
    p = _plan(d.canonical)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in p
    # only the needed columns reach the scan (no value/event_id)
    rs = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "value" not in rs and "event_id" not in rs


def test_canonical_has_partial_window_group_limit(spark):
    d = ExperimentDAG(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(d.canonical)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_validation_exchange_count(spark):
    d = ExperimentDAG(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(d.validation)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange per input (assignments, exposures) for their top-1 windows, one to bring deduped
    # exposures to the unit key; the aggregation then reuses the join's partitioning
    n = p.count("Exchange hashpartitioning")
    assert n <= 3, p
