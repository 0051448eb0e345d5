"""Keyed stream state: shuffled arrival equals batch, restarts double nothing, late rows and expiry are as stated."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from abx.streaming import first_exposure as S
from conftest import EXPOSURE_SCHEMA, ts


def _row(i, unit, t, variant="control"):
    return (str(i), "e", unit, variant, t, None)


def _add(spark, feed, rows):
    spark.createDataFrame(rows, EXPOSURE_SCHEMA).coalesce(1).write.mode("append").parquet(feed)


def _run(spark, root, feed, **kw):
    stream = spark.readStream.schema(EXPOSURE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    q = S.start_corrections(stream, f"{root}/out", f"{root}/offsets", **kw)
    q.awaitTermination(300)
    return q


def _rows(spark, root):
    rows = spark.read.parquet(f"{root}/out").collect()
    return sorted(((r.unit_id or "", r.revision, r.first_exposed_at, r.was_first_at) for r in rows), key=lambda r: r[:2])


def test_corrections_and_restart(spark, tmp_path):
    root, feed = str(tmp_path), str(tmp_path / "feed")
    _add(spark, feed, [_row(1, "a", ts(500)), _row(2, "a", ts(300)), _row(3, None, ts(5)), _row(4, "b", None)])
    _run(spark, root, feed)
    assert _rows(spark, root) == [("", 1, ts(5), None), ("a", 1, ts(300), None)]
    _add(spark, feed, [_row(5, "a", ts(900)), _row(6, "c", ts(1))])
    _run(spark, root, feed)
    _add(spark, feed, [_row(7, "a", ts(299, micros=7)), _row(8, "c", ts(1))])
    _run(spark, root, feed)
    assert _rows(spark, root) == [("", 1, ts(5), None), ("a", 1, ts(300), None), ("a", 2, ts(299, micros=7), ts(300)), ("c", 1, ts(1), None)]
    before = _rows(spark, root)
    _run(spark, root, feed)  # nothing new
    assert _rows(spark, root) == before
    got = {r.unit_id: (r.first_exposed_at, r.n_corrections) for r in S.settled(spark, f"{root}/out").collect()}
    assert got == {None: (ts(5), 1), "a": (ts(299, micros=7), 2), "c": (ts(1), 1)}


def test_expiry_and_rows_later_than_the_lateness(spark, tmp_path):
    root, feed = str(tmp_path), str(tmp_path / "feed")
    kw = dict(lateness="1 day", keep=timedelta(days=2))
    for rows in ([_row(1, "a", ts(days=1))], [_row(2, "b", ts(days=10))], [_row(3, "b", ts(days=10, seconds=9))]):
        _add(spark, feed, rows)
        _run(spark, root, feed, **kw)
    # The watermark stands at day 9: earlier rows don't reach the state; the expired key opens again with a later time.
    _add(spark, feed, [_row(4, "a", ts(days=0)), _row(5, "a", ts(days=9.5))])
    _run(spark, root, feed, **kw)
    got = {r.unit_id: r.first_exposed_at for r in S.settled(spark, f"{root}/out").collect()}
    assert got == {"a": ts(days=1), "b": ts(days=10)}


def test_earliest_in_task_keeps_null_keys():
    rows = pd.DataFrame({"experiment_id": ["e"] * 4, "unit_id": ["a", None, "a", None], "variant_id": ["c"] * 4, "us": [3, 9, 1, 2**53 + 1]})
    (got,) = S.earliest_in_task(iter([rows]))
    assert sorted(got["us"]) == [1, 9] and len(got) == 2


def test_hot_key_in_shuffled_order_equals_batch(spark):
    n = 4000
    df = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS event_id", "'e' AS experiment_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 90 AS STRING) END AS unit_id",
        "'control' AS variant_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 7919 % 100000) AS exposed_at")
    got = {(r.unit_id, r.first_exposed_at) for r in S.replay(df, 3).collect()}
    assert got == {(r[0], r[1]) for r in df.groupBy("unit_id").agg(F.min("exposed_at")).collect()}


def test_a_state_row_holds_the_keys_of_a_page(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "PAGES", 3)
    root, feed = str(tmp_path), str(tmp_path / "feed")
    units = [f"u{i}" for i in range(40)] + [None]
    _add(spark, feed, [_row(i, u, ts(500 + i, micros=i)) for i, u in enumerate(units)])
    _run(spark, root, feed)
    _add(spark, feed, [_row(i, u, ts(400 + i if i % 2 else 900)) for i, u in enumerate(units)] + [_row(99, "", ts(1)), _row(98, None, ts(2), None)])
    _run(spark, root, feed)
    got = sorted((r.unit_id or "", r.variant_id or "", r.revision, r.first_exposed_at, r.was_first_at) for r in spark.read.parquet(f"{root}/out").collect())
    want = [(u or "", "control", 1, ts(500 + i, micros=i), None) for i, u in enumerate(units)]
    want += [(u or "", "control", 2, ts(400 + i), ts(500 + i, micros=i)) for i, u in enumerate(units) if i % 2]
    assert got == sorted([*want, ("", "control", 1, ts(1), None), ("", "", 1, ts(2), None)], key=lambda r: (r[:3], r[3]))
    assert spark.read.format("statestore").load(f"{root}/offsets").count() == 3


def test_keys_of_a_page_expire_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "PAGES", 1)
    root, feed = str(tmp_path), str(tmp_path / "feed")
    kw = dict(lateness="1 day", keep=timedelta(days=2))
    for rows in ([_row(1, "a", ts(days=1)), _row(2, "c", ts(days=8))], [_row(3, "b", ts(days=10))], [_row(4, "b", ts(days=10, seconds=9))]):
        _add(spark, feed, rows)
        _run(spark, root, feed, **kw)
    # The watermark stands at day 9: "a" has expired and opens again, "c" is kept until day 10.
    _add(spark, feed, [_row(5, "a", ts(days=9.5)), _row(6, "c", ts(days=9.6))])
    _run(spark, root, feed, **kw)
    assert [r[:3] for r in _rows(spark, root)] == [("a", 1, ts(days=1)), ("a", 1, ts(days=9.5)), ("b", 1, ts(days=10)), ("c", 1, ts(days=8))]


def test_replay_reads_a_file_a_core_in_every_batch(spark):
    df = spark.range(500).selectExpr("CAST(id AS STRING) AS event_id", "'e' AS experiment_id", "CAST(id % 90 AS STRING) AS unit_id", "'c' AS variant_id", "timestamp_ntz'2024-01-01' AS exposed_at")
    seen = []
    with pytest.MonkeyPatch.context() as m:
        start = S.start_corrections
        m.setattr(S, "start_corrections", lambda feed, *a: seen.append(len(feed.sparkSession.read.parquet(a[0].replace("/out", "/feed")).inputFiles())) or start(feed, *a))
        assert S.replay(df, 3).count() == 90
    assert seen == [3 * spark.sparkContext.defaultParallelism]
