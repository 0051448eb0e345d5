"""Earliest exposure of each key, kept in a keyed state store while exposures arrive late and in any order.

Each micro-batch reduces its rows to the earliest of a key within a task before anything moves, so a key that holds most
rows brings a handful to its state. The state is one time, one revision and one expiry a key. Keys are kept by PAGES pages of
a hash: a state row holds the keys of a page, so Python is called once for a page and not for every key, while pages stay
small (some hundred keys each, of some millions). What comes out are corrections: a row whenever the earliest time of a key
becomes known or earlier, never one for exposures that change nothing.

``lateness`` is how far exposures may trail the latest one seen. State is dropped once the watermark has passed the key's
earliest time by ``keep``; an exposure after that opens the key again with a later time, which ``settled`` (the earliest of
a key's corrections) takes no notice of. Exposures that trail by more than ``lateness`` don't reach the state: the batch
job of corrected days (``abx.plans.backfill``) is there for them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from abx.functions.time import epoch_micros
from abx.session import ensure_checkpoint_dir

KEY = ("experiment_id", "unit_id", "variant_id")
LATENESS = "7 days"
KEEP = timedelta(days=14)
# A stream's checkpoint holds for the number of pages it was begun with.
PAGES = 1 << 13
_ROWS = "experiment_id string, unit_id string, variant_id string, us long"
_PAGE = (
    "experiment_id array<string>, unit_id array<string>, variant_id array<string>, "
    "first_us array<long>, revision array<long>, until_ms array<long>"
)
_OUT = (
    "experiment_id string, unit_id string, variant_id string, first_exposed_at timestamp_ntz, "
    "was_first_at timestamp_ntz, revision long"
)


def earliest_in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every batch of rows the earliest of each key; null keys count as values."""
    for rows in batches:
        yield rows.groupby(list(KEY), dropna=False, as_index=False, sort=False)["us"].min()


def _earliest(parts: Iterator[pd.DataFrame]) -> dict[tuple, int]:
    """Earliest time of each key; a missing part of a key is None."""
    out: dict[tuple, int] = {}
    for p in parts:
        keys = zip(*([k if isinstance(k, str) else None for k in p[c].tolist()] for c in KEY), strict=True)
        for k, us in zip(keys, p["us"].tolist(), strict=True):
            out[k] = min(us, out.get(k, us))
    return out


def _times(us: list[int | None]) -> pd.Series:
    return pd.Series(np.array([pd.NaT.value if u is None else u for u in us]).view("datetime64[us]"))


def corrections(exposures: DataFrame, lateness: str = LATENESS, keep: timedelta = KEEP) -> DataFrame:
    """Stream of ``experiment_id, unit_id, variant_id, first_exposed_at, was_first_at`` (null at first) and ``revision`` (from
    1) for a stream of exposures. Rows without a time are left out; null keys are keys."""
    keep_ms = int(keep.total_seconds() * 1000)

    def step(page, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        lows = _earliest(parts)
        kept = list(zip(*state.get, strict=True)) if state.exists else []
        # A key's state ends once the watermark has passed its expiry, unless exposures of it arrive just now.
        held = {row[:3]: row[3:] for row in kept if row[5] >= now or row[:3] in lows}
        new = []
        for key, low in lows.items():
            was, revision, _ = held.get(key, (None, 0, 0))
            if was is None or low < was:
                new.append((*key, low, was, revision + 1))
                was, revision = low, revision + 1
            held[key] = (was, revision, max(was // 1000 + keep_ms, now + 1))
        if held:
            state.update(tuple(map(list, zip(*(k + v for k, v in held.items()), strict=True))))
            state.setTimeoutTimestamp(max(min(until for *_, until in held.values()), now + 1))
        else:
            state.remove()
        if new:
            *keys, low, was, revision = map(list, zip(*new, strict=True))
            out = {c: pd.Series(k, dtype=object) for c, k in zip(KEY, keys, strict=True)}
            yield pd.DataFrame({**out, "first_exposed_at": _times(low), "was_first_at": _times(was), "revision": revision})

    rows = exposures.select(*KEY, epoch_micros("exposed_at").alias("us")).filter(F.col("us").isNotNull())
    rows = rows.mapInPandas(earliest_in_task, _ROWS)
    # A watermark needs a time with a zone; the count of microseconds is the same in every session zone.
    timed = rows.withColumn("at", F.timestamp_micros("us")).withWatermark("at", lateness)
    timed = timed.withColumn("page", F.pmod(F.xxhash64(*KEY), F.lit(PAGES)))
    return timed.groupBy("page").applyInPandasWithState(step, _OUT, _PAGE, "update", GroupStateTimeout.EventTimeTimeout)


def start_corrections(
    exposures: DataFrame,
    out: str,
    checkpoint_location: str,
    lateness: str = LATENESS,
    keep: timedelta = KEEP,
) -> StreamingQuery:
    """Run over all that has arrived and end; the folder ``out`` holds one subfolder of corrections a micro-batch, which a
    batch that is run again replaces, so a restart doubles nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    writer = corrections(exposures, lateness, keep).writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()


def settled(spark: SparkSession, out: str) -> DataFrame:
    """The earliest time of every key from all corrections written so far, with how many there were."""
    rows = spark.read.parquet(out)
    return rows.groupBy(*KEY).agg(F.min("first_exposed_at").alias("first_exposed_at"), F.count(F.lit(1)).alias("n_corrections"))


def replay(exposures: DataFrame, batches: int, lateness: str = "3650 days") -> DataFrame:
    """A table of exposures as the stream leaves it: dealt over files by a hash of the row, read in ``batches`` micro-batches.
    The lateness covers the table's span, as files carry no order of time. ``is_final``: the last correction of a key is
    its earliest time."""
    spark = exposures.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/first_exposure/{uuid.uuid4().hex}"
    parts = batches * max(1, spark.sparkContext.defaultParallelism)  # a file a core in every batch
    rows = exposures.select("event_id", *KEY, "exposed_at")
    rows.repartition(parts, F.xxhash64("event_id", "exposed_at")).write.parquet(f"{base}/feed")
    feed = spark.readStream.schema(spark.read.parquet(f"{base}/feed").schema)
    feed = feed.option("maxFilesPerTrigger", parts // batches).parquet(f"{base}/feed")
    query = start_corrections(feed, f"{base}/out", f"{base}/offsets", lateness, timedelta(days=3650))
    query.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy(*KEY).agg(
        F.min("first_exposed_at").alias("first_exposed_at"),
        (F.max_by("first_exposed_at", "revision") == F.min("first_exposed_at")).alias("is_final"),
    )
