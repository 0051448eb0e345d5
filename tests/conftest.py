from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from abx.session import local_session  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="abx-tests")
    yield s


def ts(seconds: float = 0.0, days: float = 0.0, micros: int = 0) -> dt.datetime:
    return T0 + dt.timedelta(days=days, seconds=seconds, microseconds=micros)


ASSIGN_SCHEMA = T.StructType(
    [
        T.StructField("experiment_id", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("variant_id", T.StringType()),
        T.StructField("assigned_at", T.TimestampNTZType()),
    ]
)
EXPOSURE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("experiment_id", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("variant_id", T.StringType()),
        T.StructField("exposed_at", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)
CONVERSION_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("occurred_at", T.TimestampNTZType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)
