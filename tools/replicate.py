"""Write a scaled copy of a testdata folder for scale-up runs (scratch use only).

Usage: python tools/replicate.py SRC_DIR DST_DIR N [hot]
``events`` is replicated N times with suffixed ids (user_id*N+i, event_id*N+i), which keeps every
per-unit distribution and multiplies the number of units. With ``hot``, a third of all events
(event_id % 3 == 0) are moved to one unit, the skew case the operators must survive.
Other tables are linked unchanged.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from abx.session import local_session  # noqa: E402


def main():
    src, dst, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    hot = len(sys.argv) > 4 and sys.argv[4] == "hot"
    spark = local_session(8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i"))
    rep = rep.select(
        (F.col("event_id") * n + F.col("_i")).alias("event_id"),
        "ts",
        (F.col("user_id") * n + F.col("_i")).alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    if hot:
        rep = rep.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    os.makedirs(dst, exist_ok=True)
    rep.repartition(16).write.mode("overwrite").parquet(f"{dst}/events.parquet")
    for f in os.listdir(src):
        if f != "events.parquet" and not os.path.exists(f"{dst}/{f}"):
            os.symlink(f"{src}/{f}", f"{dst}/{f}")


if __name__ == "__main__":
    main()
