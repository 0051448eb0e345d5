"""Command line for the daily jobs (same flags as the reference's batch jobs).

    python -m abx.plans.cli assignments --dt 2026-02-01 [--in data/raw] [--out data/silver]
    python -m abx.plans.cli exposure-validation --dt 2026-02-01 [--in data/raw] [--silver data/silver]
        [--gold data/gold] [--max_days_after_assignment 7] [--pre_assignment_grace_minutes 5]
    python -m abx.plans.cli results --dt 2026-02-01 [--in data/raw] [--silver data/silver] [--gold data/gold]
        [--anchor assignment|exposure] [--conversion_window_days 7]
    python -m abx.plans.cli catch-up [--in data/raw] [--silver data/silver] [--gold data/gold]

The session comes from the environment (``spark-submit`` / cluster config); cluster defaults are
applied only where unset, and the checkpoint folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from abx.config import ExperimentConfig
from abx.plans import backfill, jobs
from abx.session import apply_cluster_defaults


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="abx")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("assignments", help="canonical assignments + assignment quality (silver)")
    a.add_argument("--dt", required=True)
    a.add_argument("--in", dest="in_path", default="data/raw")
    a.add_argument("--out", dest="out_path", default="data/silver")
    e = sub.add_parser("exposure-validation", help="deduped exposures, validation (silver), daily quality (gold)")
    e.add_argument("--dt", required=True)
    e.add_argument("--in", dest="in_path", default="data/raw")
    e.add_argument("--silver", dest="silver_path", default="data/silver")
    e.add_argument("--gold", dest="gold_path", default="data/gold")
    e.add_argument("--max_days_after_assignment", type=int, default=7)
    e.add_argument("--pre_assignment_grace_minutes", type=int, default=5)
    r = sub.add_parser("results", help="outcomes (gold unit outcomes) and results for one cohort day")
    r.add_argument("--dt", required=True)
    r.add_argument("--in", dest="in_path", default="data/raw", help="raw base holding fact_event")
    r.add_argument("--silver", dest="silver_path", default="data/silver")
    r.add_argument("--gold", dest="gold_path", default="data/gold")
    r.add_argument("--anchor", choices=("assignment", "exposure"), default="assignment")
    r.add_argument("--conversion_window_days", type=int, default=7)
    c = sub.add_parser("catch-up", help="rebuild the days that late or corrected raw data changes")
    c.add_argument("--in", dest="in_path", default="data/raw")
    c.add_argument("--silver", dest="silver_path", default="data/silver")
    c.add_argument("--gold", dest="gold_path", default="data/gold")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"abx-{args.job}").getOrCreate()
    apply_cluster_defaults(spark)
    if args.job == "assignments":
        jobs.build_assignments(spark, args.in_path.rstrip("/"), args.out_path.rstrip("/"), args.dt)
    elif args.job == "results":
        cfg = ExperimentConfig(conversion_window_days=args.conversion_window_days)
        conv = jobs.read_conversions(spark, args.in_path, cfg)
        jobs.build_results(
            spark, args.silver_path, args.gold_path, conv, args.dt, cfg, anchor=args.anchor, raw_base=args.in_path
        )
    elif args.job == "catch-up":
        for dt in backfill.catch_up(spark, args.in_path, args.silver_path, args.gold_path):
            print(dt)
    else:
        cfg = ExperimentConfig(
            max_days_after_assignment=args.max_days_after_assignment,
            pre_assignment_grace_minutes=args.pre_assignment_grace_minutes,
        )
        jobs.build_exposure_validation(
            spark, args.in_path.rstrip("/"), args.silver_path.rstrip("/"), args.gold_path.rstrip("/"), args.dt, cfg
        )


if __name__ == "__main__":
    main()
