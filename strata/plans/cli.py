"""Command-line entry point for a cluster job.

    spark-submit strata/plans/cli.py pipeline --landing <root> --out <root> \
        [--batches batch_1,batch_2 | --format parquet] [--facts-by-month]

The session comes from spark-submit (master, executors, ``spark.checkpoint.dir``);
only settings strata relies on are added.  Exit status 1 when the quality gate
fails, after every failing check has been printed.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from strata.operators.quality import ValidationFailed
    from strata.plans.pipeline import run_pipeline
    from strata.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("pipeline", help="Bronze -> Silver -> Gold -> quality gate")
    run.add_argument("--landing", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--batches", default="", help="comma list of CSV batch folders")
    run.add_argument("--format", default="csv", choices=["csv", "parquet"])
    run.add_argument("--source-system", default="landing")
    run.add_argument("--facts-by-month", action="store_true")
    args = p.parse_args(argv)

    builder = SparkSession.builder.appName("strata-pipeline")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    batches = [b for b in args.batches.split(",") if b] or None
    try:
        result = run_pipeline(
            spark, args.landing, batches, args.out, source_system=args.source_system,
            landing_format=args.format, facts_by_month=args.facts_by_month,
        )
    except ValidationFailed as exc:
        print(str(exc), file=sys.stderr)
        return 1
    for table, n in sorted(result.counts.items()):
        print(f"{table}\t{n}")
    print(f"{sum(r['passed'] for r in result.checks)}/{len(result.checks)} checks passed")
    return 0


if __name__ == "__main__":
    sys.exit(main())
