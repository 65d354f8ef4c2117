"""The jobs as a command line: python -m ledgerlens JOB --root LAKE --date YYYY-MM-DD [--date ...]."""

from __future__ import annotations

import argparse
import json

from ledgerlens.plans import jobs
from ledgerlens.session import get_spark

JOBS = ("bronze", "silver", "gate", "gold", "rules", "ml", "flags", "marts", "tests", "all", "backfill")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="ledgerlens", description=__doc__)
    out.add_argument("job", choices=JOBS)
    out.add_argument("--root", required=True, help="folder of the lake")
    out.add_argument("--date", action="append", default=[], help="a day; may be given several times")
    out.add_argument("--hour", action="append", type=int, help="a landed hour, for bronze and all; default: whole days")
    out.add_argument("--raw-root", help="where the raw files lie, if not under the root")
    out.add_argument("--as-of", help="time of the run, for stamps; default: now")
    out.add_argument("--train", action="store_true", help="ml: train the forest first")
    out.add_argument("--ml", action="store_true", help="all, backfill: score with the forest too")
    out.add_argument("--master", help="Spark master, if spark-submit does not name one")
    return out


def run(spark, args: argparse.Namespace) -> dict:
    root, dates, stamp = args.root, args.date, {"as_of": args.as_of}
    if not dates and args.job not in ("marts", "tests"):
        raise SystemExit("name at least one --date")
    return {
        "bronze": lambda: jobs.run_bronze_ingest(spark, root, dates, args.hour, raw_root=args.raw_root, **stamp),
        "silver": lambda: jobs.run_silver_cleanse(spark, root, dates, **stamp),
        "gate": lambda: jobs.run_quality_gate(spark, root, dates),
        "gold": lambda: jobs.run_gold_modeling(spark, root, dates, **stamp),
        "rules": lambda: jobs.run_anomaly_detection(spark, root, dates, **stamp),
        "ml": lambda: jobs.run_ml_scoring(spark, root, dates, train=args.train, **stamp),
        "flags": lambda: jobs.run_flag_update(spark, root, dates),
        "marts": lambda: jobs.run_marts(spark, root),
        "tests": lambda: jobs.run_gold_tests(spark, root),
        "all": lambda: jobs.run_all_layers(spark, root, dates, args.hour, ml=args.ml, raw_root=args.raw_root, **stamp),
        "backfill": lambda: jobs.backfill(spark, root, dates, ml=args.ml, **stamp),
    }[args.job]()


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_spark(f"ledgerlens-{args.job}", args.master)
    print(json.dumps(run(spark, args), default=str))


if __name__ == "__main__":
    main()
