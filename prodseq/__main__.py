"""Command line: python -m prodseq stage3 --data DIR --out DIR --start DD.MM.YYYY"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from prodseq.plans import runner


def _day(text: str) -> date:
    return datetime.strptime(text, "%d.%m.%Y").date()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="prodseq", description=__doc__)
    parser.add_argument("stage", choices=["stage1", "stage2", "stage3"])
    parser.add_argument("--data", required=True, help="folder of the landed reports")
    parser.add_argument("--out", required=True, help="folder for the written reports")
    parser.add_argument("--start", required=True, type=_day, help="first date, DD.MM.YYYY")
    parser.add_argument("--end", type=_day, help="last date; the first date if left out")
    parser.add_argument("--parameters", help="CSV of the parameter table")
    parser.add_argument("--manual", help="manual demand list, CSV or Parquet")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    parser.add_argument(
        "--count-unusable", action="store_true", help="also count rows left out for missing keys"
    )
    args = parser.parse_args(argv)

    spark = (
        SparkSession.builder.appName("prodseq")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    job = runner.Job(
        args.data, args.out, args.start, args.end or args.start, args.parameters, args.manual,
        args.format, args.count_unusable,
    )
    run = {"stage1": runner.run_stage1, "stage2": runner.run_stage2, "stage3": runner.run_stage3}
    summary = run[args.stage](spark, job)
    if summary is not None:
        summary.orderBy("report_date").show(vertical=True)


if __name__ == "__main__":
    main()
