"""Command line: ``python -m stratalake <step> [--root URI] [--format FMT]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stratalake.config import LakeConfig
from stratalake.plans.bronze import run_bronze
from stratalake.plans.gold import run_fleet, run_gold
from stratalake.plans.publish import run_publish
from stratalake.plans.silver import run_silver
from stratalake.plans.stream import run_live, run_stream_bronze
from stratalake.session import SETTINGS

STEPS = {
    "bronze": run_bronze,
    "silver": run_silver,
    "gold": run_gold,
    "stream": run_stream_bronze,
    "live": run_live,
    "fleet": run_fleet,
    "publish": run_publish,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stratalake", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root")
    parser.add_argument("--format", dest="fmt")
    parser.add_argument("--max-offsets", type=int, help="most messages a micro-batch takes from the topic")
    parser.add_argument("--once-each", action="store_true", help="stream: drop re-delivered messages")
    parser.add_argument("--keep-rejects", action="store_true", help="silver: write the rejected rows, too")
    parser.add_argument("--report-fields", action="store_true", help="bronze: report JSON fields without a column")
    parser.add_argument("--lenient-int", action="store_true", help="silver: read 3.7 as 3")
    args = parser.parse_args(argv)
    given = {name: value for name, value in (("root", args.root), ("fmt", args.fmt), ("max_offsets", args.max_offsets)) if value}
    cfg = LakeConfig.from_env(**given)
    spark = SparkSession.builder.appName(f"stratalake-{args.step}").config(map=SETTINGS).getOrCreate()
    try:
        options = {
            "bronze": {"report_fields": args.report_fields},
            "silver": {"keep_rejects": args.keep_rejects, "lenient_int": args.lenient_int},
            "stream": {"once_each": args.once_each},
        }.get(args.step, {})
        STEPS[args.step](spark, cfg, **options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
