"""Load one delivery: ``python -m starmill RAW LAKE YYYY-MM-DD``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from .plans.warehouse import load_warehouse, raw_zone


def main() -> None:
    parser = argparse.ArgumentParser(prog="starmill", description="Load one delivery into the warehouse.")
    parser.add_argument("raw", help="directory of the raw extracts")
    parser.add_argument("lake", help="directory of the staging and presentation tables")
    parser.add_argument("as_of", type=date.fromisoformat, help="load date")
    parser.add_argument("--flights-sep", default=",")
    parser.add_argument("--date-format", default="yyyy-MM-dd", help="how the flights write their dates")
    parser.add_argument("--calendars", action="store_true", help="the date and time tables are delivered too")
    parser.add_argument("--calendar-format", default="dd/MM/yyyy", help="how a delivered calendar writes its dates")
    parser.add_argument("--version-every-plane", action="store_true", help="open a version per delivered plane")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("starmill").getOrCreate()
    mode = "always" if args.version_every_plane else "attributes"
    raw = raw_zone(args.raw, args.flights_sep, args.date_format, args.calendars, args.calendar_format)
    load_warehouse(spark, raw, args.lake, args.as_of, mode).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
