"""The daily job from the command line: python -m earshot --help."""

from __future__ import annotations

import argparse
import dataclasses
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from earshot.functions.columns import WEEK_REFERENCE
from earshot.plans import daily, views


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="earshot", description=daily.run.__doc__)
    parser.add_argument("--songs", required=True, help="song export, JSON lines")
    parser.add_argument("--users", required=True, help="user export, JSON lines")
    parser.add_argument("--landing", required=True, help="root of the hour folders")
    parser.add_argument("--audits", required=True, help="folder for unmatched events")
    parser.add_argument("--tables", help="folder for the tables' files; default: warehouse")
    parser.add_argument("--exports", help="folder for cleaned CSV and JSON; default: none")
    parser.add_argument(
        "--listed-by", default="folder", choices=["folder", "log", "manifest"],
        help="what tells the landing day's files",
    )
    parser.add_argument(
        "--partials", action="store_true", help="store the day's mergeable partials too"
    )
    parser.add_argument(
        "--rebalance", action=argparse.BooleanOptionalAction,
        help="even out the fact's files; default: if the load has many dates",
    )
    parser.add_argument("--database", help="database of the tables; default: the current one")
    parser.add_argument("--day", default=str(daily.LANDING_DAY), help="landing day to read")
    parser.add_argument("--reference", default=str(WEEK_REFERENCE), help="last day of the week")
    return parser.parse_args(given)


def main(given: Sequence[str] | None = None) -> None:
    args = arguments(given)
    spark = SparkSession.builder.appName("earshot").getOrCreate()
    places = daily.Locations(
        **{f.name: getattr(args, f.name) for f in dataclasses.fields(daily.Locations)}
    )
    tables = views.Tables(args.database)
    report = daily.run(
        spark, places, args.day, args.reference, tables, args.rebalance, args.partials
    )
    print(json.dumps(dataclasses.asdict(report)))


if __name__ == "__main__":
    main()
