"""Command line of the batch jobs, for ``spark-submit run.py <job> ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from typing import NoReturn

from pyspark.sql import SparkSession

from cellweave import sources
from cellweave.operators import filters
from cellweave.plans import jobs
from cellweave.schemas import RESTAURANT
from cellweave.session import session


class _Parser(argparse.ArgumentParser):
    def error(self, message: str) -> NoReturn:
        self.print_usage(sys.stderr)
        print(message, file=sys.stderr)
        sys.exit(-1)


def parser() -> argparse.ArgumentParser:
    top = _Parser(prog="run.py")
    top.add_argument("--shuffle-partitions", type=int)
    top.add_argument("--split-bytes", type=int)
    top.add_argument("--advisory-bytes", type=int)
    top.add_argument("--kryo", action="store_true")
    top.add_argument("--show", type=int, default=0, metavar="N", help="print N rows of the result")
    add = top.add_subparsers(dest="job", required=True).add_parser

    job = add("counts", help="restaurants per franchise and city")
    job.add_argument("restaurants")
    job.add_argument("target")
    job.add_argument("--fixed-schema", action="store_true", help="do not infer the column types")
    job.add_argument("--types", metavar="PATH", help="keep what was inferred there, and read only new files for it")
    job.add_argument("--set-aside", metavar="PATH", help="store lines that do not fit the layout there")

    job = add("geocode", help="missing coordinates from a gazetteer")
    job.add_argument("restaurants")
    job.add_argument("gazetteer")
    job.add_argument("target")
    job.add_argument("--mode", choices=sorted(jobs.geocoding.MODES), default="fill_gaps")
    job.add_argument("--most-edits", type=int, help="also find places that are written another way, with so many wrong letters")
    job.add_argument("--set-aside", metavar="PATH", help="store lines that do not fit the layout there")
    job.add_argument("--franchise", help="print the result for this franchise")

    job = add("geohash", help="add a geohash to geocoded restaurants")
    job.add_argument("restaurants")
    job.add_argument("target")

    job = add("complete", help="fill gaps and add a geohash")
    job.add_argument("restaurants")
    job.add_argument("gazetteer")
    job.add_argument("target")
    job.add_argument("--set-aside", metavar="PATH", help="store lines that do not fit the layout there")

    job = add("unpack", help="weather archives to year=/month=/day= folders")
    job.add_argument("archives")
    job.add_argument("target")

    job = add("recompress", help="rewrite weather under another codec")
    job.add_argument("weather")
    job.add_argument("target")
    job.add_argument("--codec", default="gzip")

    job = add("averages", help="take new and changed days of weather into kept averages")
    job.add_argument("weather")
    job.add_argument("state")

    job = add("enrich", help="join restaurants with the weather of their cell")
    job.add_argument("restaurants")
    job.add_argument("weather")
    job.add_argument("target")
    job.add_argument("--grain", choices=jobs.GRAINS, default="cell")
    job.add_argument("--weather-format", choices=jobs.WEATHER_FORMATS, default="parquet")
    job.add_argument("--weather-schema", metavar="DDL", help="column names and types of weather in CSV")
    job.add_argument("--no-broadcast", dest="broadcast", action="store_false")
    job.add_argument("--prefix-letters", type=int, help="folders of so many letters instead of one per cell")

    job = add("pipeline", help="unpack, complete and enrich")
    job.add_argument("restaurants")
    job.add_argument("gazetteer")
    job.add_argument("archives")
    job.add_argument("folder")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[object, str]:
    """Run the chosen job; answers with what it returned and where its result lies."""
    if args.job == "counts":
        schema = RESTAURANT if args.fixed_schema else None
        return jobs.count_restaurants(spark, args.restaurants, args.target, schema, args.types, args.set_aside), args.target
    if args.job == "geocode":
        rows = jobs.geocode(
            spark, args.restaurants, args.gazetteer, args.target, args.mode, args.most_edits, args.set_aside
        )
        return rows, args.target
    if args.job == "geohash":
        return jobs.tag_geohash(spark, args.restaurants, args.target), args.target
    if args.job == "complete":
        rows = jobs.complete_restaurants(
            spark, args.restaurants, args.gazetteer, args.target, set_aside=args.set_aside
        )
        return rows, args.target
    if args.job == "unpack":
        return jobs.unpack_weather(spark, args.archives, args.target), args.target
    if args.job == "recompress":
        return jobs.recompress(spark, args.weather, args.target, args.codec), args.target
    if args.job == "averages":
        return jobs.update_averages(spark, args.weather, args.state), f"{args.state}/days"
    if args.job == "enrich":
        rows = jobs.enrich_restaurants(
            spark,
            args.restaurants,
            args.weather,
            args.target,
            grain=args.grain,
            weather_format=args.weather_format,
            weather_schema=args.weather_schema,
            broadcast=args.broadcast,
            prefix_letters=args.prefix_letters,
        )
        return rows, args.target
    target = jobs.pipeline(spark, args.restaurants, args.gazetteer, args.archives, args.folder)
    return target, target


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session(
        f"cellweave {args.job}",
        shuffle_partitions=args.shuffle_partitions,
        split_bytes=args.split_bytes,
        advisory_bytes=args.advisory_bytes,
        kryo=args.kryo,
    )
    try:
        done, target = run(spark, args)
        print(f"{args.job}: {done}")
        for name in ("read", "to_mend", "set_aside"):
            if getattr(done, name, None) is not None:
                print(f"rows {name.replace('_', ' ')}: {getattr(done, name)}")
        read = sources.by_geohash if args.job in ("enrich", "pipeline") else sources.parquet
        if getattr(args, "prefix_letters", None) is not None:
            read = sources.by_prefix
        if args.show:
            jobs.show(read(spark, target), args.show)
        if getattr(args, "franchise", None):
            filters.by_franchise(read(spark, target), args.franchise).show()
    finally:
        spark.stop()
