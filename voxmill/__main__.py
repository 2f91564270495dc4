"""Command line: ``python -m voxmill <stage> ...`` (or spark-submit with this file)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructType

from voxmill.config import Site
from voxmill.operators import search, search_index
from voxmill.plans import pipeline
from voxmill.sources import records as io
from voxmill import schemas


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="voxmill")
    top.add_argument("--site-name", default=Site.name)
    top.add_argument("--base-url", default=Site.base_url)
    steps = top.add_subparsers(dest="step", required=True)
    for name in ("extract", "preprocess", "features", "enrich", "report", "run"):
        step = steps.add_parser(name)
        step.add_argument("--input", required=True, help="table to read")
        step.add_argument("--output", required=True, help="folder for the results")
        step.add_argument("--format", default="parquet", choices=("parquet", "jsonl", "json"))
        if name in ("extract", "run"):
            step.add_argument("--min-year", type=int)
            step.add_argument("--robots", help="robots files, <host>/robots.txt or <host>.txt")
            step.add_argument("--agent", default="*", help="whose robots rules apply")
            step.add_argument("--listings", help="table of listing pages: listing_no, url, html")
            step.add_argument("--target-records", type=int, default=30)
            step.add_argument("--search-pages", type=int, default=2)
            step.add_argument("--all-pages", action="store_true", help="two pages a category, longer queue")
    make = steps.add_parser("index")
    make.add_argument("--input", required=True, help="clean records")
    make.add_argument("--output", required=True, help="folder of the index")
    make.add_argument("--format", default="parquet", choices=("parquet", "jsonl", "json"))
    find = steps.add_parser("search")
    find.add_argument("query")
    find.add_argument("--input", required=True)
    find.add_argument("--index", help="index of the same records; without one the search fits anew")
    find.add_argument("--format", default="parquet", choices=("parquet", "jsonl", "json"))
    find.add_argument("--top-k", type=int, default=5)
    find.add_argument("--return-only", action="store_true")
    find.add_argument("--warranty-only", action="store_true")
    find.add_argument("--issue", default="all")
    find.add_argument("--years", type=int, nargs="*")
    find.add_argument("--include-unknown-year", action="store_true")
    return top


def read_table(spark: SparkSession, path: str, form: str) -> DataFrame:
    """Records of a later step. JSON has no types of its own: the schema of enriched records is asked for."""
    if form == "parquet":
        return spark.read.parquet(path)
    found = spark.read.json(path, multiLine=form == "json").columns
    own = (schemas.CLEAN_REVIEW, schemas.FEATURES, schemas.ENRICHMENT, schemas.struct(seq=LongType()))
    known = {f.name: f for schema in own for f in schema.fields}
    wanted = StructType([known[c] for c in found if c in known])
    return io.read_records(spark, path, wanted, form)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("voxmill").getOrCreate()
    site = Site(name=args.site_name, base_url=args.base_url)
    if args.step == "index":
        search_index.build(read_table(spark, args.input, args.format), args.output)
        return
    if args.step == "search":
        records = read_table(spark, args.input, args.format)
        index = search_index.open_index(spark, args.index) if args.index else None
        found = search.filtered_search(
            records, args.query, args.top_k, index, return_only=args.return_only,
            warranty_only=args.warranty_only, issue=args.issue, years=args.years,
            include_unknown=args.include_unknown_year,
        )
        search.result_view(found).orderBy("rank").show(args.top_k, truncate=False, vertical=True)
        return
    paths = pipeline.Paths(args.output)
    if args.step in ("run", "extract"):
        given = pipeline.Crawl(
            io.read_host_rules(spark, args.robots) if args.robots else None,
            spark.read.parquet(args.listings) if args.listings else None,
            args.agent, args.target_records, not args.all_pages, args.search_pages,
        )
    if args.step == "run":
        pipeline.run(spark, args.input, args.output, args.min_year, site, given)
    elif args.step == "extract":
        stored = io.read_pages(spark, args.input)
        pipeline.extract(stored, paths, min_year=args.min_year, site=site, given=given)
    elif args.step == "preprocess":
        raw = io.read_records(spark, args.input, schemas.RAW_REVIEW, args.format)
        pipeline.preprocess(raw, paths, site)
    else:
        step = {"features": pipeline.extract_features, "enrich": pipeline.enrich,
                "report": pipeline.report}[args.step]
        step(read_table(spark, args.input, args.format), paths)


if __name__ == "__main__":
    main()
