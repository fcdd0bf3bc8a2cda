"""Command line: land test data, build marts from landing tables, write reports.

  python -m tussock ingest SOURCE --file PATH --landing ROOT [...]
      SOURCE: rates | census | supermarkets | stops | schools | prices
  python -m tussock land   --sf /root/testdata/sf0.01 --landing ROOT
  python -m tussock build  --landing ROOT --out ROOT [--disable liveability]
  python -m tussock report --out ROOT [--suburb NAME ...]

The session comes from ``SparkSession.builder.getOrCreate()`` with the library
defaults, so cluster settings (master, ``spark.checkpoint.dir``) are taken from
the submitting environment; ``--input-bytes N`` sizes shuffle and scan
partitions for N bytes of input (see ``session.cluster_conf``).
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def main(argv: list[str] | None = None, spark=None) -> dict:
    from tussock.plans import pipeline
    from tussock.plans.staging import Landing
    from tussock.session import get_spark
    from tussock.sources.landing import SourceRegistry

    ap = argparse.ArgumentParser(prog="tussock")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size the session's shuffle and scan partitions for this much input (cluster runs)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_ing = sub.add_parser("ingest")
    p_ing.add_argument("source", choices=["rates", "census", "supermarkets", "stops", "schools", "prices"])
    p_ing.add_argument("--file", required=True)
    p_ing.add_argument("--landing", required=True)
    p_ing.add_argument("--date-format", default=None)
    p_ing.add_argument("--json-lines", action="store_true", help="stops and schools: one envelope a line")
    p_ing.add_argument("--start-year", type=int, default=None)
    p_ing.add_argument("--end-year", type=int, default=None)
    p_land = sub.add_parser("land")
    p_land.add_argument("--sf", required=True)
    p_land.add_argument("--landing", required=True)
    p_build = sub.add_parser("build")
    p_build.add_argument("--landing", required=True)
    p_build.add_argument("--out", required=True)
    p_build.add_argument("--disable", action="append", default=[])
    p_rep = sub.add_parser("report")
    p_rep.add_argument("--out", required=True)
    p_rep.add_argument("--suburb", action="append", default=None)
    args = ap.parse_args(argv)

    if spark is None:
        from tussock.session import cluster_conf
        spark = get_spark(extra_conf=cluster_conf(args.input_bytes) if args.input_bytes else None)
    if args.cmd == "ingest":
        from tussock.sources import jobs
        if args.source == "rates":
            n = jobs.ingest_rates_file(spark, args.file, args.landing, args.date_format)
        elif args.source == "prices":
            if args.start_year is None or args.end_year is None:
                ap.error("prices needs --start-year and --end-year")
            n = jobs.ingest_price_pages_file(spark, args.file, args.landing, args.start_year, args.end_year)
        elif args.source in ("stops", "schools"):
            fn = {"stops": jobs.ingest_stops_file, "schools": jobs.ingest_schools_file}[args.source]
            n = fn(spark, args.file, args.landing, args.json_lines)
        else:
            fn = {"census": jobs.ingest_census_file, "supermarkets": jobs.ingest_supermarkets_file}[args.source]
            n = fn(spark, args.file, args.landing)
        result = {args.source: n}
    elif args.cmd == "land":
        result = pipeline.land_testdata(spark, args.sf, args.landing)
    elif args.cmd == "build":
        landing = Landing.from_registry(SourceRegistry(spark, args.landing))
        res = pipeline.build(spark, landing, args.out, enabled={m: False for m in args.disable})
        failed = {k: v.count() for k, v in res.checks.items() if k == "unique"}
        failed["not_null"] = sum(r.failing_rows for r in res.checks["not_null"].collect()) if "not_null" in res.checks else 0
        failed["nan"] = sum(r.nan_rows for r in res.checks["nan_prices"].collect())
        result = {"paths": res.paths, "failing": failed}
    else:
        mart = pipeline.read_affordability(spark, os.path.join(args.out, "mart_affordability_index"),
                                           keep_partition=True)
        result = pipeline.write_reports(mart, args.out, args.suburb)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
