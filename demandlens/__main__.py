"""Job entry points for a scheduler: ``python -m demandlens <job> ...``.

Jobs:
  land-csv        CSV files under --src -> <root>/bronze/<name>, or Parquet tables under --dst
  ingest-trends   sectioned interest exports under --src -> <root>/bronze/google_trends
  ingest-search   search response files (a JSON document per line) -> appended to bronze search_results
  ingest-statistics  statistics response files -> appended to bronze video_statistics
  build           bronze -> silver -> gold under --root
  requests        pending video ids in request batches, as JSON lines under --out or printed
  export          gold tables -> a JDBC database (replace mode)
"""

from __future__ import annotations

import argparse
import json

from demandlens.session import get_session, materialize, scratch


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="demandlens")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("land-csv")
    s.add_argument("--src", required=True)
    s.add_argument("--dst")
    s.add_argument("--root")
    s.add_argument("--database", help="also register the landed tables in this catalog database")
    s = sub.add_parser("ingest-trends")
    s.add_argument("--src", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--filename-prefix")
    for job in ("ingest-search", "ingest-statistics"):
        s = sub.add_parser(job)
        s.add_argument("--src", required=True)
        s.add_argument("--root", required=True)
        s.add_argument("--stamp", help="time of the run, yyyy-MM-dd HH:mm:ss (default: now)")
    s = sub.add_parser("build")
    s.add_argument("--root", required=True)
    s.add_argument("--database", help="read the bronze tables from this catalog database")
    s.add_argument("--as-of")
    s.add_argument("--growth-over", default="joined", choices=["joined", "snapshots"])
    s = sub.add_parser("requests")
    s.add_argument("--root", required=True)
    s.add_argument("--limit", type=int, default=2000)
    s.add_argument("--size", type=int, default=50)
    s.add_argument("--out", help="folder for the batches (replaced)")
    s = sub.add_parser("export")
    s.add_argument("--root", required=True)
    s.add_argument("--url", required=True)
    s.add_argument("--properties", default="{}", help="JSON object of JDBC properties")
    args = p.parse_args(argv)

    from demandlens.plans import pipeline as P
    from demandlens.plans.pipeline import Layout, build_all, ingest_trend_files, statistics_requests
    from demandlens.sources.csv_landing import land_csv, register_tables
    from demandlens.sources.sinks import export_gold

    spark = get_session(app_name=f"demandlens-{args.job}")
    if args.job == "land-csv":
        if bool(args.dst) == bool(args.root):
            p.error("give one of --dst and --root")
        if args.root:
            result = land_csv(spark, args.src, f"{args.root.rstrip('/')}/bronze", suffix="")
        else:
            result = land_csv(spark, args.src, args.dst)
        if args.database:
            register_tables(spark, args.database, {path.rsplit("/", 1)[-1].removesuffix(".parquet"): path for path in result.values()})
    elif args.job == "ingest-trends":
        result = ingest_trend_files(spark, args.src, Layout(args.root), filename_prefix=args.filename_prefix)
    elif args.job == "build":
        result = build_all(spark, args.root, as_of=args.as_of, growth_over=args.growth_over, database=args.database)
    elif args.job == "ingest-search":
        P.append_search_responses(P.read_responses(spark, args.src), Layout(args.root), P.RESPONSE_ORDER, args.stamp)
        result = {"job": args.job}
    elif args.job == "ingest-statistics":
        P.append_statistics_responses(P.read_responses(spark, args.src), Layout(args.root), P.RESPONSE_ORDER, args.stamp)
        result = {"job": args.job}
    elif args.job == "requests":
        with scratch(spark):
            batches = materialize(statistics_requests(spark, Layout(args.root), limit=args.limit, size=args.size), "requests")
            result = {"batches": batches.count()}
            if args.out:
                batches.write.mode("overwrite").json(args.out)
            else:
                for row in batches.orderBy("batch_id").toLocalIterator():
                    print(json.dumps(row.asDict()))
    else:
        result = export_gold(spark, Layout(args.root).root + "/gold", args.url, json.loads(args.properties))
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
