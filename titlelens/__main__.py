"""Command line: python -m titlelens <command> ...

  run      answer questions over a catalogue and write one report each
  convert  store a TSV catalogue as Parquet (do this once, then query it)
  derive   derive the test catalogue from TPC-H-style parquet tables
  profile  write the column profile and numeric summary of a catalogue
  list     list the registered questions
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("titlelens").getOrCreate()
    from titlelens.session import check_session
    for warning in check_session(spark):
        print(f"warning: {warning}", file=sys.stderr)
    return spark


def _incomplete(cat) -> bool:
    for table, why in sorted(cat.missing.items()):
        print(f"missing table: {table}: {why}", file=sys.stderr)
    return bool(cat.missing)


def main(argv=None) -> int:
    from titlelens.plans.registry import QUESTIONS

    ap = argparse.ArgumentParser(prog="titlelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run")
    run.add_argument("--catalog", required=True)
    run.add_argument("--format", default="parquet", choices=["tsv", "parquet"])
    run.add_argument("--out", required=True)
    run.add_argument("--only", default="")
    run.add_argument("--report-format", default="csv", choices=["csv", "parquet"])
    run.add_argument("--params", default="{}", help='JSON: {"question": {"param": value}}')
    conv = sub.add_parser("convert")
    conv.add_argument("--catalog", required=True)
    conv.add_argument("--out", required=True)
    conv.add_argument("--partitions", type=int, default=None,
                      help="range-partition each table on its key into this many files")
    conv.add_argument("--suffix", default=None, help="file suffix of the dumps, e.g. .tsv.gz (default .tsv)")
    der = sub.add_parser("derive")
    der.add_argument("--sf-dir", required=True)
    der.add_argument("--out", required=True)
    prof = sub.add_parser("profile")
    prof.add_argument("--catalog", required=True)
    prof.add_argument("--format", default="parquet", choices=["tsv", "parquet"])
    prof.add_argument("--out", required=True)
    sub.add_parser("list")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name, q in QUESTIONS.items():
            doc = " ".join((q.fn.__doc__ or "").split("\n\n")[0].split())
            print(f"{name}\t{q.section}\t{q.fn.__name__}\t{doc}")
        return 0

    from titlelens.sources import derive_catalog, read_catalog, write_catalog, write_report
    spark = _session()
    if args.cmd == "convert":
        if (args.suffix or "").endswith(".gz") and not args.partitions:
            ap.error("gzipped dumps cannot be split: give --partitions, or one task would sort and write each table")
        cat = read_catalog(spark, args.catalog, fmt="tsv", strict=True, suffix=args.suffix)
        write_catalog(cat, args.out, partitions=args.partitions)
    elif args.cmd == "derive":
        write_catalog(derive_catalog(spark, args.sf_dir, reuse=False), args.out)
    elif args.cmd == "profile":
        from titlelens.plans.profile import numeric_stats_catalog, profile_catalog
        cat = read_catalog(spark, args.catalog, fmt=args.format)
        if _incomplete(cat):
            return 1
        write_report(profile_catalog(cat), f"{args.out}/profile")
        write_report(numeric_stats_catalog(cat), f"{args.out}/numeric_stats")
    elif args.cmd == "run":
        from titlelens.plans.batch import run_reports
        cat = read_catalog(spark, args.catalog, fmt=args.format)
        names = [n for n in args.only.split(",") if n] or None
        status = run_reports(spark, cat, args.out, names, args.report_format, json.loads(args.params))
        failed = 0
        for row in status.collect():
            print(f"{row.question}\t{row.status}\t{row.seconds:.2f}s\t{row.error or ''}")
            failed += row.status != "ok"
        return 1 if _incomplete(cat) or failed else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
