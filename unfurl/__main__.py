"""Command line for the daily jobs (run with spark-submit or python -m unfurl).

    python -m unfurl extract   --export PATH --out PATH [--run-date YYYY-MM-DD] [--recursive] [--file-glob GLOB]
    python -m unfurl responses --table PATH --scan-out PATH --bm-out PATH [--query PATH] [--lenient] [--rejects-out PATH]
    python -m unfurl payloads  --table PATH --cep-out PATH --bm-out PATH [--single-file] [--keep-single-leg]
                               [--lenient] [--rejects-out PATH]
"""

from __future__ import annotations

import argparse
import json
import sys

from . import jobs
from .session import get_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m unfurl")
    sub = p.add_subparsers(dest="job", required=True)
    e = sub.add_parser("extract", help="export files -> previous day -> parquet")
    e.add_argument("--export", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--run-date")
    e.add_argument("--recursive", action="store_true")
    e.add_argument("--file-glob")
    e.add_argument("--rejects-out", help="also write lines that are no items here (text)")
    r = sub.add_parser("responses", help="JSON responses -> scan and bm parquet (+ stored SQL)")
    r.add_argument("--table", required=True)
    r.add_argument("--scan-out", required=True)
    r.add_argument("--bm-out", required=True)
    r.add_argument("--query")
    r.add_argument("--query-out", help="write the stored SQL result here (parquet)")
    r.add_argument("--lenient", action="store_true")
    r.add_argument("--rejects-out", help="also write dropped rows with their reason here")
    x = sub.add_parser("payloads", help="JSON-wrapped XML -> cep and bm CSV")
    x.add_argument("--table", required=True)
    x.add_argument("--cep-out", required=True)
    x.add_argument("--bm-out", required=True)
    x.add_argument("--single-file", action="store_true")
    x.add_argument("--keep-single-leg", action="store_true")
    x.add_argument("--lenient", action="store_true")
    x.add_argument("--rejects-out", help="also write dropped rows with their reason here")
    p.add_argument("--master", help="only for local runs; spark-submit sets it")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(f"unfurl-{args.job}", master=args.master)
    if args.job == "extract":
        out = {"rows": jobs.extract_previous_day(spark, args.export, args.out, run_date=args.run_date,
                                                 recursive=args.recursive, file_glob=args.file_glob,
                                                 rejects_out=args.rejects_out)}
    elif args.job == "responses":
        counts, result = jobs.flatten_responses(spark, spark.read.parquet(args.table), args.scan_out, args.bm_out,
                                                query_path=args.query, strict=not args.lenient,
                                                rejects_out=args.rejects_out)
        if result is not None and args.query_out:
            result.write.mode("overwrite").parquet(args.query_out)
        out = {"rows": counts}
    else:
        out = {"rows": jobs.flatten_payloads(spark, spark.read.parquet(args.table), args.cep_out, args.bm_out,
                                             strict=not args.lenient,
                                             single_leg="keep" if args.keep_single_leg else "drop",
                                             single_file=args.single_file, rejects_out=args.rejects_out)}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
