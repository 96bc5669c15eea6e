"""python -m cuadre REPORT SOURCE TARGET: run one report job, or `extracts` to write relations from base tables."""

from __future__ import annotations

import argparse
import datetime as dt

from cuadre.plans.jobs import JOBS, run_extracts, run_job
from cuadre.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="cuadre", description=__doc__)
    parser.add_argument("report", choices=[*sorted(JOBS), "extracts"])
    parser.add_argument("source", help="folder with the extracts, or with base tables")
    parser.add_argument("target", help="folder for the report")
    parser.add_argument("--input-format", default="csv", help="csv, parquet, or base: base tables as Parquet")
    parser.add_argument("--since", type=dt.date.fromisoformat, help="earliest date that extract queries take")
    parser.add_argument("--cells", default="quoted", help="what cells of CSV extracts may hold: quoted, one_line or free")
    parser.add_argument("--no-profile", action="store_true", help="write no column profile")
    parser.add_argument("--profile-while-writing", action="store_true", help="no second read for it; distinct counts are estimates")
    parser.add_argument("--non-empty", action="store_true", help="stop when there are no invoices")
    parser.add_argument("--ordered", action="store_true", help="sort relations as their extract files are sorted")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--mode", default="errorifexists", help="append, overwrite or errorifexists")
    args = parser.parse_args()
    spark = build_session()
    try:
        if args.report == "extracts":
            run_extracts(
                spark, args.source, args.target, None, args.since, args.format, args.mode, ordered=args.ordered
            )
        else:
            run_job(
                spark, args.report, args.source, args.target, args.input_format, args.format, args.mode,
                cells=args.cells, since=args.since, non_empty=args.non_empty,
                profiled="while_writing" if args.profile_while_writing else not args.no_profile,
            )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
