"""spark-submit entry of the batch job: ``python -m ledgerloom --raw ... --warehouse ...``."""

from __future__ import annotations

import argparse
import os

from ledgerloom.plans import pipeline
from ledgerloom.session import build_session


def main(argv: list[str] | None = None) -> None:
    env = os.environ
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    parser.add_argument("--raw", default=env.get("RAW_DATA_DIR"), help="folder of the raw tables")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--warehouse", required=True, help="folder shared by all executors")
    parser.add_argument("--report", default=env.get("REPORTS_DIR"), help="folder of the CSV report")
    parser.add_argument("--as-of", help="day that counts as today, yyyy-MM-dd")
    parser.add_argument("--run-id", help="reuse the id of a failed run to replace it")
    parser.add_argument("--views", action="store_true", help="create SQL views of the run")
    args = parser.parse_args(argv)
    if not args.raw:
        parser.error("--raw or RAW_DATA_DIR is required")

    spark = build_session("ledgerloom")
    warehouse = pipeline.run(
        spark,
        args.raw,
        args.warehouse,
        report_path=f"{args.report.rstrip('/')}/data_quality_report" if args.report else None,
        as_of=args.as_of,
        run_id=args.run_id,
        fmt=args.format,
    )
    if args.views:
        warehouse.create_views()
    pipeline.row_count_audit(warehouse).show(truncate=False)


if __name__ == "__main__":
    main()
