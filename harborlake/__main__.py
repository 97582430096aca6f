"""``spark-submit ... -m harborlake`` style entry: build all tables from a landing folder.

The session, cluster and schedule are whatever the submission brings along.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from harborlake.plans import Locations, run_pipeline


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="harborlake", description="Build all tables from landed sources.")
    parser.add_argument("landing", help="folder with labels, airport, city_demo, imm and land_temp")
    parser.add_argument("tables", help="folder that receives the tables")
    parser.add_argument("--as-of", type=date.fromisoformat, help="reference day of recent temperatures")
    parser.add_argument("--concurrency", type=int, default=3, help="tables built at the same time")
    given = parser.parse_args(arguments)
    results = run_pipeline(
        SparkSession.builder.getOrCreate(),
        Locations(landing=given.landing.rstrip("/"), tables=given.tables.rstrip("/")),
        as_of=given.as_of,
        concurrency=given.concurrency,
    )
    for result in results:
        print(f"{result.table}: {result.error or f'{result.rows} rows'}")
    return 1 if any(r.error for r in results) else 0


if __name__ == "__main__":
    sys.exit(main())
