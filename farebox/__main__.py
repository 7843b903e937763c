"""Command line of the nightly load, for spark-submit or ``python -m farebox``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from farebox.operators.quality import failed_checks
from farebox.plans.nightly import TABLES, run_pipeline


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="farebox", description=__doc__)
    parser.add_argument("raw", help="folder with one dataset per raw entity")
    parser.add_argument("warehouse", help="folder the tables are written to")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="day of the route snapshot")
    parser.add_argument("--load-ts", type=dt.datetime.fromisoformat, help="time of the load, UTC")
    parser.add_argument("--tables", nargs="+", choices=TABLES, default=TABLES)
    parser.add_argument(
        "--may-be-missing", nargs="*", default=[], help="raw entities taken for empty if absent"
    )
    parser.add_argument("--no-staging", dest="stage", action="store_false")
    parser.add_argument("--quarantine", action="store_true", help="set aside rows that do not fit")
    parser.add_argument("--database", help="catalog database for tables written whole")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("farebox").getOrCreate()
    counts, log = run_pipeline(
        spark,
        options.raw,
        options.warehouse,
        as_of=options.as_of,
        load_ts=options.load_ts,
        tables=options.tables,
        stage=options.stage,
        may_be_missing=options.may_be_missing,
        database=options.database,
        quarantine=options.quarantine,
    )
    counts.show(truncate=False)
    failed_checks(log).show(truncate=False)


if __name__ == "__main__":
    main()
