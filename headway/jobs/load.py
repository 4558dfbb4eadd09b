"""Daily load: landing folder to warehouse."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from headway.plans.daily_load import load_feeds, load_if_changed
from headway.schemas import TABLES
from headway.session import builder


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--landing", required=True, help="folder with <region>_<date> feed folders")
    p.add_argument("--staging", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--run-ts", required=True, help="start of the new versions, with its zone")
    p.add_argument("--tables", nargs="*", default=list(TABLES), choices=list(TABLES))
    p.add_argument("--state", help="folder of loaded versions; with it, a load without new versions is skipped")
    a = p.parse_args(argv)
    spark = builder("load").getOrCreate()
    run_ts = F.lit(a.run_ts).cast("timestamp")
    if a.state:
        load_if_changed(spark, a.landing, a.staging, a.warehouse, a.state, run_ts, a.tables)
    else:
        load_feeds(spark, a.landing, a.staging, a.warehouse, run_ts, a.tables)


if __name__ == "__main__":
    main()
