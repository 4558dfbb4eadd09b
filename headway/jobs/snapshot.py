"""Daily snapshot: what runs on a service date, to the serving and published tables."""

from __future__ import annotations

import argparse
import datetime as dt

from headway.plans.daily_snapshot import compact_serving, open_tables, write_snapshot
from headway.session import builder


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--serving", required=True)
    p.add_argument("--published", required=True)
    p.add_argument("--service-date", required=True, type=dt.date.fromisoformat)
    p.add_argument("--mode", choices=["reference", "gtfs"], default="reference")
    a = p.parse_args(argv)
    spark = builder("snapshot").getOrCreate()
    write_snapshot(spark, open_tables(spark, a.warehouse), a.serving, a.service_date, a.mode)
    compact_serving(spark, a.serving, a.published, a.service_date)


if __name__ == "__main__":
    main()
