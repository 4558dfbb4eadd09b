"""Boroughs of the published stops from a table of outlines."""

from __future__ import annotations

import argparse

from headway.plans.boroughs import publish_stop_boroughs
from headway.session import builder


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--polygons", required=True, help="table with name and rings")
    p.add_argument("--published", required=True)
    p.add_argument("--cell", type=float, default=0.05, help="grid width in degrees")
    a = p.parse_args(argv)
    publish_stop_boroughs(builder("boroughs").getOrCreate(), a.polygons, a.published, a.cell)


if __name__ == "__main__":
    main()
