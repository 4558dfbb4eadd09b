"""Dashboard tables from what the monitor and alert flows have written."""

from __future__ import annotations

import argparse

from headway.plans.dashboard import publish_dashboard
from headway.session import builder


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--monitor", required=True, help="folder of monitor rows")
    p.add_argument("--alerts", help="folder of flat alerts")
    p.add_argument("--parts", help="folder where sums per group of batches are kept, so that only new ones are read")
    p.add_argument("--output", required=True)
    a = p.parse_args(argv)
    publish_dashboard(builder("dashboard").getOrCreate(), a.monitor, a.output, a.alerts, a.parts)


if __name__ == "__main__":
    main()
