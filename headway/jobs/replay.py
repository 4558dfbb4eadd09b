"""Archived messages that were not processed, through a flow into batch folders; then where live goes on.

Prints the offsets a Kafka source starts at after the replay.
"""

from __future__ import annotations

import argparse

from headway.session import builder
from headway.streaming import flows, replay

FLOWS = {
    "positions": flows.vehicle_position_stream,
    "updates": flows.trip_update_stream,
    "alerts": flows.alert_stream,
}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("flow", choices=sorted(FLOWS))
    p.add_argument("--archive", required=True, help="what the archive flow of the topic has written")
    p.add_argument("--topic", required=True)
    p.add_argument("--marks", required=True, help="folder that says what has been processed")
    p.add_argument("--output", required=True)
    p.add_argument("--range", type=int, default=1_000_000, help="offsets of a partition in one batch")
    a = p.parse_args(argv)
    spark = builder("replay").getOrCreate()
    folder = f"{a.archive.rstrip('/')}/topic={a.topic}"
    replay.replay(spark, folder, a.marks, FLOWS[a.flow], flows.batch_files(a.output), a.range, base=a.archive)
    print(replay.starting_offsets(spark, a.marks))


if __name__ == "__main__":
    main()
