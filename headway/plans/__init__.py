"""Whole jobs: sources, operators and sinks put together."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor


def side_by_side(steps: Iterable[Callable[[], None]], at_once: int = 8) -> None:
    """Run independent writes together, so that small tables fill the cores a
    large one leaves idle. The first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(s) for s in steps]:
            done.result()
