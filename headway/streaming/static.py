"""Static side of a running stream (OP-T10)."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class Refreshed:
    """A kept DataFrame that is loaded anew when its version changes.

    ``version`` is asked once per micro-batch, so it should be cheap, such as
    ``VersionedTable.version``. Without it the frame is loaded once.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        version: Callable[[], Hashable] | None = None,
    ):
        self._load = load
        self._version = version
        self._seen: Hashable = None
        self._frame: DataFrame | None = None

    def get(self) -> DataFrame:
        now = self._version() if self._version else None
        if self._frame is None or now != self._seen:
            old = self._frame
            self._frame = self._load().persist(StorageLevel.MEMORY_AND_DISK)
            self._seen = now
            if old is not None:
                old.unpersist()
        return self._frame
