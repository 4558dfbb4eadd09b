"""Borough of a trip from the depot code in its id (OP-P12, OP-P13)."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col

# Pattern of the depot code and borough of each depot. "CSg" can
# not be reached, the pattern only yields capitals; it stays as given data.
DEPOT_PATTERN = r"^(?:[0-9]+-)?([A-Z]{2,3})(?:PC5-[A-Z]{2,3})?_.*"
DEPOT_BOROUGH = {
    "CS": "Queens",
    "QV": "Queens",
    "JA": "Queens",
    "FP": "Brooklyn",
    "CSg": "Queens",
    "BP": "Queens",
    "LG": "Queens",
    "FR": "Queens",
    "GA": "Brooklyn",
    "EN": "Brooklyn",
    "JG": "Brooklyn",
    "FB": "Brooklyn",
    "UP": "Brooklyn",
    "SC": "Brooklyn",
    "MQ": "Manhattan",
    "QVH": "Manhattan",
    "MV": "Manhattan",
    "QU": "Manhattan",
    "KB": "Manhattan",
    "GH": "Bronx",
    "WF": "Bronx",
    "EC": "Bronx",
    "CA": "Staten Island",
    "CH": "Staten Island",
    "MD": "Staten Island",
    "YU": "Staten Island",
    "JK": "Brooklyn",
    "CP": "Brooklyn",
    "OF": "Manhattan",
    "OH": "Manhattan",
    "YO": "Manhattan",
}


def depot_code(trip_id: Column | str) -> Column:
    """OP-P12: depot code inside a trip id, empty text if there is none."""
    return F.regexp_extract(as_col(trip_id), DEPOT_PATTERN, 1)


def lookup(c: Column | str, table: Mapping[str, str], default: str = "Unknown") -> Column:
    """OP-P13: value of a small fixed map, or ``default``."""
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(entries[as_col(c)], F.lit(default))


def depot_borough(trip_id: Column | str) -> Column:
    return lookup(depot_code(trip_id), DEPOT_BOROUGH)
