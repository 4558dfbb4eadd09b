"""Every operator on the driver tables, with the SQL that gives the same rows.

The tables hold no transit data, so each demo maps their columns to the roles
an operator needs. All of them run over whole tables.
"""

from . import batch, live, streams, versions, warehouse  # noqa: F401  (they register themselves)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
