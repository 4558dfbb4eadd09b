"""Look-back over ordered rows when one key may hold a large share of them.

A window over a key puts all its rows in one task. Here the order axis is cut
into buckets and the window runs per (key, bucket). What a row needs from
earlier buckets is one value: the last one of the key before the bucket
starts. It is found on a table with one row per (key, bucket), built by a
partial aggregation, and put in front of each bucket as an extra row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from headway.functions.cleaning import as_columns


def axis_bucket(df: DataFrame, column: str, width: int) -> Column:
    """Bucket number of an order column; ``width`` in seconds or in its own unit."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        c = F.unix_seconds(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    return F.floor(c / F.lit(width)).cast("bigint")


def carried(marks: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """Last value before each wanted (by, bucket), as column ``carry``.

    ``marks`` has the columns ``last``, at most one non-NULL per (by, bucket),
    and ``wanted``. Buckets with nothing before them are left out.
    """
    # A range frame: a bucket's own mark is not before it, whatever the order.
    before = (
        Window.partitionBy(*as_columns(by))
        .orderBy(bucket)
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    carry = F.last("last", ignorenulls=True).over(before)
    out = marks.select(*by, bucket, "wanted", carry.alias("carry"))
    return out.filter(F.col("wanted") & F.col("carry").isNotNull()).drop("wanted")
