"""Cleaning and typing of text tables (OP-P1..P5, OP-P17, OP-P21..P23)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCD_COLUMNS = ("start_dt_scd", "end_dt_scd", "is_current")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_number(c: Column | str, to: str = "int") -> Column:
    """Integer part of a decimal text; NULL for anything else.

    ``"3.0"`` is 3: integer columns with gaps often arrive written as floats.
    The cast never sees a text that is no number: a failing one is slow.
    """
    text = F.trim(as_col(c).cast("string"))
    digits = F.regexp_extract(text, r"^([+-]?\d+)(?:\.\d*)?$", 1)
    return F.nullif(digits, F.lit("")).try_cast(to)


def trim_all(df: DataFrame) -> DataFrame:
    """OP-P1: every column as trimmed text, in one projection."""
    return df.select([F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def _typed(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return c.cast("string")
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return whole_number(c.cast("string"), data_type.simpleString())
    return c.try_cast(data_type)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """OP-P2: cast the columns named in ``schema``; a bad value becomes NULL.

    Columns of ``df`` the schema does not name are kept as they are.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(
        [
            _typed(F.col(f"`{c}`"), wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def yyyymmdd_to_date(c: Column | str) -> Column:
    """OP-P3: yyyyMMdd number or text to a date; NULL if it is not one.

    Only texts whose month and day can be right are parsed: a parse that fails
    costs an exception.
    """
    text = as_col(c).cast("string")
    return F.when(text.rlike(r"^\d{4}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$"), F.try_to_date(text, "yyyyMMdd"))


def nan_text_to_null(df: DataFrame, nan_to_null: bool = False) -> DataFrame:
    """OP-P4: the text ``NaN`` becomes NULL; float NaN only on request."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit("NaN"))
        elif nan_to_null and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(out)


def with_scd_columns(df: DataFrame, run_ts: Column) -> DataFrame:
    """OP-P5: version columns of a fresh row: open interval, current."""
    return df.withColumns(
        {
            "start_dt_scd": run_ts.cast("timestamp"),
            "end_dt_scd": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def current(df: DataFrame) -> DataFrame:
    """OP-P6: rows of the open version."""
    return df.filter(F.col("is_current"))


def any_distinct(left: Mapping[str, Column], right: Mapping[str, Column]) -> Column:
    """OP-P17: true if any pair differs, NULL counting as a value."""
    return reduce(or_, (~left[c].eqNullSafe(right[c]) for c in left))


def fill_unknown(c: Column | str, default: str = "Unknown") -> Column:
    """OP-P21: text with NULL replaced."""
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


def version_text(c: Column | str) -> Column:
    """OP-P22: the date part of a version label."""
    return F.substring(as_col(c), 1, 10)


def patch(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """OP-P23: set columns of the rows that satisfy ``condition``."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def as_columns(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]
