"""From text rows to a staging table (OP-A1, OP-C1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.cleaning import (
    cast_to,
    nan_text_to_null,
    trim_all,
    with_scd_columns,
    yyyymmdd_to_date,
)
from headway.schemas import TableSpec


def clean_typed(raw: DataFrame, spec: TableSpec, nan_to_null: bool = False) -> DataFrame:
    """Trim, cast, drop full duplicates, convert dates, clear ``NaN`` texts."""
    rows = cast_to(trim_all(raw), spec.text_schema).dropDuplicates()
    rows = rows.withColumns({c: yyyymmdd_to_date(F.col(c)) for c in spec.dates if c in rows.columns})
    return nan_text_to_null(rows, nan_to_null)


def prepare_staging(
    raw: DataFrame, spec: TableSpec, run_ts: Column, nan_to_null: bool = False
) -> DataFrame:
    """OP-C1: a staging table in the column order of ``spec``; absent columns are NULL."""
    rows = clean_typed(raw, spec, nan_to_null)
    have = set(rows.columns)
    out = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spec.schema.fields
    ]
    return with_scd_columns(rows.select(out), run_ts)
