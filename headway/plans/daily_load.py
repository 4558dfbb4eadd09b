"""Feed files to the versioned warehouse (OP-S1 -> OP-C1 -> OP-C2 -> OP-K8)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from headway.operators.feeds import changed_feeds, next_versions
from headway.operators.staging import prepare_staging
from headway.schemas import TABLES
from headway.sinks.tables import ScdTable, write_staging
from headway.sources.feed_files import FeedFiles, read_feed_table
from headway.sources.versions import VersionState, feed_versions

from . import side_by_side


def warehouse_table(spark: SparkSession, warehouse: str, name: str) -> ScdTable:
    return ScdTable(spark, f"{warehouse.rstrip('/')}/{name}", TABLES[name].warehouse_schema)


def load_table(
    spark: SparkSession, landing: str | FeedFiles, staging: str, warehouse: str, name: str, run_ts: Column
) -> None:
    """One table: stage what the feeds hold now, merge it into the warehouse."""
    spec = TABLES[name]
    staged_at = f"{staging.rstrip('/')}/{name}"
    write_staging(prepare_staging(read_feed_table(spark, landing, spec), spec, run_ts), staged_at)
    table = warehouse_table(spark, warehouse, name)
    table.merge(spark.read.parquet(staged_at), spec.key, spec.tracked, spec.sort_key)
    table.drop_old()


def load_feeds(
    spark: SparkSession,
    landing: str,
    staging: str,
    warehouse: str,
    run_ts: Column,
    names: Iterable[str] = tuple(TABLES),
) -> None:
    files = FeedFiles(spark, landing)  # one listing for all tables
    side_by_side(
        partial(load_table, spark, files, staging, warehouse, name, run_ts) for name in names
    )


def load_if_changed(
    spark: SparkSession,
    landing: str,
    staging: str,
    warehouse: str,
    state: str,
    run_ts: Column,
    names: Iterable[str] = tuple(TABLES),
) -> bool:
    """OP-C5 with OP-S9: load only if a feed has another version than last time.

    The state is written once all tables are merged, so a load that fails is
    done again. Tells whether it loaded.
    """
    stored = VersionState(spark, state)
    incoming, known = feed_versions(spark, landing), stored.read()
    if not needs_load(incoming, known):
        return False
    load_feeds(spark, landing, staging, warehouse, run_ts, names)
    stored.commit(next_versions(incoming, known))
    return True


def needs_load(incoming: DataFrame, stored: DataFrame) -> bool:
    """OP-C5: nothing changed means the load is skipped; the snapshot still runs."""
    return not changed_feeds(incoming, stored).isEmpty()
