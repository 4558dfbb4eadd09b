"""Database tables (OP-S4..S6). Connection details come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from headway.functions.cleaning import current


@dataclass(frozen=True)
class JdbcConf:
    """Where a database is. ``options`` takes user, password, driver and the like."""

    url: str
    options: dict[str, str] = field(default_factory=dict)

    def read_options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": table, **self.options}

    def write_options(self, table: str, batch_size: int = 10_000) -> dict[str, str]:
        """OP-K5: large batches and no transaction, as analytic stores want it."""
        return {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(batch_size),
            "isolationLevel": "NONE",
            **self.options,
        }


def read_jdbc(
    spark: SparkSession,
    conf: JdbcConf,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int | str, int | str] | None = None,
    num_partitions: int = 50,
) -> DataFrame:
    """OP-S4: a whole table. Without a partition column it is one task."""
    reader = spark.read.format("jdbc").options(**conf.read_options(table))
    if partition_column:
        lower, upper = bounds
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    return reader.load()


def read_current(spark: SparkSession, conf: JdbcConf, table: str, **partitioning) -> DataFrame:
    """OP-S5: open rows; the filter is pushed into the database."""
    return current(read_jdbc(spark, conf, table, **partitioning))
