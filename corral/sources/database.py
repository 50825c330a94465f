"""Sources that are tables: one of the catalog, or one of a database over JDBC.

A run applies the increment predicate (see ``corral.operators.increments``) to
the frame of the source.  Spark pushes it to the partitions and row groups of a
catalog table, and into the generated SQL of each range of a database table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    predicate: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read ``table`` with ``num_partitions`` parallel range queries on
    ``partition_column`` (bounds only shape the split; no row is dropped)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    df = reader.load()
    if predicate is not None:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df


@dataclass
class TableSource:
    """A table or view of the catalog as the source of a run."""

    table: str
    columns: Sequence[str] | None = None
    allow_empty_file: bool = False  # no new row is not an error
    corrupt_column: None = None  # a table has no unparsable rows

    @property
    def name(self) -> str:
        return self.table.replace("`", "").split(".")[-1]

    def frame(self, spark: SparkSession) -> DataFrame:
        df = spark.table(self.table)
        return df.select(*self.columns) if self.columns else df


@dataclass
class DatabaseSource(TableSource):
    """A table of a database, read in parallel ranges of ``partition_column``."""

    url: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        return read_database(
            spark,
            self.url,
            self.table,
            self.properties,
            self.partition_column,
            self.lower_bound,
            self.upper_bound,
            self.num_partitions,
            columns=self.columns,
        )
