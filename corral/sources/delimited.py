"""Delimited text (CSV) source with a fixed schema, and source metrics."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The source file format the reference reads.
DELIMITER = "|"
# Reads fractions of 0-6 digits and a zone offset, e.g. 2024-01-01T10:00:00.1+0000.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]Z"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    header: bool = True,
    delimiter: str = DELIMITER,
    encoding: str = "UTF-8",
    timestamp_format: str = TIMESTAMP_FORMAT,
    corrupt_column: str | None = None,
    columns: Sequence[str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Read delimited files with an explicit schema (no inference).

    ``corrupt_column`` keeps the raw text of rows whose fields do not parse
    (it is added to the schema as a string); otherwise such fields become
    null, as Spark's permissive mode does.  ``columns`` selects the wanted
    columns, which Catalyst prunes from the scan.  ``recursive`` reads every
    file below the given folders (narrow it with a filter on ``_metadata``,
    which Spark applies to the file list before reading).
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = StructType(schema.fields).add(corrupt_column, "string")
    reader = (
        spark.read.format("csv")
        .schema(schema)
        .option("header", str(bool(header)).lower())
        .option("delimiter", delimiter)
        .option("encoding", encoding)
        .option("timestampFormat", timestamp_format)
        .option("mode", "PERMISSIVE")
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(list(paths) if not isinstance(paths, str) else paths)
    if columns:
        keep = list(columns) + ([corrupt_column] if corrupt_column and corrupt_column not in columns else [])
        df = df.select(*keep)
    return df


def write_delimited(
    df: DataFrame,
    path: str,
    header: bool = True,
    delimiter: str = DELIMITER,
    encoding: str = "UTF-8",
    mode: str = "overwrite",
) -> None:
    (
        df.write.mode(mode)
        .option("header", str(bool(header)).lower())
        .option("delimiter", delimiter)
        .option("encoding", encoding)
        .csv(path)
    )


def source_metrics(df: DataFrame) -> DataFrame:
    """source_row_count and source_column_count in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("source_column_count"),
    )


def file_metrics(df: DataFrame) -> DataFrame:
    """Row count, file count and newest file time of a file-source frame,
    from the hidden ``_metadata`` column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.count_distinct(F.col("_metadata.file_path")).alias("source_file_count"),
        F.max(F.col("_metadata.file_modification_time")).alias("source_file_arrival"),
    )


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


class EmptySourceError(RuntimeError):
    """Raised when the source has no rows and empty input is not allowed."""


def empty_check(df: DataFrame) -> DataFrame:
    """One row: source_row_count and is_empty."""
    return df.agg(F.count(F.lit(1)).alias("source_row_count")).select(
        "source_row_count", (F.col("source_row_count") == 0).alias("is_empty")
    )


def enforce_empty_policy(row_count: int, allow_empty: bool = False) -> None:
    if row_count == 0 and not allow_empty:
        raise EmptySourceError("Source has no records")
