"""Incremental file ingestion as a Structured Streaming job.

The file source remembers, in the checkpoint, which files it has read; with
``trigger(availableNow=True)`` each run reads every file not read before and
stops.  This replaces a stored file watermark for folders of immutable files.
(Spark tracks files by path: a file rewritten under the same name is not read
again.)  The sink commits each micro-batch with the checkpoint, so a run that
dies is resumed without loss or duplicates.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corral.sources.delimited import DELIMITER, TIMESTAMP_FORMAT

NO_DATA_YET = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def file_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    header: bool = True,
    delimiter: str = DELIMITER,
    encoding: str = "UTF-8",
    timestamp_format: str = TIMESTAMP_FORMAT,
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
    corrupt_column: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """New files of ``source_dir`` as a stream.  ``corrupt_column`` keeps the raw text
    of rows that do not parse; ``archive_dir`` moves files there once the batch
    that read them is done, so a listing stays as short as what is new."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = StructType(schema.fields).add(corrupt_column, "string")
    reader = (
        spark.readStream.format("csv")
        .schema(schema)
        .option("header", str(bool(header)).lower())
        .option("delimiter", delimiter)
        .option("encoding", encoding)
        .option("timestampFormat", timestamp_format)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(source_dir)


def stream_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    sink_path: str,
    checkpoint_location: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    **read_options,
) -> int:
    """Read every not-yet-read file under ``source_dir`` into the parquet sink
    at ``sink_path`` and stop.  Returns the number of rows this run added to
    the sink, counted there (from parquet footers), so it is exact for any
    number of micro-batches."""
    before = _rows_in(spark, sink_path)
    stream = file_stream(spark, source_dir, schema, **read_options)
    if transform is not None:
        stream = transform(stream)
    q = (
        stream.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _rows_in(spark, sink_path) - before


def _rows_in(spark: SparkSession, path: str) -> int:
    """Rows of a parquet folder; 0 where there is none yet."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() not in NO_DATA_YET:
            raise
        return 0


def stream_batches(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    checkpoint_location: str,
    handle_batch: Callable[[DataFrame, int], None],
    **read_options,
) -> None:
    """Run ``handle_batch(batch_df, batch_id)`` once per micro-batch of new
    files (for example the whole validate-and-load step), then stop."""
    q = (
        file_stream(spark, source_dir, schema, **read_options)
        .writeStream.foreachBatch(handle_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
