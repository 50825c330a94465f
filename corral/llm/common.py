"""Helpers shared by the operators: table access, staged tables, text columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corral.plans.tables import table
from corral.session import scratch_location

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` of ``docs`` with a null text read as empty.

    Every other column is left behind, so extra columns of any name cannot
    clash with what an operator adds.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_of(table(spark, sf_dir, "documents"))


def in_files(df: DataFrame, rows: int, rows_a_file: int = 50_000, least: int = 8) -> DataFrame:
    """``df``, to be written as at most ``least`` files, or as many as ``rows`` rows need.

    Every file costs its task several calls to the file system, and on a local one
    Hadoop starts a process for each; rounds over few rows else write a file for each
    shuffle partition.  Partitions are taken one after the other, so a task holds no
    more than one of them, and only their number depends on ``rows``."""
    return df.coalesce(max(least, -(-rows // rows_a_file)))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch root and read it back:
    cuts the lineage with files that survive lost executors."""
    spark = df.sparkSession
    path = scratch_location(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def blocks_of(items: Column, size: int = 256) -> Column:
    """An array cut into arrays of ``size``: what grows inside a block is copied a
    bounded number of times, and a long array costs its length times ``size``."""
    count = F.floor((F.size(items) + size - 1) / size).cast("int")
    cut = lambda xs: F.transform(F.sequence(F.lit(1), count), lambda b: F.slice(xs, (b - 1) * size + 1, size))
    return F.when(F.size(items) > 0, let(items, cut)).otherwise(F.slice(F.array(items), 1, 0))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string with the types used here."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()),
        "array<binary>": pa.list_(pa.binary()),
    }
    fields = [f.strip().split(" ", 1) for f in ddl.split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


_MEMORIES: list[dict] = []
_last_step = ""


def kept_between_tasks() -> dict:
    """An empty memory that a worker keeps for the next task of the same step."""
    _MEMORIES.append({})
    return _MEMORIES[-1]


def begin_task(step: str) -> None:
    """A Python worker outlives its task.  At the first task of another step, what
    earlier steps remember is dropped, and memory that is free goes back to the system:
    it would stay beside what this step needs, and beside the JVM's."""
    global _last_step
    if step == _last_step:
        return
    _last_step = step
    for memory in _MEMORIES:
        memory.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError, TypeError):  # what only glibc has
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], ddl: str) -> DataFrame:
    """``mapInArrow`` with ``fn`` yielding one dict of column lists per output batch."""
    schema = arrow_schema(ddl)
    step = fn.__module__

    def run(batches):
        begin_task(step)
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
            )

    return df.mapInArrow(run, ddl)


def text_batches(batches: Iterator[pa.RecordBatch], max_chars: int = 4_000_000) -> Iterator[tuple[list, list[str]]]:
    """Lists of ids and texts of at most about ``max_chars`` characters each, so
    that a run of very long texts does not grow what a task holds."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        column = batch.column("text")
        at, n = 0, len(ids)
        while at < n:
            texts, chars, start = [], 0, at
            while at < n and (chars < max_chars):
                text = column[at].as_py() or ""
                texts.append(text)
                chars += len(text)
                at += 1
            yield ids[start:at], texts


def filter_texts(docs: DataFrame, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose text (null: empty) ``keep`` accepts, all columns
    as they are; one pass, texts in bounded lists."""
    step = keep.__module__

    def run(batches):
        begin_task(step)
        for batch in batches:
            column = batch.column("text")
            mask: list[bool] = []
            texts, chars = [], 0
            for value in column:
                texts.append(value.as_py() or "")
                chars += len(texts[-1])
                if chars > 4_000_000:
                    mask += keep(texts)
                    texts, chars = [], 0
            mask += keep(texts)
            yield batch.filter(pa.array(mask, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
