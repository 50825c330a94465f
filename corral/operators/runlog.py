"""Run log: an append-only table of step records, read by aggregation.

Each step of a run appends one row (workflow_id, run_id, step_name,
step_completion_status, step_started, step_completion, run_details as JSON
text).  A step written twice is resolved at read time by taking the newest
record (``max_by``, which aggregates partially before the shuffle, so a
workflow with a huge history costs one row per map partition), instead of
updating rows in place.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from corral.functions.scalar import json_field

# Step names and statuses of a run.
READ_STEP = "Read_from_source"
TRANSFORM_STEP = "Transformation_step"
DQ_STEP = "DQ_Step"
PROFILE_STEP = "data_profile_Step"
LOAD_STEP = "Write_to_target"
REPORT_STEP = "DQ_Report"
RUN_START = "Run_started"
SUCCESS = "success"
FAILED = "Failed"
RUNNING = "Running"
FIRST_RUN_ID = 1000

RUN_LOG_SCHEMA = StructType(
    [
        StructField("workflow_id", LongType(), False),
        StructField("run_id", LongType(), False),
        StructField("step_name", StringType(), False),
        StructField("step_completion_status", StringType(), True),
        StructField("step_started", TimestampNTZType(), True),
        StructField("step_completion", TimestampNTZType(), True),
        StructField("run_details", StringType(), True),
    ]
)

# Newest record first: completion time, then run id.
ORDER = ("step_completion", "run_id")


def order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


class RunLog:
    """The append-only run log table, partitioned by workflow and generation.

    Reads of one workflow (``frame(workflow_id)``) are partition-pruned, so a
    run lists only its own workflow's folder however many workflows and runs
    the log holds.  Each append is one small file in the workflow's open
    generation (an even number).

    ``compact`` never overwrites a record.  It opens the next generation for
    appends, writes the records up to now into an odd generation beside them,
    and that generation counts from the moment its partition is registered.
    The generations that it replaces go with the next ``compact`` (or
    ``purge``), after records that a slow writer still put there were carried
    over.  While both are there, readers count each record once, by its id.
    """

    PARTITION, GENERATION, RECORD = "workflow_id", "generation", "record_id"

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table
        self._parts: list[str] | None = None

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def _by_generation(self) -> bool:
        """The table has this layout (an older one is read and appended to as it is)."""
        return self.GENERATION in self._partition_columns()

    def _partition_columns(self) -> list[str]:
        if self._parts is None:
            if not self.exists():
                return [self.PARTITION, self.GENERATION]
            # looked up once: the column listing runs small jobs
            self._parts = [c.name for c in self.spark.catalog.listColumns(self.table) if c.isPartition]
        return self._parts

    def generations(self, workflow_id: int | None = None) -> dict[int, list[int]]:
        """Registered generations by workflow, from the catalog alone."""
        spec = "" if workflow_id is None else f" PARTITION ({self.PARTITION} = {int(workflow_id)})"
        out: dict[int, list[int]] = {}
        for r in self.spark.sql(f"SHOW PARTITIONS {self.table}{spec}").collect():
            workflow, generation = (int(part.partition("=")[2]) for part in r[0].split("/"))
            out.setdefault(workflow, []).append(generation)
        return {w: sorted(g) for w, g in out.items()}

    @staticmethod
    def _replaced(generations: Sequence[int]) -> list[int]:
        """Generations below the newest compacted one."""
        base = max((g for g in generations if g % 2), default=None)
        return [g for g in generations if base is not None and g < base]

    def frame(self, workflow_id: int | None = None) -> DataFrame:
        if not self.exists():
            df = self.spark.createDataFrame([], RUN_LOG_SCHEMA)
        else:
            df = self.spark.table(self.table)
        if workflow_id is not None:
            df = df.where(F.col(self.PARTITION) == F.lit(int(workflow_id)).cast("bigint"))
        if self.RECORD in df.columns and any(self._replaced(g) for g in self.generations(workflow_id).values()):
            df = df.dropDuplicates([self.PARTITION, self.RECORD])
        return df.select(*RUN_LOG_SCHEMA.fieldNames())

    def _stored(self, df: DataFrame, generation: int) -> DataFrame:
        """Columns in the order of the table."""
        names = [c for c in RUN_LOG_SCHEMA.fieldNames() if c != self.PARTITION]
        return df.select(*names, self.RECORD, self.PARTITION, F.lit(int(generation)).cast("int").alias(self.GENERATION))

    def _create(self) -> None:
        fields = [f for f in RUN_LOG_SCHEMA.fields if f.name != self.PARTITION] + [
            StructField(self.RECORD, StringType()),
            StructField(self.PARTITION, LongType()),
            StructField(self.GENERATION, IntegerType()),
        ]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({StructType(fields).toDDL()}) USING parquet "
            f"PARTITIONED BY ({self.PARTITION}, {self.GENERATION})"
        )

    def open_generation(self, workflow_id: int) -> int:
        """Where appends of a workflow go: its newest even generation."""
        return max((g for g in self.generations(workflow_id).get(int(workflow_id), []) if g % 2 == 0), default=0)

    def append(
        self,
        workflow_id: int,
        run_id: int,
        step_name: str,
        status: str,
        started: datetime | None = None,
        completed: datetime | None = None,
        details: dict | None = None,
    ) -> None:
        """Append one step record (a one-row metadata write)."""
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = (
            int(workflow_id),
            int(run_id),
            step_name,
            status,
            (started or now).replace(tzinfo=None),
            (completed or now).replace(tzinfo=None),
            json.dumps(details or {}, default=str),
        )
        df = self.spark.createDataFrame([row], RUN_LOG_SCHEMA)
        if not self._by_generation():
            writer = df.write.mode("append").format("parquet")
            parts = self._partition_columns()
            (writer.partitionBy(*parts) if parts else writer).saveAsTable(self.table)
            return
        self._create()
        df = df.withColumn(self.RECORD, F.lit(uuid.uuid4().hex))
        self._stored(df, self.open_generation(workflow_id)).write.insertInto(self.table)

    def append_frame(self, records: DataFrame) -> None:
        """Append many records (``RUN_LOG_SCHEMA``) at once, as first records of their
        workflows or beside others in generation 0."""
        if not self._by_generation():
            raise ValueError(f"{self.table} is not partitioned by {self.PARTITION} and {self.GENERATION}")
        self._create()
        self._stored(records.withColumn(self.RECORD, F.uuid()), 0).write.insertInto(self.table)

    def _alter(self, action: str, workflow_id: int, generation: int) -> None:
        spec = f"PARTITION ({self.PARTITION} = {int(workflow_id)}, {self.GENERATION} = {int(generation)})"
        self.spark.sql(f"ALTER TABLE {self.table} {action} {spec}")

    def _drop(self, workflow_id: int, generation: int) -> None:
        """Drop a generation with its files, registered or left by a writer that died."""
        self._alter("ADD IF NOT EXISTS", workflow_id, generation)
        self._alter("DROP IF EXISTS", workflow_id, generation)

    def _records(self, workflow_id: int, condition: Column) -> DataFrame:
        mine = F.col(self.PARTITION) == F.lit(int(workflow_id)).cast("bigint")
        return self.spark.table(self.table).where(mine & condition)

    def compact(self, workflow_id: int, rows_per_file: int = 1_000_000) -> int:
        """Write one workflow's records into ``ceil(rows / rows_per_file)`` files of a
        new generation; returns the number of records.  Stopped at any step,
        it loses nothing and can be run again; appends go on meanwhile."""
        if not self._by_generation():
            raise ValueError(f"{self.table} is not partitioned by {self.PARTITION} and {self.GENERATION}")
        if not self.exists():
            return 0
        self.purge(workflow_id)
        known = self.generations(workflow_id).get(int(workflow_id), [])
        if not known:
            return 0
        newest = known[-1]
        target = newest + 1 + newest % 2
        self._alter("ADD IF NOT EXISTS", workflow_id, target + 1)  # appends go there from now on
        records = self._records(workflow_id, F.col(self.GENERATION) <= F.lit(newest)).dropDuplicates([self.RECORD])
        n = records.count()
        self._drop(workflow_id, target)
        files = max(1, -(-n // int(rows_per_file)))
        self._stored(records, target).coalesce(files).write.insertInto(self.table)
        return n

    def purge(self, workflow_id: int) -> int:
        """Drop the generations that a compaction replaced; records that are only
        there are carried to the open generation first.  Returns how many were."""
        known = self.generations(workflow_id).get(int(workflow_id), [])
        old = self._replaced(known)
        if not old:
            return 0
        base = max(g for g in known if g % 2)
        kept = self._records(workflow_id, F.col(self.GENERATION) >= F.lit(base)).select(self.RECORD)
        late = self._records(workflow_id, F.col(self.GENERATION) < F.lit(base)).join(kept, self.RECORD, "left_anti")
        n = late.count()
        if n:
            self._stored(late, self.open_generation(workflow_id)).write.insertInto(self.table)
        for generation in range(old[0], base):
            self._drop(workflow_id, generation)
        return n


def next_run_id(log: DataFrame, workflows: DataFrame | None = None) -> DataFrame:
    """workflow_id, current_run_id = max(run_id) + 1, or 1000 with no runs.
    ``workflows`` (workflow_id) lists workflows that may have no runs yet."""
    agg = log.groupBy("workflow_id").agg((F.max("run_id") + 1).alias("_next"))
    if workflows is not None:
        agg = workflows.select("workflow_id").distinct().join(agg, "workflow_id", "left")
    return agg.select("workflow_id", F.coalesce(F.col("_next"), F.lit(FIRST_RUN_ID)).alias("current_run_id"))


def current_run_id(log: DataFrame) -> DataFrame:
    return log.groupBy("workflow_id").agg(F.max("run_id").alias("current_run_id"))


def latest_records(
    log: DataFrame,
    keys: Sequence[str] = ("workflow_id", "run_id", "step_name"),
    columns: Sequence[str] | None = None,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The newest record per ``keys`` (an upsert resolved at read time)."""
    cols = [c for c in (columns or log.columns) if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in cols]), order_key(order)).alias("_r")
    return log.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


@dataclass(frozen=True)
class Metric:
    """A metric read from the run details of one step."""

    step_name: str
    key: str
    alias: str
    data_type: str = "bigint"


def merge_run_metrics(
    log: DataFrame,
    metrics: Sequence[Metric],
    keys: Sequence[str] = ("workflow_id", "run_id"),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per ``keys`` with each metric taken from the newest record of
    its step: ``max_by(details, order)`` restricted to that step, all in one
    aggregation (a key's newest value wins, not the greatest text)."""
    aggs = []
    for i, m in enumerate(metrics):
        is_step = F.col("step_name") == F.lit(m.step_name)
        aggs.append(
            F.max_by(F.col("run_details"), F.when(is_step, order_key(order))).alias(f"_d{i}")
        )
    wide = log.groupBy(*keys).agg(*aggs)
    return wide.select(*keys, *[json_field(F.col(f"_d{i}"), m.key, m.data_type).alias(m.alias) for i, m in enumerate(metrics)])


def workflow_state(log: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Newest record per workflow: last_step, last_run_id, last_status,
    last_run_date; ``active`` while the newest record is a run start; and
    ``last_epoch_id``, the epoch of the newest successful load.  One
    aggregation (partial, before the shuffle)."""
    r = F.max_by(
        F.struct("step_name", "run_id", "step_completion_status", "step_completion"),
        order_key(order),
    ).alias("_r")
    epoch = F.max_by(F.col("run_details"), F.when(load_succeeded(), order_key(order))).alias("_load")
    return log.groupBy("workflow_id").agg(r, epoch).select(
        "workflow_id",
        F.col("_r.step_name").alias("last_step"),
        F.col("_r.run_id").alias("last_run_id"),
        F.col("_r.step_completion_status").alias("last_status"),
        F.col("_r.step_completion").alias("last_run_date"),
        (F.col("_r.step_completion_status") == RUNNING).alias("active"),
        json_field(F.col("_load"), "epoch_id", "bigint").alias("last_epoch_id"),
    )


def load_succeeded(load_step: str = LOAD_STEP) -> Column:
    """Per-record flag: the record is a successful load step."""
    return (F.col("step_name") == load_step) & (F.col("step_completion_status") == SUCCESS)


def status_from_flags(flag: Column) -> Column:
    """Aggregate: 'Success' when any record has ``flag``."""
    return F.when(F.max(flag.cast("int")) == 1, F.lit("Success")).otherwise(F.lit("Failed"))


def job_status(
    log: DataFrame,
    keys: Sequence[str] = ("workflow_id", "run_id"),
    load_step: str = LOAD_STEP,
) -> DataFrame:
    """w_status: 'Success' when the load step succeeded, else 'Failed'."""
    return log.groupBy(*keys).agg(status_from_flags(load_succeeded(load_step)).alias("w_status"))


def report_counts(
    metrics: DataFrame,
    read_source: str = "read_source_row_count",
    load_source: str = "load_source_row_count",
    load_target: str = "load_target_row_count",
    load_ok: str = "load_ok",
    read_ok: str = "read_ok",
) -> DataFrame:
    """Source and target counts of a run for the report: from the load step
    when it succeeded, else the read step's source count (target 0), else 0;
    ``empty`` when both are 0 and the counts were known."""
    use_load = F.coalesce(F.col(load_ok), F.lit(False))
    use_read = F.coalesce(F.col(read_ok), F.lit(False))
    src = (
        F.when(use_load, F.coalesce(F.col(load_source), F.lit(0)))
        .when(use_read, F.coalesce(F.col(read_source), F.lit(0)))
        .otherwise(F.lit(0))
    )
    tgt = F.when(use_load, F.coalesce(F.col(load_target), F.lit(0))).otherwise(F.lit(0))
    known = (use_load & F.col(load_source).isNotNull() & F.col(load_target).isNotNull()) | (
        ~use_load & use_read & F.col(read_source).isNotNull()
    )
    return metrics.select(
        "*",
        src.alias("source_row_count"),
        tgt.alias("target_row_count"),
        (known & (src == 0) & (tgt == 0)).alias("empty"),
    )


def error_details(details: dict, error: BaseException | str) -> dict:
    """Run details with the error text (its lines joined)."""
    text = str(error)
    return {**details, "error_log": " ".join(line for line in text.splitlines() if line.strip())}
