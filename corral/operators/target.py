"""Versioned target load: one table of loads, shown as ``current`` and ``history``.

Every load is one partition (``epoch_id``) of the loads table.  One published
pointer holds the epoch that is shown: ``current`` is the view of that epoch and
``history`` the view of the earlier ones, both derived from the pointer.  So
archiving a load copies no row, publishing one is a single swap, and no reader
ever finds an epoch in both views or in neither.

Parquet tables have no transaction.  The steps of a load are therefore ordered,
and each can be repeated:

1. a load that did not finish is undone (its mark names the epoch),
2. the loads table is marked with the new epoch,
3. the partition is written (above the pointer, so no view shows it),
4. the views are derived, if they are missing or the columns changed,
5. the pointer is swapped to the new epoch,
6. the mark is removed: at once, or by the caller (``finish``) after it has
   recorded the load somewhere else.

A crash at any point leaves the mark, and the next load drops that epoch's
files, registered as a partition or not.  A load without an owner counts as
finished once it is published; one with an owner once the owner says so
(``logged_epoch``).  One writer at a time.

The ledger beside the target holds the files of every load: which file made
which epoch, its time, size and rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from corral.functions.scalar import audit_time_text, text_to_timestamp
from corral.session import sql_text

EPOCH = "epoch_id"
# Audit column names as the reference stores them.
CREATE_DATE = "etl_Create_date"
UPDATE_DATE = "etl_Update_date"
QUARANTINE_SUFFIX = "_quarantine_data"
LOADS_SUFFIX = "_loads"
PUBLISHED_SUFFIX = "_published"
FILES_SUFFIX = "_loaded_files"
PROFILES_SUFFIX = "_profiles"
PENDING = "corral.pending_load"
SHOWN = "corral.shown_epoch"
DERIVED = "corral.derived_columns"
LEDGER_DDL = "workflow_id bigint, file_key string, last_modified timestamp_ntz, file_size bigint, row_count bigint"


def epoch_now() -> int:
    """Load second in UTC (independent of the host's zone)."""
    return int(time.time())


def stamp_epoch(df: DataFrame, epoch_id: int) -> DataFrame:
    return df.withColumn(EPOCH, F.lit(int(epoch_id)).cast("int"))


def stamp_audit(
    df: DataFrame,
    etl_time: str | None = None,
    create_col: str = CREATE_DATE,
    update_col: str = UPDATE_DATE,
    zoned: bool = False,
) -> DataFrame:
    """Add create and update time: one fixed time for the whole run, equal on
    every row (UTC wall clock as timestamp_ntz unless ``zoned``)."""
    spark = df.sparkSession
    ts = text_to_timestamp(etl_time or audit_time_text(), spark, zoned=zoned)
    return df.withColumn(create_col, ts).withColumn(update_col, ts)


def stamp(df: DataFrame, epoch_id: int, etl_time: str | None = None, **kw) -> DataFrame:
    return stamp_audit(stamp_epoch(df, epoch_id), etl_time, **kw)


@dataclass(frozen=True)
class TargetSettings:
    current_database: str
    history_database: str
    current_table: str
    history_table: str

    @property
    def current(self) -> str:
        return f"`{self.current_database}`.`{self.current_table}`"

    @property
    def history(self) -> str:
        return f"`{self.history_database}`.`{self.history_table}`"

    @property
    def loads(self) -> str:
        """The table behind ``current`` and ``history``."""
        return f"`{self.current_database}`.`{self.current_table}{LOADS_SUFFIX}`"

    @property
    def published(self) -> str:
        """The pointer: a view of one literal, the epoch that is shown."""
        return f"`{self.current_database}`.`{self.current_table}{PUBLISHED_SUFFIX}`"

    @property
    def files(self) -> str:
        """The ledger of loaded files."""
        return f"`{self.current_database}`.`{self.current_table}{FILES_SUFFIX}`"

    @property
    def profiles(self) -> str:
        """Mergeable profiles, one per load."""
        return f"`{self.current_database}`.`{self.current_table}{PROFILES_SUFFIX}`"

    @property
    def quarantine(self) -> str:
        return f"`{self.current_database}`.`{self.current_table}{QUARANTINE_SUFFIX}`"


@dataclass(frozen=True)
class LoadResult:
    epoch_id: int
    target_row_count: int
    target_column_count: int
    archived_epoch: int | None
    observed: dict = field(default_factory=dict)  # metrics asked for, taken in the write


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def epochs(spark: SparkSession, table: str) -> list[int]:
    """Epochs of ``table`` from the catalog's partition list: metadata only, no
    file is read."""
    out = []
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        _, _, value = r[0].partition("=")
        if value not in ("", "__HIVE_DEFAULT_PARTITION__"):
            out.append(int(value))
    return out


def drop_epoch(spark: SparkSession, table: str, epoch_id: int, column: str = EPOCH) -> None:
    """Drop one epoch with its files.  It is registered first, so that files
    committed by a load that died before registering them go as well."""
    spec = f"PARTITION ({column} = {int(epoch_id)})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec}")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")


def _fields(df: DataFrame) -> list[StructField]:
    return [StructField(f.name, f.dataType) for f in df.schema.fields]


def _create(df: DataFrame, table: str, column: str = EPOCH) -> None:
    """The empty table for the rows of ``df`` (without the epoch column)."""
    df.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({StructType(_fields(df)).toDDL()}, {column} INT) USING parquet "
        f"OPTIONS (compression 'snappy') PARTITIONED BY ({column})"
    )


def write_epoch(df: DataFrame, table: str, epoch_id: int, column: str = EPOCH) -> None:
    """Write ``df`` (without the epoch ``column``) as the partition of ``epoch_id``, in
    place of what that partition holds.

    The table is created before any file is written, so a crash never leaves
    files that block the next creation.  Columns match by name: a new column is
    added to the table (null in earlier epochs), a missing one is null.  The
    epoch is a constant right under the write, so no row is sorted by it.
    """
    spark = df.sparkSession
    _create(df, table, column)
    fields = _fields(df)
    have = {f.name.lower() for f in spark.table(table).schema.fields}
    if new := [f for f in fields if f.name.lower() not in have]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({StructType(new).toDDL()})")
    drop_epoch(spark, table, epoch_id, column)
    given = {f.name.lower(): f.name for f in fields}
    columns = [
        F.col(_quoted(given[f.name.lower()])) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema.fields
        if f.name != column
    ]
    df.select(*columns, F.lit(int(epoch_id)).cast("int").alias(column)).write.insertInto(table)
    # an empty load is a partition too
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({column} = {int(epoch_id)})")


class TargetTables:
    def __init__(self, spark: SparkSession, settings: TargetSettings):
        self.spark = spark
        self.s = settings

    def _exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _property(self, name: str, key: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        return next((r["value"] for r in rows if r["key"] == key), None)

    def current_exists(self) -> bool:
        return self._exists(self.s.current)

    def history_exists(self) -> bool:
        return self._exists(self.s.history)

    def current_epoch(self) -> int | None:
        """Epoch that ``current`` shows."""
        for name in (self.s.published, self.s.current):  # the second: a target of an earlier layout
            if self._exists(name):
                shown = self._property(name, SHOWN)
                return int(shown) if shown else None
        return None

    def history_has_epoch(self, epoch_id: int) -> bool:
        shown = self.current_epoch()
        return (
            self.history_exists()
            and shown is not None
            and int(epoch_id) < shown
            and int(epoch_id) in epochs(self.spark, self.s.loads)
        )

    def publish(self, epoch_id: int | None) -> None:
        """Swap the pointer: one metadata change moves both views."""
        literal = "CAST(NULL AS INT)" if epoch_id is None else str(int(epoch_id))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.s.published} "
            f"TBLPROPERTIES ({sql_text(SHOWN)} = {sql_text('' if epoch_id is None else literal)}) AS SELECT {literal} AS {EPOCH}"
        )

    def derive_views(self, history: bool = True) -> None:
        """Define ``current`` and ``history`` by the pointer, where they are missing
        or the loads table has other columns than they show."""
        if not self._exists(self.s.published):
            self.publish(self.current_epoch())
        columns = [f.name for f in self.spark.table(self.s.loads).schema.fields]
        listed, mark = ", ".join(map(_quoted, columns)), ",".join(columns)
        for view, compare, wanted in ((self.s.current, "=", True), (self.s.history, "<", history)):
            exists = self._exists(view)
            if (wanted or exists) and not (exists and self._property(view, DERIVED) == mark):
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({sql_text(DERIVED)} = {sql_text(mark)}) AS SELECT {listed} "
                    f"FROM {self.s.loads} WHERE {EPOCH} {compare} (SELECT {EPOCH} FROM {self.s.published})"
                )

    def _write_load(self, staged: DataFrame, epoch_id: int, etl_time: str | None, metrics: Sequence[Column]) -> dict:
        """Stamp ``staged`` and write it as the partition of ``epoch_id``; returns
        the written ``rows`` and ``metrics``, observed during the write itself."""
        obs = Observation()  # a name of its own: a retry may observe the same frame again
        counted = staged.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
        write_epoch(stamp_audit(counted, etl_time), self.s.loads, epoch_id)
        return obs.get

    def recover(self, owner: str = "", logged_epoch: int | None = None) -> int | None:
        """Undo a load that did not finish: where it was already shown, the pointer,
        then its partition, its quarantine rows and its files' records.  Returns the
        epoch undone."""
        if not self._exists(self.s.loads):
            return None
        mark = self._property(self.s.loads, PENDING)
        if mark is None:
            return None
        epoch, _, by = mark.partition(":")
        pending = int(epoch)
        if by and by != owner:
            raise RuntimeError(f"load {pending} of workflow {by} into {self.s.current} is not finished; run that first")
        done = (logged_epoch is not None and pending <= logged_epoch) if by else self.current_epoch() == pending
        if not done:
            if self.current_epoch() == pending:
                earlier = sorted(e for e in epochs(self.spark, self.s.loads) if e != pending)
                if earlier:
                    self.publish(earlier[-1])
                else:
                    self.spark.sql(f"DROP VIEW IF EXISTS {self.s.current}")
                    self.spark.sql(f"DROP VIEW IF EXISTS {self.s.published}")
            for table in (self.s.loads, self.s.quarantine, self.s.files, self.s.profiles):
                if self._exists(table):
                    drop_epoch(self.spark, table, pending)
        self.finish()
        return None if done else pending

    def finish(self) -> None:
        """Remove the mark of the load: it is recorded, and stays."""
        self.spark.sql(f"ALTER TABLE {self.s.loads} UNSET TBLPROPERTIES IF EXISTS ({sql_text(PENDING)})")

    def load(
        self,
        staged: DataFrame,
        epoch_id: int | None = None,
        etl_time: str | None = None,
        previous_epoch: int | None = None,
        owner: str = "",
        files: DataFrame | None = None,
        metrics: Sequence[Column] = (),
    ) -> LoadResult:
        """Load ``staged`` as the new ``current``; the load before moves to
        ``history``.  ``previous_epoch`` is the last load its caller has
        recorded.  With an ``owner`` the load is undone by the owner's next one
        unless ``finish`` follows.  ``files`` (``LEDGER_DDL``) are recorded with the
        load; ``metrics`` are more named aggregates to observe in the write."""
        epoch_id = epoch_now() if epoch_id is None else int(epoch_id)
        self.recover(owner, previous_epoch)
        prev = self.current_epoch()
        newest = max((e for e in (prev, previous_epoch) if e is not None), default=None)
        if newest is not None and epoch_id <= newest:
            raise ValueError(f"epoch {epoch_id} is not above the current epoch {newest}")
        stamped = stamp_audit(staged, etl_time)
        _create(stamped, self.s.loads)
        self.spark.sql(
            f"ALTER TABLE {self.s.loads} SET TBLPROPERTIES ({sql_text(PENDING)} = {sql_text(f'{epoch_id}:{owner}')})"
        )
        observed = self._write_load(staged, epoch_id, etl_time, metrics)
        if files is not None:
            write_epoch(files, self.s.files, epoch_id)
        self.derive_views(history=prev is not None)
        self.publish(epoch_id)
        if not owner:
            self.finish()
        return LoadResult(epoch_id, int(observed["rows"]), len(stamped.columns) + 1, prev, observed)

    def write_quarantine(
        self,
        quarantined: DataFrame,
        epoch_id: int,
        etl_time: str | None = None,
        mode: str = "overwrite",
    ) -> None:
        """Stamped quarantine rows, partitioned by epoch; written even when
        empty.  ``mode='append'`` keeps earlier runs' quarantine; otherwise
        earlier epochs are dropped after the write."""
        write_epoch(stamp_audit(quarantined, etl_time), self.s.quarantine, epoch_id)
        if mode == "overwrite":
            for epoch in epochs(self.spark, self.s.quarantine):
                if epoch != int(epoch_id):
                    drop_epoch(self.spark, self.s.quarantine, epoch)

    def loaded_files(self) -> DataFrame:
        """The ledger: (workflow_id, file_key, last_modified in UTC, file_size, row_count,
        epoch_id); empty before the first load with files."""
        if not self._exists(self.s.files):
            return self.spark.createDataFrame([], f"{LEDGER_DDL}, {EPOCH} int")
        return self.spark.table(self.s.files)

    def write_profile(self, sketches: DataFrame, epoch_id: int) -> None:
        """Keep the mergeable profile of a load (``profile.SKETCH_SCHEMA``)."""
        write_epoch(sketches, self.s.profiles, epoch_id)

    def profiles_frame(self) -> DataFrame:
        return self.spark.table(self.s.profiles)

    def files_of(self, epoch_id: int) -> DataFrame:
        """The files that made an epoch; reads that partition only."""
        return self.loaded_files().where(F.col(EPOCH) == F.lit(int(epoch_id)))

    def current_frame(self) -> DataFrame:
        return self.spark.table(self.s.current)

    def history_frame(self) -> DataFrame:
        return self.spark.table(self.s.history)

    def refresh(self) -> None:
        """Refresh cached metadata and re-discover partitions, for tables
        also written by outside writers."""
        if self._exists(self.s.loads):
            self.spark.sql(f"REFRESH TABLE {self.s.loads}")
            self.spark.sql(f"MSCK REPAIR TABLE {self.s.loads}")
