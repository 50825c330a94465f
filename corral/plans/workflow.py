"""One ingestion workflow run: read → transform → validate → profile → load → report.

Each step is a Spark job over staged tables of the run; each appends a record
to the run log.  Differences from a straight re-run of the original steps:

- the file watermark is stored with the successful load (the last step), so
  a failed run never skips its files;
- the validation is written once; the good-row, quarantine and fail-job
  counts and the per-rule summary come from ``observe`` on that one write;
- flags decide which steps run; a step that is off is skipped cleanly;
- the overall DQ status says what happened (fail-job rows found or not);
- row counts, increment marks and mergeable profiles come from ``observe`` on
  the writes, never from a second pass;
- every loaded file is in the target's ledger, so files that share the
  watermark's time are each read once;
- the stage belongs to this run alone and is dropped when the run ends, failed
  or not.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corral.functions.rules import Rule
from corral.functions.scalar import audit_time_text, clock_text, table_name_from_location, utc_wall_clock
from corral.operators import counts as K
from corral.operators import quality as Q
from corral.operators import runlog as M
from corral.operators import increments as I
from corral.operators.increments import IncrementSetting
from corral.operators.profile import (
    merge_profiles,
    profile_columns,
    profile_report,
    profile_with_observed,
    simple_metrics,
    sketch_metrics,
    sketch_rows,
)
from corral.operators.target import TargetSettings, TargetTables, drop_epoch, epoch_now, epochs, write_epoch
from corral.operators.transform import Step, apply_transformations
from corral.plans import reports as RP
from corral.sources import delimited as CSV
from corral.sources import discovery as D
from corral.sources.database import TableSource
from corral.sources.stage import DATA_PROFILE, DQ, DQ_VALIDATION, FILES, INTERMEDIATE, RAW, Stage
from corral.streaming.file_stream import file_stream

# Columns of the raw stage that tell each row's file, as the scan gives them.
SOURCE_FILE, SOURCE_TIME, SOURCE_SIZE = FILE_COLUMNS = ("__source_file", "__source_time", "__source_size")
FILE_ROWS = "file_rows"
BATCH = "batch_id"
STAGE_REPORTS = ("profile",)


@dataclass
class SourceSettings:
    """Where and how source files are read."""

    root: str  # base folder or bucket URI that holds the keys
    file_location: str  # key pattern below root, e.g. "landing/orders_*.csv"
    schema: StructType | str
    columns: Sequence[str] | None = None
    first_row_is_header: bool = True
    file_encoding: str = "UTF-8"
    is_collation: bool = False  # True: all new files; False: latest file only
    allow_empty_file: bool = False
    delimiter: str = CSV.DELIMITER
    timestamp_format: str = CSV.TIMESTAMP_FORMAT
    # keep the raw text of rows that do not parse (check it with rules.parsed);
    # the column goes to quarantine but never to the target
    corrupt_column: str | None = None

    @property
    def name(self) -> str:
        return table_name_from_location(self.file_location)


@dataclass
class WorkflowSettings:
    workflow_id: int
    workflow_name: str
    source: SourceSettings | TableSource
    target: TargetSettings
    run_log_table: str
    transformations: Sequence[Step] = ()
    rules: Sequence[Rule] = ()
    rule_settings: Sequence[dict] = ()  # stored per-rule flags: failJob, ticket
    profile: bool = False
    # exact distinct counts in the profile; False uses HyperLogLog++ (no
    # expansion and no shuffle of every distinct value), for very large inputs
    profile_exact_distinct: bool = True
    # keep one mergeable profile per load, taken in the load's own write
    profile_sketches: bool = False
    table_checks: Sequence[dict] = ()  # {subStrategy: [...], email, threshold_value}
    increments: Sequence[IncrementSetting] = ()
    source_load_type: str = "full"  # "increment" tracks high-water marks
    undecided_increments: str = I.READ_UNDECIDED  # rows with a null key and no key above its mark: read or leave
    refresh_target: bool = False  # partitions of the target are also written from outside
    quarantine_mode: str = "overwrite"  # or "append" to keep earlier runs
    report_zone: str = "UTC"
    schedule_start_time: datetime | None = None  # UTC; shown in the job report
    keep_stage: bool = False

    @property
    def table_name(self) -> str:
        return self.source.name


@dataclass
class RunResult:
    run_id: int
    epoch_id: int | None
    metrics: dict
    reports: dict[str, DataFrame] = field(default_factory=dict)
    dq_status: str | None = None


class IngestionRun:
    def __init__(self, spark: SparkSession, settings: WorkflowSettings):
        self.spark = spark
        self.s = settings
        self.log = M.RunLog(spark, settings.run_log_table)
        self.targets = TargetTables(spark, settings.target)
        self.metrics: dict = {}
        self._last_load: dict | None = None
        self._profile_observed: tuple[list[str], dict] | None = None

    # -- state from the run log (one small aggregate row each) ---------------
    def _workflow_log(self) -> DataFrame:
        return self.log.frame(self.s.workflow_id)

    def state(self, stream_checkpoint: str | None = None) -> tuple[int, dict, int]:
        """Next run id, the run details of the newest successful load, and the
        last micro-batch of ``stream_checkpoint`` that was loaded (-1: none),
        from one aggregation over this workflow's log records."""
        loaded = M.load_succeeded()
        same_stream = loaded & (F.get_json_object("run_details", "$.stream_checkpoint") == F.lit(stream_checkpoint))
        batch_id = F.get_json_object("run_details", "$.stream_batch_id").cast("bigint")
        row = (
            self._workflow_log()
            .groupBy("workflow_id")
            .agg(
                (F.max("run_id") + 1).alias("next_run_id"),
                F.max_by(F.col("run_details"), F.when(loaded, M.order_key(M.ORDER))).alias("load"),
                F.max(F.when(same_stream, batch_id)).alias("last_batch"),
            )
            .first()
        )
        if row is None:
            return M.FIRST_RUN_ID, {}, -1
        details = json.loads(row["load"]) if row["load"] else {}
        return int(row["next_run_id"]), details, -1 if row["last_batch"] is None else int(row["last_batch"])

    def next_run_id(self) -> int:
        return self.state()[0]

    def last_load_details(self) -> dict:
        """Run details of the newest successful load of this workflow."""
        return self.state()[1]

    # -- step bookkeeping ----------------------------------------------------
    def _step(self, run_id: int, name: str, fn):
        """Run one step: its Spark jobs carry the workflow, run and step in
        their description (event log, job listings), and its outcome is
        appended to the run log."""
        started = datetime.now(timezone.utc)
        sc = self.spark.sparkContext
        sc.setJobDescription(f"{self.s.workflow_name} run {run_id}: {name}")
        try:
            out = fn()
        except Exception as e:
            details = M.error_details(self.metrics, e)
            self.log.append(self.s.workflow_id, run_id, name, M.FAILED, started, None, details)
            raise
        finally:
            sc.setJobDescription(None)
        self.log.append(self.s.workflow_id, run_id, name, M.SUCCESS, started, None, self.metrics)
        return out

    # -- steps ----------------------------------------------------------------
    def read_from_source(self, stage: Stage, watermark: str | None) -> None:
        if isinstance(self.s.source, TableSource):
            self._stage_raw(stage, self.source_rows(), ())
            self.metrics.update(source_file_path=self.s.source.table)
        else:
            self._read_files(stage, watermark)
        self._check_not_empty()

    def source_rows(self) -> DataFrame:
        """Rows of a table source above the stored marks, as one filter on its scan."""
        df = self.s.source.frame(self.spark)
        increments = self._increments()
        _check_keys(increments, df)
        return I.incremental_filter(df, increments, self.s.undecided_increments)

    def _read_files(self, stage: Stage, watermark: str | None) -> None:
        src = self.s.source
        # only the pattern's folder is listed and scanned (keys stay relative
        # to the root)
        folder = D.pattern_folder(src.file_location)
        listing = D.list_files(self.spark, src.root, with_root=True, folder=folder, with_size=True)
        ledger = self._ledger()
        stage.save(FILES, D.in_utc(D.choose_files(listing, src.file_location, watermark, src.is_collation, ledger)))
        files = stage.load(FILES)
        chosen = D.selection_of(files, src.file_location, watermark, src.is_collation)
        # the folder is scanned with the choice as a filter on the scan's file
        # metadata: Spark skips the other files before reading, and no list
        # of paths is built on the driver
        scan = CSV.read_delimited(
            self.spark,
            D.join_key(src.root, folder),
            src.schema,
            header=src.first_row_is_header,
            delimiter=src.delimiter,
            encoding=src.file_encoding,
            timestamp_format=src.timestamp_format,
            corrupt_column=src.corrupt_column,
            recursive=True,
        )
        columns = self._source_columns(scan)
        df = scan.where(chosen.scan_condition(src.root, self.spark)).select(*columns, *_file_columns())
        if chosen.late and chosen.latest is None:
            late = scan.where(chosen.at_mark(self.spark)).select(*columns, *_file_columns())
            names = files.where(F.col("last_modified") == F.lit(watermark).cast("timestamp_ntz")).select(F.col("path").alias("__late"))
            df = df.unionByName(late.join(names, self._file_key(F.col(SOURCE_FILE)) == F.col("__late"), "left_semi"))
        self._stage_raw(stage, df, FILE_COLUMNS)
        stage.save(FILE_ROWS, self._file_rows(stage))
        self.metrics.update(
            source_file_path=chosen.described,
            source_file_count=chosen.file_count,
            source_file_arrival=chosen.watermark,
            last_load_file_detail=chosen.watermark,
        )

    def _source_columns(self, scan: DataFrame) -> list[str]:
        corrupt = self.s.source.corrupt_column
        columns = list(self.s.source.columns or [c for c in scan.columns if c != corrupt])
        return columns + [corrupt] if corrupt and corrupt not in columns else columns

    def _ledger(self) -> DataFrame | None:
        """Files of this workflow's recorded loads; None if the last one is not in the
        ledger (there is none yet, or it was made without): then only times above
        the watermark are new."""
        last = (self._last_load or {}).get("epoch_id")
        if last is None:
            return None
        mine = self.targets.loaded_files().where(F.col("workflow_id") == F.lit(int(self.s.workflow_id)).cast("bigint"))
        if mine.where(F.col("epoch_id") == F.lit(int(last))).isEmpty():
            return None
        return mine.where(F.col("epoch_id") <= F.lit(int(last)))

    def _file_key(self, path: Column) -> Column:
        """A file's key below the root, from its path as a scan gives it."""
        return D.relative_key(D.decode_uri_text(path), self.s.source.root)

    def _file_rows(self, stage: Stage) -> DataFrame:
        """(file_key, last_modified, file_size, row_count) of every file read, before any
        filter: the files that were chosen (one without rows counts 0) and those
        that rows came from.  Reads three columns of the raw stage."""
        counted = (
            stage.load(RAW)
            .groupBy(*FILE_COLUMNS)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                self._file_key(F.col(SOURCE_FILE)).alias("file_key"),
                utc_wall_clock(F.col(SOURCE_TIME), self.spark).alias("last_modified"),
                F.col(SOURCE_SIZE).alias("file_size"),
                "row_count",
            )
        )
        if stage.exists(FILES):
            chosen = stage.load(FILES).select(
                F.col("path").alias("file_key"), "last_modified", "file_size", F.lit(0).cast("bigint").alias("row_count")
            )
            counted = counted.unionByName(chosen)
        return counted.groupBy("file_key", "last_modified", "file_size").agg(F.sum("row_count").alias("row_count"))

    def _stage_raw(self, stage: Stage, df: DataFrame, file_columns: Sequence[str]) -> None:
        """Write what was read; rows, rows above the stored marks and rows that no key
        decides are counted in that write."""
        columns = [c for c in df.columns if c not in file_columns and c != self.s.source.corrupt_column]
        increments = self._increments()
        _check_keys(increments, df)
        edge = I.frontier(increments, df.schema)
        newer, undecided = edge if edge is not None else (F.lit(True), F.lit(False))
        obs = Observation()
        stage.save(
            RAW,
            df.observe(
                obs,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(newer).alias("newer"),
                F.count_if(undecided).alias("undecided"),
            ),
        )
        got = obs.get
        read = self.s.undecided_increments == I.READ_UNDECIDED
        self.metrics.update(
            source_row_count=int(got["newer"]) + (int(got["undecided"]) if read else 0),
            source_column_count=len(columns),
        )
        if edge is not None:
            self.metrics.update(source_rows_scanned=int(got["rows"]), increment_undecided_rows=int(got["undecided"]))

    def _check_not_empty(self) -> None:
        CSV.enforce_empty_policy(self.metrics["source_row_count"], self.s.source.allow_empty_file)

    def _increments(self) -> list:
        """The configured keys with the marks of the last successful load."""
        if self.s.source_load_type != "increment":
            return []
        last_load = self._last_load if self._last_load is not None else self.last_load_details()
        return I.with_stored_marks(self.s.increments, last_load.get("increment_data"))

    def _raw(self, stage: Stage) -> DataFrame:
        """The rows that go on: those above the marks, without their file."""
        raw = stage.load(RAW).drop(*FILE_COLUMNS)
        return I.incremental_filter(raw, self._increments(), self.s.undecided_increments)

    def transformation_step(self, stage: Stage) -> None:
        out = apply_transformations(self._raw(stage), self.s.transformations)
        stage.save(INTERMEDIATE, out)
        self.metrics["transformation_column_count"] = len(out.columns)

    def _input(self, stage: Stage) -> DataFrame:
        return stage.load(INTERMEDIATE) if stage.exists(INTERMEDIATE) else self._raw(stage)

    def dq_check(self, stage: Stage) -> Q.MaterializedValidation:
        data = self._input(stage)
        v = Q.validate(data, self.s.rules, keep=lambda df, name: stage.load(_saved(stage, name, df)))
        # the profile's rows, null counts, min and max are taken in this
        # pass too, so the profile step reads the input only for distinct counts
        extra = simple_metrics(data.columns) if self.s.profile else []
        mv = v.materialize(stage=stage, kind=DQ, extra_metrics=extra)
        if self.s.profile:
            self._profile_observed = (list(data.columns), mv.metrics)
        stage.save(DQ_VALIDATION, mv.summary)
        self.metrics.update(
            dq_row_count=mv.good_count,
            dq_quarantined_count=mv.quarantined_count,
            dq_failjob_count=mv.failjob_count,
        )
        return mv

    def _table_checks(self, stage: Stage, target_rows: int) -> dict:
        """Count checks from counts already observed (no extra pass): source
        rows read against rows loaded, with or without row rules."""
        names = {n.lower() for c in self.s.table_checks for n in c.get("subStrategy", [])}
        threshold = next(
            (float(c["threshold_value"]) for c in self.s.table_checks if c.get("threshold_value") is not None), 0.0
        )
        s, t = int(self.metrics["source_row_count"]), int(target_rows)
        out = {}
        if K.TABLE_COUNT in names:
            out[K.TABLE_COUNT] = s == t
        if K.THRESHOLD_COUNT in names:
            out[K.THRESHOLD_COUNT] = abs(s - t) * 100 <= threshold * s
        control = next((c["control_file"] for c in self.s.table_checks if c.get("control_file")), None)
        if K.CONTROL_FILE_COUNT in names and control:
            out[K.CONTROL_FILE_COUNT] = self._control_file_check(stage, control)
        return out

    def _control_file_check(self, stage: Stage, control_path: str) -> bool:
        """Expected rows per source file (a delimited control file of
        file_name|expected_count) against the rows read from each file, before any
        filter.  A file is named by its key below the root or below the pattern's
        folder; one that is not listed fails."""
        folder = D.pattern_folder(self.s.source.file_location)
        control = CSV.read_delimited(
            self.spark, control_path, "file_name string, expected_count bigint", delimiter=self.s.source.delimiter
        )
        name, prefix = F.col("file_name"), f"{folder}/" if folder else ""
        key = F.when(name.startswith(prefix), name).otherwise(F.concat(F.lit(prefix), name))
        actual = stage.load(FILE_ROWS).groupBy("file_key").agg(F.sum("row_count").alias("actual_count"))
        result = K.reconcile_files(control.select(key.alias("file_key"), "expected_count"), actual)
        return result.where(~F.col(K.CONTROL_FILE_COUNT)).isEmpty()

    def data_profiling(self, stage: Stage) -> None:
        data = self._input(stage)
        observed = self._profile_observed
        exact = self.s.profile_exact_distinct
        if observed is not None and observed[0] == list(data.columns):
            profile = profile_with_observed(data, observed[1], exact_distinct=exact)
        else:
            profile = profile_columns(data, exact_distinct=exact)
        stage.save(DATA_PROFILE, profile)

    def write_to_target(self, stage: Stage, mv: Q.MaterializedValidation | None, epoch_id: int, etl_time: str) -> None:
        last_load = self._last_load if self._last_load is not None else self.last_load_details()
        previous, owner = last_load.get("epoch_id"), str(self.s.workflow_id)
        self.targets.recover(owner, previous)
        if mv is not None:
            quarantined = Q.quarantine_rows(mv.erroneous_data)
            if mv.failjob_count:
                self.targets.write_quarantine(quarantined, epoch_id, etl_time, self.s.quarantine_mode)
                raise Q.DataQualityStop(
                    f"Data not loaded to target: {mv.failjob_count} rows have action failjob"
                )
            source = mv.correct_data
        else:
            quarantined = None
            source = self._input(stage)
        corrupt = self.s.source.corrupt_column
        if corrupt and corrupt in source.columns:
            source = source.drop(corrupt)
        # before the load: a key column that a transformation dropped stops
        # the run while the target is still as it was
        increments = self._increments()
        _check_keys(increments, source)
        metrics = I.mark_metrics(increments, source.schema)
        if self.s.profile_sketches:
            metrics += sketch_metrics(source.schema)
        result = self.targets.load(
            source,
            epoch_id=epoch_id,
            etl_time=etl_time,
            previous_epoch=previous,
            owner=owner,
            files=self._loaded_files(stage),
            metrics=metrics,
        )
        if quarantined is not None:
            self.targets.write_quarantine(quarantined, epoch_id, etl_time, self.s.quarantine_mode)
        if self.s.profile_sketches:
            self.targets.write_profile(sketch_rows(self.spark, source.schema, result.observed), epoch_id)
        if self.s.refresh_target:
            self.targets.refresh()
        self.metrics.update(
            target_column_count=result.target_column_count,
            target_row_count=result.target_row_count,
            epoch_id=epoch_id,
        )
        if increments:
            self.metrics["increment_data"] = [m.__dict__ for m in I.observed_marks(increments, source.schema, result.observed)]
        if self.s.table_checks:
            self.metrics["table_checks"] = self._table_checks(stage, result.target_row_count)

    def _loaded_files(self, stage: Stage) -> DataFrame | None:
        """Rows of the ledger for this load, as ``target.LEDGER_DDL`` has them."""
        if not stage.exists(FILE_ROWS):
            return None
        return stage.load(FILE_ROWS).select(
            F.lit(int(self.s.workflow_id)).cast("bigint").alias("workflow_id"), "file_key", "last_modified", "file_size", "row_count"
        )

    def email_step(self, stage: Stage, run_id: int, mv: Q.MaterializedValidation | None) -> dict[str, DataFrame]:
        """The report tables of the run (the mail itself is not built)."""
        reports: dict[str, DataFrame] = {}
        log = self.log.frame(self.s.workflow_id).where(F.col("run_id") == int(run_id))
        reports["job_status"] = run_report(log).select(
            "workflow_id",
            "run_id",
            F.lit(self.s.workflow_name).alias("job_name"),
            F.lit(clock_text(self.s.schedule_start_time, self.s.report_zone)).cast("string").alias("schedule_time"),
            F.lit(clock_text(datetime.now(timezone.utc), self.s.report_zone)).alias("current_time"),
            "w_status",
            "source_row_count",
            "target_row_count",
            "empty",
        )
        if mv is not None:
            reports["dq_counts"] = self.spark.createDataFrame(
                [(mv.row_count, mv.good_count, mv.quarantined_count)],
                "source_count bigint, target_count bigint, quarantined_count bigint",
            )
            reports["dq_status"] = self.spark.createDataFrame(
                [
                    (
                        self.s.table_name,
                        self.s.target.quarantine.replace("`", ""),
                        mv.status,
                        Q.ticket_flag(self.s.rule_settings),
                        "Yes" if mv.failjob_count else "No",
                    )
                ],
                "table_name string, quarantine_table string, dq_status string, ticket string, fail_job string",
            )
            reports["dq_summary"] = mv.summary  # every rule, in rule order
        if stage.exists(DATA_PROFILE) and not stage.load(DATA_PROFILE).isEmpty():
            reports["profile"] = profile_report(stage.load(DATA_PROFILE))
        if self.s.profile_sketches:
            reports["profile_all_loads"] = merge_profiles(self.targets.profiles_frame())
        if self.s.table_checks and "table_checks" in self.metrics:
            results = self.spark.createDataFrame(
                list(self.metrics["table_checks"].items()), "check_name string, passed boolean"
            )
            reports["count_alerts"] = RP.count_alerts(RP.check_settings_frame(self.spark, self.s.table_checks), results)
        return reports

    # -- the whole run ----------------------------------------------------------
    def run(self, epoch_id: int | None = None, etl_time: str | None = None) -> RunResult:
        """One batch run over the files chosen by listing, watermark and ledger, or
        over the new rows of a table source."""
        run_id, last_load, _ = self.state()
        watermark = last_load.get("last_load_file_detail")
        self._last_load = last_load
        return self._staged_run(run_id, {}, lambda stage: self.read_from_source(stage, watermark), epoch_id, etl_time)

    def _staged_run(
        self, run_id: int, metrics: dict, read: Callable[[Stage], None], epoch_id: int | None, etl_time: str | None
    ) -> RunResult:
        """All steps over a stage of this run's own.  The stage goes when the run ends,
        failed or not (unless ``keep_stage``)."""
        self.metrics = metrics
        self.log.append(self.s.workflow_id, run_id, M.RUN_START, M.RUNNING)
        stage = Stage(self.spark, f"{self.s.workflow_id}_{self.s.workflow_name}", run_id)
        try:
            self._step(run_id, M.READ_STEP, lambda: read(stage))
            return self._after_read(run_id, stage, epoch_id, etl_time)
        finally:
            if not self.s.keep_stage:
                stage.drop()

    def _after_read(self, run_id: int, stage: Stage, epoch_id: int | None, etl_time: str | None) -> RunResult:
        previous = self._last_load.get("epoch_id") if self._last_load else None
        epoch_id = next_epoch(previous, epoch_id)
        etl_time = etl_time or audit_time_text()
        self._profile_observed = None
        if self.s.transformations:
            self._step(run_id, M.TRANSFORM_STEP, lambda: self.transformation_step(stage))
        mv = None
        if self.s.rules:
            mv = self._step(run_id, M.DQ_STEP, lambda: self.dq_check(stage))
        if self.s.profile:
            self._step(run_id, M.PROFILE_STEP, lambda: self.data_profiling(stage))
        self._step(run_id, M.LOAD_STEP, lambda: self.write_to_target(stage, mv, epoch_id, etl_time))
        self.targets.finish()  # the load is in the run log now
        reports = self._step(run_id, M.REPORT_STEP, lambda: self.email_step(stage, run_id, mv))
        if not self.s.keep_stage:
            # Reports read from the stage (one row per rule or column) are
            # checkpointed to the shared folder before the run's staged data
            # is deleted; the others are local rows or read the run log,
            # which stays.
            reports = {k: _detach(v) if k in STAGE_REPORTS else v for k, v in reports.items()}
        return RunResult(run_id, epoch_id, dict(self.metrics), reports, mv.status if mv is not None else None)

    # -- streaming: Spark finds the new files ----------------------------------
    def stream_source(self, max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
        """The source as a file stream: the folder of the pattern, filtered
        by the pattern's file-name part.  The stream's checkpoint remembers
        every file read, so no file list or watermark passes through the
        driver."""
        src = self.s.source
        folder, _, name_glob = src.file_location.rpartition("/")
        if "*" in folder:
            raise ValueError("streaming needs a fixed folder; '*' is allowed in the file name only")
        # as in the batch run, only '*' is a wildcard and a pattern without one is a prefix
        name_glob = re.sub(r"([?\[\]{}\\])", r"\\\1", name_glob) + ("" if "*" in name_glob else "*")
        stream = file_stream(
            self.spark,
            f"{src.root.rstrip('/')}/{folder}" if folder else src.root,
            src.schema,
            header=src.first_row_is_header,
            delimiter=src.delimiter,
            encoding=src.file_encoding,
            timestamp_format=src.timestamp_format,
            max_files_per_trigger=max_files_per_trigger,
            path_glob=name_glob or None,
            corrupt_column=src.corrupt_column,
            archive_dir=archive_dir,
        )
        return stream.select(*self._source_columns(stream), *_file_columns())

    def landed_table(self, checkpoint_location: str) -> str:
        """The table that holds a stream's landed batches until they are loaded."""
        token = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:12]
        t = self.s.target
        return f"`{t.current_database}`.`{t.current_table}_landed_{token}`"

    def run_stream(
        self,
        checkpoint_location: str,
        max_files_per_trigger: int | None = None,
        etl_time: str | None = None,
        archive_dir: str | None = None,
    ) -> list[RunResult]:
        """Land every new file through the stream (``availableNow``), then
        transform, validate and load all landed rows once: one run and one
        epoch, whatever ``max_files_per_trigger`` is.

        Micro-batch ``n`` is one partition of the landed table, written anew when
        Spark replays it.  The run log keeps the last batch of each load, so
        batches of a run that failed (also by ``failjob``) are loaded with the
        next run; loaded ones are never read again and are dropped once the load
        is in the run log.  ``archive_dir`` moves the source files of finished
        batches away.  Returns the run, or nothing when no batch is left to load."""
        checkpoint = checkpoint_location.rstrip("/")
        landed = self.landed_table(checkpoint)
        stream = self.stream_source(max_files_per_trigger, archive_dir)

        def land(batch: DataFrame, batch_id: int) -> None:
            write_epoch(batch, landed, batch_id, BATCH)

        q = (
            stream.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        if q.exception():
            raise q.exception()

        run_id, self._last_load, loaded = self.state(stream_checkpoint=checkpoint)
        if not self.spark.catalog.tableExists(landed):
            return []
        batches = epochs(self.spark, landed)
        self._drop_landed(landed, loaded)  # also those whose run died before it could
        if max(batches, default=-1) <= loaded:
            return []
        last = max(batches)
        rows = self.spark.table(landed).where(F.col(BATCH) > loaded).drop(BATCH)
        metrics = {"stream_checkpoint": checkpoint, "stream_batch_id": last}
        result = self._staged_run(run_id, metrics, lambda stage: self._read_landed(stage, rows), None, etl_time)
        self._drop_landed(landed, last)
        return [result]

    def _drop_landed(self, landed: str, loaded: int) -> None:
        for batch in epochs(self.spark, landed):
            if batch <= loaded:
                drop_epoch(self.spark, landed, batch, BATCH)

    def _read_landed(self, stage: Stage, rows: DataFrame) -> None:
        self._stage_raw(stage, rows, FILE_COLUMNS)
        stage.save(FILE_ROWS, self._file_rows(stage))
        files = stage.load(FILE_ROWS).agg(
            F.count(F.lit(1)).alias("n"), F.date_format(F.max("last_modified"), D.WATERMARK_FORMAT).alias("newest")
        ).first()
        self.metrics.update(
            source_file_path=self.s.source.file_location,
            source_file_count=int(files["n"]),
            source_file_arrival=files["newest"],
            last_load_file_detail=files["newest"],
        )
        self._check_not_empty()


def _saved(stage: Stage, name: str, df: DataFrame) -> str:
    stage.save(name, df)
    return name


def _file_columns() -> list[Column]:
    """Path, time and size of each row's file, from a file scan's metadata."""
    names = ("file_path", "file_modification_time", "file_size")
    return [F.col(f"_metadata.{n}").alias(c) for n, c in zip(names, FILE_COLUMNS)]


def _check_keys(increments, df: DataFrame) -> None:
    missing = [s.key_column for s in increments if s.key_column not in df.columns]
    if missing:
        raise ValueError(f"increment key columns are not in the data: {', '.join(missing)}")


def next_epoch(previous: int | None, requested: int | None = None) -> int:
    """Epoch of a new load: the requested one, or the current UTC second;
    always above the previous load's epoch (the archive relies on epochs
    being unique and increasing, also when loads come faster than one per
    second)."""
    if requested is not None:
        if previous is not None and int(requested) <= int(previous):
            raise ValueError(f"epoch {requested} is not above the previous epoch {previous}")
        return int(requested)
    now = epoch_now()
    return now if previous is None else max(now, int(previous) + 1)


def _detach(df: DataFrame) -> DataFrame:
    """Cut a report table loose from the run's stage before the stage is
    dropped: an eager checkpoint into the shared checkpoint folder, so no
    rows pass through the driver."""
    return df.checkpoint(eager=True)


def run_report(log: DataFrame) -> DataFrame:
    """Source and target rows and status of each (workflow, run) in ``log``:
    counts from the load step's metrics when it succeeded, else from the read
    step's, else 0 (one aggregation, then ``report_counts``)."""
    order = M.order_key(M.ORDER)

    def newest(col: str, step: str):
        return F.max_by(F.col(col), F.when(F.col("step_name") == step, order))

    wide = log.groupBy("workflow_id", "run_id").agg(
        newest("run_details", M.READ_STEP).alias("_read"),
        newest("step_completion_status", M.READ_STEP).alias("_read_status"),
        newest("run_details", M.LOAD_STEP).alias("_load"),
        newest("step_completion_status", M.LOAD_STEP).alias("_load_status"),
    )
    metrics = wide.select(
        "workflow_id",
        "run_id",
        F.get_json_object("_read", "$.source_row_count").cast("bigint").alias("read_source_row_count"),
        F.get_json_object("_load", "$.source_row_count").cast("bigint").alias("load_source_row_count"),
        F.get_json_object("_load", "$.target_row_count").cast("bigint").alias("load_target_row_count"),
        (F.col("_load_status") == M.SUCCESS).alias("load_ok"),
        (F.col("_read_status") == M.SUCCESS).alias("read_ok"),
    )
    out = M.report_counts(metrics)
    return out.select(
        "workflow_id",
        "run_id",
        "source_row_count",
        "target_row_count",
        "empty",
        F.when(F.col("load_ok"), F.lit("Success")).otherwise(F.lit("Failed")).alias("w_status"),
    )


def settings_from_config(
    workflow_id: int,
    workflow_name: str,
    source_details: dict | str,
    target_load_details: dict | str,
    schema: StructType | str,
    run_log_table: str,
    root: str,
    columns: Sequence[str] | None = None,
    source_load_type: str = "full",
    source_load_details: dict | str | None = None,
    dq_rules: Sequence[dict] = (),
    dq_detail: Sequence[dict] | str = (),
    dq_table_check: Sequence[dict] | str = (),
    parents: dict[str, DataFrame] | None = None,
    **kw,
) -> WorkflowSettings:
    """Settings from stored configuration in the reference's JSON shapes:
    ``source_details`` (file_location with the container as first segment,
    first_row_is_header, file_encoding, is_collation, allow_empty_file; or
    source_table for a table of the catalog),
    ``target_load_details`` (current/history database and table),
    ``source_load_details`` ({increment_data: [{key_column, consider_max_val,
    value}]}), rule specs for ``rules_from_config``, ``dq_detail`` (per-rule
    failJob/ticket flags) and ``dq_table_check`` ({subStrategy, email,
    threshold_value})."""
    from corral.functions.rules import rules_from_config
    from corral.sources.discovery import blob_key

    def load(v):
        return json.loads(v) if isinstance(v, str) else v

    src, tgt = load(source_details), load(target_load_details)
    incs = load(source_load_details) or {}
    allow_empty = bool(src.get("allow_empty_file", False))
    source: SourceSettings | TableSource
    if src.get("file_location"):
        source = SourceSettings(
            root=root,
            file_location=blob_key(src["file_location"]),
            schema=schema,
            columns=columns,
            first_row_is_header=str(src.get("first_row_is_header", True)).lower() in ("true", "1", "yes"),
            file_encoding=src.get("file_encoding") or "UTF-8",
            is_collation=bool(src.get("is_collation", False)),
            allow_empty_file=allow_empty,
        )
    else:
        source = TableSource(src["source_table"], columns, allow_empty)
    target = TargetSettings(
        tgt["current_database"], tgt["history_database"], tgt["current_table"], tgt["history_table"]
    )
    increments = [
        IncrementSetting(i["key_column"], bool(i.get("consider_max_val", False)), i.get("value"))
        for i in incs.get("increment_data", [])
    ]
    return WorkflowSettings(
        workflow_id=workflow_id,
        workflow_name=workflow_name,
        source=source,
        target=target,
        run_log_table=run_log_table,
        rules=rules_from_config(dq_rules, parents),
        rule_settings=list(load(dq_detail) or []),
        table_checks=list(load(dq_table_check) or []),
        increments=increments,
        source_load_type=source_load_type,
        **kw,
    )
