"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query runs a library operator over whole driver tables; the operator,
not the query, does the work.  Where SURVEY uses a stand-in (``events`` as a
file listing or run log, ``orders`` as the staged table), the mapping is a
plain projection here.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corral.functions import rules as R
from corral.functions import scalar as S
from corral.operators import counts as K
from corral.operators import increments as I
from corral.operators import key_sets as KS
from corral.operators import profile as P
from corral.operators import quality as Q
from corral.operators import runlog as M
from corral.operators import target as W
from corral.operators.transform import apply_transformations
from corral.plans import reports as RP
from corral.plans.workflow import IngestionRun, SourceSettings, WorkflowSettings, run_report
from corral.session import fresh_database, scratch_location, session_setting
from corral.sources import delimited as CSV
from corral.sources import discovery as D
from corral.sources.database import TableSource
from corral.sources.stage import RAW, Stage
from corral.plans.tables import table
from corral.streaming.file_stream import stream_new_files as _stream_new_files

ORDER_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
]

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# --------------------------------------------------------------------------
# Data quality
# --------------------------------------------------------------------------


def orders_rules(spark: SparkSession, sf_dir: str) -> list[R.Rule]:
    """The demo rule set on orders: quarantine cheap orders, report unknown
    priorities, fail the job on customers without a positive balance."""
    customer = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return [
        R.in_range("o_totalprice", min_value=100000, action=R.QUARANTINE),
        R.in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-LOW"], action=R.REPORT),
        R.foreign_key("o_custkey", customer, "c_custkey", action=R.FAILJOB),
    ]


def orders_validation(spark: SparkSession, sf_dir: str) -> Q.Validation:
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return Q.validate(orders, orders_rules(spark, sf_dir))


@query("dq_correct")
def dq_correct(spark, sf_dir):
    return orders_validation(spark, sf_dir).correct_data


@query("dq_erroneous")
def dq_erroneous(spark, sf_dir):
    return orders_validation(spark, sf_dir).erroneous_data


@query("dq_validation_summary")
def dq_validation_summary(spark, sf_dir):
    return orders_validation(spark, sf_dir).summary


@query("dq_quarantine")
def dq_quarantine(spark, sf_dir):
    return Q.quarantine_rows(orders_validation(spark, sf_dir).erroneous_data)


@query("dq_failjob_gate")
def dq_failjob_gate(spark, sf_dir):
    return Q.failjob_gate(orders_validation(spark, sf_dir).erroneous_data)


@query("dq_execution_status")
def dq_execution_status(spark, sf_dir):
    return Q.execution_status(orders_validation(spark, sf_dir))


@query("report_dq_counts")
def report_dq_counts(spark, sf_dir):
    return orders_validation(spark, sf_dir).counts().select(
        "source_count", "target_count", "quarantined_count"
    )


def _violations(df: DataFrame, rule: R.Rule, columns: list[str]) -> DataFrame:
    """Rows of ``df`` that violate ``rule`` (one-rule validation, erroneous side)."""
    return Q.validate(df, [rule]).erroneous_data.select(*columns)


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    # events whose value is missing: error events carry no value.
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
    )
    return _violations(ev, R.not_null("value"), ["event_id", "value"])


@query("dq_unique")
def dq_unique(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return KS.duplicate_rows(li, ["l_orderkey", "l_linenumber"], "n")


@query("dq_regex")
def dq_regex(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return _violations(part, R.matches("p_brand", "^Brand#[1-3][0-9]$"), ["p_partkey", "p_brand"])


@query("dq_length")
def dq_length(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _violations(part, R.length_between("p_name", max_length=11), ["p_partkey", "p_name"])


@query("dq_type")
def dq_type(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.col("p_type"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("raw"),
    )
    return _violations(part, R.castable("raw", "INT"), ["p_partkey", "raw"])


@query("dq_expression")
def dq_expression(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return _violations(
        li,
        R.expression("l_discount >= l_tax", column="l_discount,l_tax"),
        ["l_orderkey", "l_linenumber", "l_discount", "l_tax"],
    )


# --------------------------------------------------------------------------
# Sources and file discovery
# --------------------------------------------------------------------------


ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)
CUTOFF = "1996-01-01 00:00:00"
ETL_TIME = "2024-01-01T10:00:00.000+00:00"


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


def events_listing(spark, sf_dir) -> DataFrame:
    """events seen as a file listing (path, last_modified)."""
    ev = table(spark, sf_dir, "events")
    path = F.concat(
        F.col("event_type"), F.lit("/u"), F.col("user_id").cast("string"),
        F.lit("/part_"), F.col("event_id").cast("string"), F.lit(".csv"),
    )
    return ev.select(path.alias("path"), F.col("ts").alias("last_modified"))


def events_log(spark, sf_dir) -> DataFrame:
    """events seen as a run log: user = workflow, event = run, type = step;
    a record with value above 200 is a successful step."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("workflow_id"),
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("step_name"),
        F.when(F.col("value") > 200, F.lit(M.SUCCESS)).otherwise(F.lit(M.FAILED)).alias("step_completion_status"),
        F.col("ts").alias("step_started"),
        F.col("ts").alias("step_completion"),
        F.col("props").alias("run_details"),
    )


@query("list_match_glob")
def list_match_glob(spark, sf_dir):
    return D.match_glob(events_listing(spark, sf_dir), "click/*.csv")


@query("latest_file")
def latest_file(spark, sf_dir):
    return D.latest_file(D.match_glob(events_listing(spark, sf_dir), "click/"))


@query("new_files_since")
def new_files_since(spark, sf_dir):
    listing = events_listing(spark, sf_dir)
    # stored watermark: one day before the newest file (one aggregate row)
    wm = listing.agg(
        F.date_format(F.max("last_modified") - F.expr("INTERVAL 1 DAY"), D.WATERMARK_FORMAT)
    ).first()[0]
    return D.new_files_since(D.match_glob(listing, "click/"), wm)


@query("advance_file_watermark")
def advance_file_watermark(spark, sf_dir):
    return D.file_watermark(D.match_glob(events_listing(spark, sf_dir), "click/"))


@query("source_table_name")
def source_table_name(spark, sf_dir):
    return events_listing(spark, sf_dir).select("path", S.table_name_from_path("path").alias("table_name"))


def _orders_as_files(spark, sf_dir, encoding="UTF-8") -> str:
    """Write orders as pipe-delimited text with zoned timestamps; return the folder."""
    loc = scratch_location(spark, "orders_csv")
    text = orders(spark, sf_dir).withColumn(
        "o_orderdate",
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000")),
    )
    CSV.write_delimited(text, loc, header=True, encoding=encoding)
    return loc


@query("csv_read_explicit_schema")
def csv_read_explicit_schema(spark, sf_dir):
    loc = _orders_as_files(spark, sf_dir, encoding="ISO-8859-1")
    df = CSV.read_delimited(spark, loc, ORDERS_DDL, header=True, encoding="ISO-8859-1")
    return df.withColumn("o_orderdate", S.utc_wall_clock("o_orderdate", spark))


@query("stream_new_files")
def stream_new_files(spark, sf_dir):
    src = _orders_as_files(spark, sf_dir)
    sink = scratch_location(spark, "orders_stream_sink")
    ckpt = scratch_location(spark, "orders_stream_ckpt")
    _stream_new_files(spark, src, ORDERS_DDL, sink, ckpt)
    # a second run finds nothing new: the checkpoint remembers every file
    again = _stream_new_files(spark, src, ORDERS_DDL, sink, ckpt)
    if again:
        raise RuntimeError(f"file stream read {again} rows twice")
    out = spark.read.parquet(sink)
    return out.withColumn("o_orderdate", S.utc_wall_clock("o_orderdate", spark))


@query("stage_roundtrip")
def stage_roundtrip(spark, sf_dir):
    stage = Stage(spark, "orders_wf", scratch_location(spark, "run").rsplit("-", 1)[-1])
    stage.save(RAW, orders(spark, sf_dir))
    return stage.load(RAW)


@query("drop_stage")
def drop_stage(spark, sf_dir):
    stage = Stage(spark, "orders_wf", scratch_location(spark, "run").rsplit("-", 1)[-1])
    stage.save(RAW, orders(spark, sf_dir))
    staged = stage.load(RAW).agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    kinds = stage.kinds()
    stage.drop()
    gone = not spark.catalog.databaseExists(stage.database)
    return spark.createDataFrame(
        [(k, int(staged), gone) for k in kinds], "kind string, staged_rows bigint, dropped boolean"
    )


@query("select_columns")
def select_columns(spark, sf_dir):
    return CSV.select_columns(orders(spark, sf_dir), ["o_orderkey", "o_totalprice", "o_orderdate"])


@query("source_metrics")
def source_metrics(spark, sf_dir):
    return CSV.source_metrics(orders(spark, sf_dir))


@query("empty_policy")
def empty_policy(spark, sf_dir):
    o = orders(spark, sf_dir)
    return CSV.empty_check(o.where(F.col("o_totalprice") < 0)).unionByName(CSV.empty_check(o))


@query("transform_slot")
def transform_slot(spark, sf_dir):
    return apply_transformations(
        orders(spark, sf_dir),
        [
            "SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, "
            "o_totalprice*2 AS doubled FROM {src} WHERE o_orderstatus='F'"
        ],
    )


# --------------------------------------------------------------------------
# Count checks and profile
# --------------------------------------------------------------------------


def _loaded(spark, sf_dir) -> DataFrame:
    return orders(spark, sf_dir).where(F.col("o_totalprice") >= 100000)


@query("count_check_source_target")
def count_check_source_target(spark, sf_dir):
    return K.table_count_check(orders(spark, sf_dir), _loaded(spark, sf_dir))


@query("count_check_threshold")
def count_check_threshold(spark, sf_dir):
    return K.threshold_count_check(orders(spark, sf_dir), _loaded(spark, sf_dir), 10)


@query("count_check_control_file")
def count_check_control_file(spark, sf_dir):
    control = orders(spark, sf_dir).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("expected_count"))
    return K.control_file_check(control, _loaded(spark, sf_dir), "o_orderstatus")


@query("report_count_alerts")
def report_count_alerts(spark, sf_dir):
    settings = RP.check_settings_frame(
        spark,
        [
            {"subStrategy": [K.TABLE_COUNT], "email": True},
            {"subStrategy": [K.THRESHOLD_COUNT], "email": False, "threshold_value": 10},
        ],
    )
    results = K.count_checks(orders(spark, sf_dir), _loaded(spark, sf_dir), 10)
    return RP.count_alerts(settings, results)


@query("profile_columns")
def profile_columns(spark, sf_dir):
    return P.profile_columns(orders(spark, sf_dir), ["o_orderkey", "o_orderpriority"])


@query("profile_numeric")
def profile_numeric(spark, sf_dir):
    return P.profile_numeric(orders(spark, sf_dir), ["o_totalprice"])


# --------------------------------------------------------------------------
# Target load and increments
# --------------------------------------------------------------------------


def _targets(spark) -> W.TargetTables:
    cur = fresh_database(spark, "tgt_current")
    hist = fresh_database(spark, "tgt_history")
    return W.TargetTables(spark, W.TargetSettings(cur, hist, "orders", "orders_history"))


def _two_loads(spark, sf_dir) -> W.TargetTables:
    """Load 1 (epoch 100): orders before the cutoff; load 2 (epoch 200):
    orders from the cutoff on."""
    t = _targets(spark)
    o = orders(spark, sf_dir)
    before = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    t.load(o.where(before), epoch_id=100, etl_time=ETL_TIME)
    t.load(o.where(~before), epoch_id=200, etl_time=ETL_TIME)
    return t


@query("first_load_current")
def first_load_current(spark, sf_dir):
    t = _targets(spark)
    o = orders(spark, sf_dir)
    t.load(o, epoch_id=100, etl_time=ETL_TIME)
    return t.current_frame().select(*ORDER_COLUMNS, W.EPOCH)


@query("replace_current")
def replace_current(spark, sf_dir):
    return _two_loads(spark, sf_dir).current_frame().select(*ORDER_COLUMNS, W.EPOCH)


@query("archive_history")
def archive_history(spark, sf_dir):
    return _two_loads(spark, sf_dir).history_frame().select(*ORDER_COLUMNS, W.EPOCH)


@query("stamp_audit")
def stamp_audit(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey")
    return W.stamp(o, 200, ETL_TIME, create_col="etl_create_date", update_col="etl_update_date")


@query("increment_high_water_mark")
def increment_high_water_mark(spark, sf_dir):
    return I.high_water_marks(orders(spark, sf_dir), [I.IncrementSetting("o_orderkey")])


@query("incremental_extract")
def incremental_extract(spark, sf_dir):
    o = orders(spark, sf_dir)
    # the stored mark of an earlier load: 90% of today's high-water mark
    mark = o.agg(F.round(F.max("o_orderkey") * 0.9).cast("bigint")).first()[0]
    settings = [I.IncrementSetting("o_orderkey", True, str(mark))]
    return I.incremental_filter(o.select("o_orderkey", "o_orderdate"), settings)


# --------------------------------------------------------------------------
# Run log and reports
# --------------------------------------------------------------------------


@query("next_run_id")
def next_run_id(spark, sf_dir):
    return M.next_run_id(events_log(spark, sf_dir))


@query("current_run_id")
def current_run_id(spark, sf_dir):
    return M.current_run_id(events_log(spark, sf_dir))


@query("step_upsert_latest")
def step_upsert_latest(spark, sf_dir):
    return M.latest_records(
        events_log(spark, sf_dir), keys=("workflow_id", "step_name"), columns=["run_details", "step_completion"]
    )


@query("run_metrics_merge")
def run_metrics_merge(spark, sf_dir):
    return M.merge_run_metrics(
        events_log(spark, sf_dir),
        [M.Metric("view", "k", "source_row_count", "int"), M.Metric("purchase", "k", "target_row_count", "int")],
        keys=("workflow_id",),
    )


@query("workflow_state")
def workflow_state(spark, sf_dir):
    return M.workflow_state(events_log(spark, sf_dir)).select("workflow_id", "last_step", "last_run_date")


@query("workflow_status")
def workflow_status(spark, sf_dir):
    return M.job_status(events_log(spark, sf_dir), keys=("workflow_id",), load_step="purchase")


@query("schedule_step_join")
def schedule_step_join(spark, sf_dir):
    schedule = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("workflow_id"), F.col("c_mktsegment").alias("schedule")
    )
    steps = events_log(spark, sf_dir).select(
        "workflow_id", "step_name", F.col("step_completion").alias("ts")
    )
    return RP.schedule_steps(schedule, steps)


@query("report_job_status")
def report_job_status(spark, sf_dir):
    jobs = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("workflow_id"), F.col("c_name").alias("job_name")
    )
    runs = RP.run_counts(events_log(spark, sf_dir), ("workflow_id",), load_step="purchase")
    return RP.job_status_report(jobs, runs)


@query("report_times")
def report_times(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return RP.report_clock(ev, "ts", "Asia/Kolkata").select("event_id", "local_time")


# --------------------------------------------------------------------------
# Whole-table validation with row and set rules together (lineitem)
# --------------------------------------------------------------------------

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]


def lineitem_validation(spark, sf_dir) -> Q.Validation:
    """Five rules on lineitem in one validation: two ranges (one with the
    compound action), a reported set rule, a unique key and a foreign key."""
    li = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    return Q.validate(
        li,
        [
            R.in_range("l_quantity", 1, 45, action=R.QUARANTINE),
            R.in_set("l_returnflag", ["A", "N"], action=R.REPORT),
            R.in_range("l_discount", max_value=0.09, action="quarantine,failjob"),
            R.unique(*LINEITEM_KEYS, action=R.FAILJOB),
            R.foreign_key("l_suppkey", suppliers, "s_suppkey", action=None),
        ],
    )


@query("dq_lineitem_summary")
def dq_lineitem_summary(spark, sf_dir):
    return lineitem_validation(spark, sf_dir).summary


@query("dq_lineitem_counts")
def dq_lineitem_counts(spark, sf_dir):
    return lineitem_validation(spark, sf_dir).counts()


@query("dq_lineitem_erroneous")
def dq_lineitem_erroneous(spark, sf_dir):
    return lineitem_validation(spark, sf_dir).erroneous_data.select(*LINEITEM_KEYS, "l_suppkey", Q.ACTION)


@query("profile_part")
def profile_part(spark, sf_dir):
    return P.profile_columns(table(spark, sf_dir, "part"))


@query("profile_lineitem_numeric")
def profile_lineitem_numeric(spark, sf_dir):
    return P.profile_numeric(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


def documents_validation(spark, sf_dir) -> Q.Validation:
    """Rules over whole long texts: not blank, length bounds, a language set,
    declared length = actual length, unique ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    return Q.validate(
        docs,
        [
            R.not_blank("text", action=R.QUARANTINE),
            R.length_between("text", 20, 20000, action=R.REPORT),
            R.in_set("lang", ["en", "de", "fr"], action=R.QUARANTINE),
            R.expression("n_chars = length(text)", column="n_chars", action=R.FAILJOB),
            R.unique("doc_id", action=R.FAILJOB),
        ],
    )


@query("dq_documents_summary")
def dq_documents_summary(spark, sf_dir):
    return documents_validation(spark, sf_dir).summary


@query("dq_documents_erroneous")
def dq_documents_erroneous(spark, sf_dir):
    return documents_validation(spark, sf_dir).erroneous_data.select("doc_id", "lang", Q.ACTION)


# --------------------------------------------------------------------------
# Files, ledger and whole runs: every query writes, runs the operator, reads back
# --------------------------------------------------------------------------


#: Files that one writing task keeps open side by side; beyond it Spark sorts the rest.
OPEN_FILES = 100


def _orders_by_status(spark, sf_dir) -> str:
    """orders as pipe-delimited text, one file per status folder below the returned
    root's ``landing``; all files have the same base name.

    One task writes all files side by side, each row as it comes: a sort by status
    before the write would hold more memory with every row."""
    root = scratch_location(spark, "by_status")
    text = orders(spark, sf_dir).withColumn(
        "o_orderdate", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))
    )
    writer = text.withColumn("status", F.col("o_orderstatus")).coalesce(1).write.partitionBy("status")
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        writer.option("header", "true").option("delimiter", CSV.DELIMITER).csv(f"{root}/landing")
    return root


def _folder(key: str):
    return F.regexp_extract(key, "^(.*)/[^/]*$", 1)


@query("list_files_of_a_folder")
def list_files_of_a_folder(spark, sf_dir):
    root = _orders_by_status(spark, sf_dir)
    found = D.match_glob(D.list_files(spark, root, folder="landing", with_size=True), "landing/*.csv")
    return found.where("file_size > 0").groupBy(_folder("path").alias("folder")).agg(F.count(F.lit(1)).alias("files"))


@query("file_metrics")
def file_metrics(spark, sf_dir):
    root = _orders_by_status(spark, sf_dir)
    df = CSV.read_delimited(spark, f"{root}/landing", ORDERS_DDL, recursive=True)
    return CSV.file_metrics(df).select(
        "source_row_count", "source_file_count", F.col("source_file_arrival").isNotNull().alias("arrival_known")
    )


@query("control_file_reconciliation")
def control_file_reconciliation(spark, sf_dir):
    # of the statuses F and O are listed (O with one row too many), P is not, and X did not come
    root = _orders_by_status(spark, sf_dir)
    df = CSV.read_delimited(spark, f"{root}/landing", ORDERS_DDL, recursive=True)
    key = D.relative_key(D.scan_file_path(), root)
    counted = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("actual_count"))
    listed = orders(spark, sf_dir).where("o_orderstatus IN ('F', 'O')").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    control = listed.select(
        F.concat(F.lit("landing/status="), "o_orderstatus").alias("file_key"),
        (F.col("n") + (F.col("o_orderstatus") == "O").cast("int")).alias("expected_count"),
    ).union(spark.createDataFrame([("landing/status=X", 7)], "k string, n bigint"))
    return K.reconcile_files(control, counted.select(_folder("key").alias("file_key"), "actual_count"))


def _event_files(spark, sf_dir) -> DataFrame:
    """events as files whose times are whole days, so that many share the watermark's time."""
    return events_listing(spark, sf_dir).select(
        "path",
        F.date_trunc("DAY", F.col("last_modified").cast("timestamp")).cast("timestamp_ntz").alias("last_modified"),
        F.length("path").cast("bigint").alias(D.SIZE),
        F.regexp_extract("path", "part_([0-9]+)", 1).cast("bigint").alias("event_id"),
    )


def _recorded_files(spark, sf_dir) -> tuple[W.TargetTables, DataFrame, str]:
    """Two loads whose files are in the ledger: epoch 100 took the files below the mark
    (the day before the newest), epoch 200 those of even number at the mark itself."""
    files = _event_files(spark, sf_dir)
    mark = D.watermark_text(files.withColumn("last_modified", F.col("last_modified") - F.expr("INTERVAL 1 DAY")))
    bound = F.lit(mark).cast("timestamp_ntz")
    t = _targets(spark)
    for epoch, chosen in (
        (100, F.col("last_modified") < bound),
        (200, (F.col("last_modified") == bound) & (F.col("event_id") % 2 == 0)),
    ):
        part = files.where(chosen)
        ledger = part.select(
            F.lit(7).cast("bigint").alias("workflow_id"),
            F.col("path").alias("file_key"),
            "last_modified",
            D.SIZE,
            F.lit(1).cast("bigint").alias("row_count"),
        )
        t.load(part.select("event_id"), epoch_id=epoch, etl_time=ETL_TIME, files=ledger)
    return t, files, mark


@query("new_files_ledger")
def new_files_ledger(spark, sf_dir):
    t, files, mark = _recorded_files(spark, sf_dir)
    return D.unseen_files(files, t.loaded_files(), mark).select("path", "last_modified")


@query("files_of_epoch")
def files_of_epoch(spark, sf_dir):
    return _recorded_files(spark, sf_dir)[0].files_of(200).select("file_key", "last_modified", "row_count", "epoch_id")


@query("stored_watermark")
def stored_watermark(spark, sf_dir):
    log = M.RunLog(spark, f"{fresh_database(spark, 'meta')}.run_log")
    clicks = D.match_glob(events_listing(spark, sf_dir), "click/")
    log.append(7, 1000, M.LOAD_STEP, M.SUCCESS, details={"last_load_file_detail": D.watermark_text(clicks), "epoch_id": 100})
    log.append(7, 1001, M.LOAD_STEP, M.FAILED, details={"last_load_file_detail": "9999-01-01 00:00:00.000000"})
    state = M.workflow_state(log.frame(7)).select("workflow_id", "last_run_id", "last_status", "active", "last_epoch_id")
    loaded = log.frame(7).where(M.load_succeeded())
    mark = M.merge_run_metrics(loaded, [M.Metric(M.LOAD_STEP, "last_load_file_detail", "watermark", "string")], ("workflow_id",))
    return state.join(mark, "workflow_id")


def _run_settings(spark, root: str, location: str, **kw) -> WorkflowSettings:
    db = fresh_database(spark, "run")
    given = {
        "workflow_id": 7,
        "workflow_name": "orders_feed",
        "source": SourceSettings(root=root, file_location=location, schema=ORDERS_DDL, is_collation=True),
        "target": W.TargetSettings(db, db, "orders", "orders_history"),
        "run_log_table": f"{db}.run_log",
        "rules": [R.in_range("o_totalprice", min_value=100000, action=R.QUARANTINE)],
    }
    return WorkflowSettings(**(given | kw))


def _utc_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", S.utc_wall_clock("o_orderdate", df.sparkSession))


@query("run_current")
def run_current(spark, sf_dir):
    s = _run_settings(spark, _orders_by_status(spark, sf_dir), "landing/*.csv")
    IngestionRun(spark, s).run(epoch_id=100, etl_time=ETL_TIME)
    return _utc_dates(spark.table(s.target.current).select(*ORDER_COLUMNS, W.EPOCH))


@query("run_stream_current")
def run_stream_current(spark, sf_dir):
    s = _run_settings(spark, _orders_by_status(spark, sf_dir), "landing/status=F/*.csv")
    IngestionRun(spark, s).run_stream(scratch_location(spark, "run_ckpt"), max_files_per_trigger=1, etl_time=ETL_TIME)
    return _utc_dates(spark.table(s.target.current).select(*ORDER_COLUMNS))


@query("quarantine_table")
def quarantine_table(spark, sf_dir):
    t = _targets(spark)
    rows = Q.quarantine_rows(orders_validation(spark, sf_dir).erroneous_data)
    t.write_quarantine(rows.limit(0), 100, ETL_TIME)
    t.write_quarantine(rows, 200, ETL_TIME)
    return spark.table(t.s.quarantine).select(*ORDER_COLUMNS, W.EPOCH)


@query("run_reports")
def run_reports(spark, sf_dir):
    """The first run loads; the second finds no new file and fails."""
    s = _run_settings(spark, _orders_by_status(spark, sf_dir), "landing/*.csv")
    run = IngestionRun(spark, s)
    run.run(epoch_id=100, etl_time=ETL_TIME)
    try:
        run.run(epoch_id=200, etl_time=ETL_TIME)
    except D.NoNewFileError:
        return run_report(run.log.frame(7))
    raise RuntimeError("a second run found new files")


@query("run_job_status_report")
def run_job_status_report(spark, sf_dir):
    s = _run_settings(spark, _orders_by_status(spark, sf_dir), "landing/*.csv")
    report = IngestionRun(spark, s).run(epoch_id=100, etl_time=ETL_TIME).reports["job_status"]
    return report.select(
        "job_name", "w_status", "source_row_count", "target_row_count", F.col("current_time").endswith("M UTC").alias("has_zone")
    )


@query("run_error_record")
def run_error_record(spark, sf_dir):
    rules = [R.in_range("o_totalprice", min_value=100000, action="quarantine,failjob")]
    s = _run_settings(spark, _orders_by_status(spark, sf_dir), "landing/*.csv", rules=rules)
    run = IngestionRun(spark, s)
    try:
        run.run(epoch_id=100, etl_time=ETL_TIME)
    except Q.DataQualityStop:
        error = S.json_field("run_details", "error_log")
        steps = run.log.frame(7).where(F.col("step_name") != M.RUN_START)
        return steps.select("step_name", "step_completion_status", error.alias("error_log"))
    raise RuntimeError("rows with action failjob did not stop the load")


@query("run_profile_report")
def run_profile_report(spark, sf_dir):
    root = _orders_by_status(spark, sf_dir)
    source = SourceSettings(
        root=root, file_location="landing/*.csv", schema=ORDERS_DDL, is_collation=True, columns=["o_orderkey", "o_orderpriority"]
    )
    s = _run_settings(spark, root, "", source=source, rules=[R.not_null("o_orderkey")], profile=True)
    return IngestionRun(spark, s).run(epoch_id=100, etl_time=ETL_TIME).reports["profile"]


@query("run_table_source")
def run_table_source(spark, sf_dir):
    """A partitioned table as the source: the second run reads the newer partitions only."""
    feed = f"{fresh_database(spark, 'feed')}.orders"
    o = orders(spark, sf_dir).withColumn("o_year", F.year("o_orderdate"))
    o.where("o_year < 1996").write.partitionBy("o_year").saveAsTable(feed)
    s = _run_settings(
        spark, "", "", source=TableSource(feed), rules=(), source_load_type="increment", increments=[I.IncrementSetting("o_year")]
    )
    IngestionRun(spark, s).run(epoch_id=100, etl_time=ETL_TIME)
    o.where("o_year >= 1996").write.insertInto(feed)
    IngestionRun(spark, s).run(epoch_id=200, etl_time=ETL_TIME)
    return spark.table(s.target.current).select(*ORDER_COLUMNS, "o_year", W.EPOCH)


@query("incremental_two_keys")
def incremental_two_keys(spark, sf_dir):
    """Rows above the mark of either key; status P has no order key."""
    o = orders(spark, sf_dir).select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_orderdate"
    )
    half = o.agg(F.floor(F.max("o_orderkey") / 2).alias("a"), F.floor(F.max("o_custkey") * 0.9).alias("b")).first()
    marks = [I.IncrementSetting("o_orderkey", True, str(half["a"])), I.IncrementSetting("o_custkey", True, str(half["b"]))]
    return I.incremental_filter(o, marks)


@query("increment_marks_of_load")
def increment_marks_of_load(spark, sf_dir):
    o = orders(spark, sf_dir)
    keys = [I.IncrementSetting("o_orderkey"), I.IncrementSetting("o_orderdate")]
    result = _targets(spark).load(o, epoch_id=100, etl_time=ETL_TIME, metrics=I.mark_metrics(keys, o.schema))
    marks = I.observed_marks(keys, o.schema, result.observed)
    return spark.createDataFrame([(m.key_column, m.value, m.data_type) for m in marks], "key_column string, value string, data_type string")


@query("target_metrics")
def target_metrics(spark, sf_dir):
    t, o = _targets(spark), orders(spark, sf_dir)
    before = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    results = [t.load(o.where(c), epoch_id=e, etl_time=ETL_TIME) for e, c in ((100, before), (200, ~before))]
    return spark.createDataFrame(
        [(r.epoch_id, r.target_row_count, r.target_column_count, r.archived_epoch) for r in results],
        "epoch_id int, target_row_count bigint, target_column_count int, archived_epoch int",
    )


@query("refresh_outside_partition")
def refresh_outside_partition(spark, sf_dir):
    """Another writer puts a partition beside the loads; ``refresh`` finds it."""
    t = _two_loads(spark, sf_dir)
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {t.s.loads}").where("col_name = 'Location'").first()["data_type"]
    orders(spark, sf_dir).where("o_orderstatus = 'P'").write.parquet(f"{where}/epoch_id=150")
    t.refresh()
    return t.history_frame().groupBy(W.EPOCH).agg(F.count(F.lit(1)).alias("rows"))


@query("dq_materialized")
def dq_materialized(spark, sf_dir):
    """Counts observed while the validated rows are written, and those rows read back."""
    mv = orders_validation(spark, sf_dir).materialize(location=scratch_location(spark, "dq"))
    read = mv.correct_data.select(F.lit(1).alias("good")).unionAll(mv.erroneous_data.select(F.lit(0).alias("good")))
    return read.agg(F.sum("good").alias("good_read"), F.count_if(F.col("good") == 0).alias("bad_read")).select(
        "*",
        F.lit(mv.row_count).cast("bigint").alias("row_count"),
        F.lit(mv.good_count).cast("bigint").alias("good_count"),
        F.lit(mv.quarantined_count).cast("bigint").alias("quarantined_count"),
        F.lit(mv.failjob_count).cast("bigint").alias("failjob_count"),
        F.lit(mv.status).alias("dq_status"),
    )


@query("run_log_compacted")
def run_log_compacted(spark, sf_dir):
    """Records of eight workflows, appended, compacted and read back."""
    log = M.RunLog(spark, f"{fresh_database(spark, 'meta')}.run_log")
    records = events_log(spark, sf_dir).withColumn("workflow_id", F.col("workflow_id") % 8)
    log.append_frame(records.select(*M.RUN_LOG_SCHEMA.fieldNames()))
    for workflow in range(4):
        log.compact(workflow)
    log.purge(0)
    return log.frame().groupBy("workflow_id", "step_name").agg(
        F.count(F.lit(1)).alias("records"), F.max("run_id").alias("newest_run"), F.max("step_completion").alias("newest")
    )


@query("profile_merged")
def profile_merged(spark, sf_dir):
    """Profiles of lineitem by return flag, merged without reading the rows again."""
    li = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    parts = [P.sketch_profile(li.where(F.col("l_returnflag") == flag)) for flag in ("A", "N", "R")]
    return P.merge_profiles(parts[0].unionAll(parts[1]).unionAll(parts[2])).drop("data_type")
