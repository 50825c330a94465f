"""End-to-end runs of the ingestion workflow on small CSV files."""

import json
import os
import subprocess
import sys
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corral.functions import rules as R
from corral.operators import counts as K
from corral.operators import quality as Q
from corral.operators import runlog as M
from corral.operators.increments import IncrementSetting
from corral.operators.target import TargetSettings
from corral.plans.workflow import IngestionRun, SourceSettings, WorkflowSettings
from corral.session import fresh_database
from corral.sources.discovery import NoNewFileError

SCHEMA = "id long, amount double, ts timestamp, country string"
HEADER = "id|amount|ts|country\n"


def drop(folder, name, rows, age=0.0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as fh:
        fh.write(HEADER + "".join(f"{r}\n" for r in rows))
    t = time.time() + age
    os.utime(path, (t, t))


def stages(spark, name):
    return [d.name for d in spark.catalog.listDatabases(f"stage_{name}*")]


def ids(spark, table):
    return sorted(x["id"] for x in spark.table(table).collect())


def at(folder, name, second):
    """Set a file's time to a whole second, as object stores give it."""
    os.utime(f"{folder}/{name}", (second, second))


def settings(spark, root, **kw):
    db = fresh_database(spark, "wf")
    base = dict(
        schedule_start_time=datetime(2024, 1, 1, 4, 0),
        report_zone="Asia/Kolkata",
        workflow_id=42,
        workflow_name="orders_feed",
        source=SourceSettings(root=root, file_location="landing/orders_*.csv", schema=SCHEMA, is_collation=True),
        target=TargetSettings(db, db, "orders", "orders_history"),
        run_log_table=f"{db}.run_log",
        rules=[
            R.in_range("amount", min_value=0, action="quarantine"),
            R.in_set("country", ["DE", "FR"], action="report"),
        ],
        profile=True,
        table_checks=[
            {"subStrategy": [K.TABLE_COUNT], "email": True},
            {"subStrategy": [K.THRESHOLD_COUNT], "email": True, "threshold_value": 50},
        ],
    )
    base.update(kw)
    return WorkflowSettings(**base)


def test_runs_load_archive_and_guard(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|-1|2024-01-01T10:00:00+0000|FR"], age=-100)
    drop(land, "orders_2.csv", ["3|5|2024-01-01T10:00:00.5+0000|US"], age=-90)
    drop(land, "other.csv", ["9|9|2024-01-01T10:00:00+0000|DE"], age=-80)
    s = settings(spark, tmp_dir)
    wf = IngestionRun(spark, s)

    r1 = wf.run(epoch_id=100, etl_time="2024-01-01T10:00:00.000+00:00")
    assert r1.run_id == 1000
    assert r1.metrics["source_row_count"] == 3 and r1.metrics["source_file_count"] == 2
    assert r1.metrics["dq_row_count"] == 2 and r1.metrics["target_row_count"] == 2
    assert r1.dq_status == Q.STATUS_PASSED_QUARANTINE
    cur = spark.table(s.target.current)
    assert sorted(r["id"] for r in cur.collect()) == [1, 3]
    assert [r["id"] for r in spark.table(s.target.quarantine).collect()] == [2]
    # reports
    js = r1.reports["job_status"].first()
    assert (js["source_row_count"], js["target_row_count"], js["w_status"]) == (3, 2, "Success")
    assert js["job_name"] == "orders_feed" and js["schedule_time"] == "09:30 AM IST"
    assert js["current_time"].endswith("M IST")
    st = r1.reports["dq_status"].first()
    quarantine = f"{s.target.current_database}.orders_quarantine_data"
    assert tuple(st) == ("orders_*", quarantine, Q.STATUS_PASSED_QUARANTINE, "No", "No")
    assert tuple(r1.reports["dq_counts"].first()) == (3, 2, 1)
    assert r1.reports["dq_summary"].count() == 2
    prof = {r["column_name"]: r for r in r1.reports["profile"].collect()}
    assert set(prof) == {"id", "amount", "ts", "country"}
    # rows, nulls, min and max come from the validation pass, distinct counts from their own aggregate
    assert [tuple(prof[c])[1:] for c in ("id", "amount", "country")] == [
        (3, 0, 3, "1", "3"), (3, 0, 3, "-1.0", "10.0"), (3, 0, 3, "DE", "US")]
    assert {r["check_name"] for r in r1.reports["count_alerts"].collect()} == {K.TABLE_COUNT}
    # the stage of a successful run is dropped
    assert stages(spark, "42_orders_feed") == []

    # run 2: one new file; current is replaced, run 1's rows go to history
    drop(land, "orders_3.csv", ["4|7|2024-01-02T10:00:00+0000|FR"], age=-10)
    r2 = wf.run(epoch_id=200, etl_time="2024-01-02T10:00:00.000+00:00")
    assert r2.run_id == 1001 and r2.metrics["source_file_count"] == 1
    assert [(r["id"], r["epoch_id"]) for r in spark.table(s.target.current).collect()] == [(4, 200)]
    assert sorted((r["id"], r["epoch_id"]) for r in spark.table(s.target.history).collect()) == [(1, 100), (3, 100)]

    # run 3: nothing new -> the read step fails and is logged; the watermark stays
    with pytest.raises(NoNewFileError):
        wf.run(epoch_id=300)
    log = spark.table(s.run_log_table)
    failed = log.where((F.col("run_id") == 1002) & (F.col("step_completion_status") == M.FAILED)).collect()
    assert [r["step_name"] for r in failed] == [M.READ_STEP]
    assert "no new file" in json.loads(failed[0]["run_details"])["error_log"]
    assert stages(spark, "42_orders_feed") == []  # nor is that of a failed one left
    assert [(r["id"], r["epoch_id"]) for r in spark.table(s.target.current).collect()] == [(4, 200)]
    state = M.workflow_state(spark.table(s.run_log_table)).first()
    assert (state["last_run_id"], state["last_status"], state["active"], state["last_epoch_id"]) == (
        1002, M.FAILED, False, 200)


def test_profile_with_approximate_distinct_counts(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|-1|2024-01-01T10:00:00+0000|DE"])
    for rules in ([], None):
        kw = {} if rules is None else {"rules": rules}
        s = settings(spark, tmp_dir, profile_exact_distinct=False, table_checks=[], **kw)
        r = IngestionRun(spark, s).run(epoch_id=100)
        prof = {x["column_name"]: tuple(x)[1:] for x in r.reports["profile"].collect()}
        # with rules the simple part is observed in the validation pass; without, it is its own aggregate
        assert prof["id"] == (2, 0, 2, "1", "2") and prof["country"] == (2, 0, 1, "DE", "DE")


def test_failjob_stops_load_and_keeps_quarantine(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|-1|2024-01-01T10:00:00+0000|XX"])
    s = settings(
        spark,
        tmp_dir,
        rules=[
            R.in_range("amount", min_value=0, action="quarantine"),
            R.in_set("country", ["DE", "FR"], action="quarantine,failjob"),
        ],
    )
    wf = IngestionRun(spark, s)
    with pytest.raises(Q.DataQualityStop):
        wf.run(epoch_id=100)
    assert not spark.catalog.tableExists(s.target.current)
    assert [r["id"] for r in spark.table(s.target.quarantine).collect()] == [2]
    steps = {r["step_name"]: r["step_completion_status"] for r in spark.table(s.run_log_table).collect()}
    assert steps[M.DQ_STEP] == M.SUCCESS and steps[M.LOAD_STEP] == M.FAILED
    # the failed run did not advance the file watermark: a retry sees the file again
    assert wf.last_load_details() == {}


def test_latest_file_mode_transform_and_increments(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE"], age=-50)
    drop(land, "orders_2.csv", ["2|20|2024-01-01T10:00:00+0000|DE", "3|30|2024-01-01T10:00:00+0000|FR"], age=-40)
    src = SourceSettings(root=tmp_dir, file_location="landing/orders_*.csv", schema=SCHEMA, is_collation=False)
    s = settings(
        spark,
        tmp_dir,
        source=src,
        rules=[],
        profile=False,
        table_checks=[],
        transformations=["SELECT id, amount * 2 AS amount, country FROM {src}"],
        source_load_type="increment",
        increments=[IncrementSetting("id")],
    )
    wf = IngestionRun(spark, s)
    r = wf.run(epoch_id=100)
    assert r.metrics["source_file_path"] == "landing/orders_2.csv"
    assert r.metrics["transformation_column_count"] == 3
    assert sorted((x["id"], x["amount"]) for x in spark.table(s.target.current).collect()) == [(2, 40.0), (3, 60.0)]
    assert r.metrics["increment_data"] == [
        {"key_column": "id", "consider_max_val": True, "value": "3", "data_type": "bigint"}]


def test_empty_file_policy(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", [])
    s = settings(spark, tmp_dir)
    with pytest.raises(Exception, match="no records"):
        IngestionRun(spark, s).run(epoch_id=100)
    s2 = settings(spark, tmp_dir, source=SourceSettings(
        root=tmp_dir, file_location="landing/orders_*.csv", schema=SCHEMA, is_collation=True, allow_empty_file=True))
    r = IngestionRun(spark, s2).run(epoch_id=100)
    assert r.metrics["source_row_count"] == 0 and r.metrics["target_row_count"] == 0
    assert r.reports["job_status"].first()["empty"] is True


def test_control_file_check(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|11|2024-01-01T10:00:00+0000|FR"])
    drop(land, "orders_2.csv", ["3|12|2024-01-01T10:00:00+0000|DE"])
    # a name the scan reports URI-encoded: compared in its decoded form
    drop(land, "orders_3 b+c%.csv", ["4|13|2024-01-01T10:00:00+0000|DE"])
    os.makedirs(f"{tmp_dir}/control")
    head = "file_name|expected_count\n"
    for name, body in [("ok.csv", "orders_1.csv|2\nlanding/orders_2.csv|1\norders_3 b+c%.csv|1\n"),
                       ("bad.csv", "orders_1.csv|2\norders_2.csv|5\norders_3 b+c%.csv|1\n"),
                       ("missing.csv", "orders_1.csv|2\norders_2.csv|1\norders_3 b+c%.csv|1\norders_9.csv|1\n"),
                       ("unlisted.csv", "orders_1.csv|2\norders_2.csv|1\n")]:
        with open(f"{tmp_dir}/control/{name}", "w") as fh:
            fh.write(head + body)
    for control, expected in [("ok.csv", True), ("bad.csv", False), ("missing.csv", False), ("unlisted.csv", False)]:
        checks = [{"subStrategy": [K.CONTROL_FILE_COUNT], "email": True, "control_file": f"{tmp_dir}/control/{control}"}]
        s = settings(spark, tmp_dir, table_checks=checks)
        r = IngestionRun(spark, s).run(epoch_id=100)
        assert r.metrics["table_checks"] == {K.CONTROL_FILE_COUNT: expected}
        alerts = [x["check_name"] for x in r.reports["count_alerts"].collect()]
        assert alerts == ([] if expected else [K.CONTROL_FILE_COUNT])
        assert "__source_file" not in spark.table(s.target.current).columns


def test_settings_from_stored_config(spark, tmp_dir):
    from corral.plans.workflow import settings_from_config

    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|-3|2024-01-01T10:00:00+0000|FR"])
    db = fresh_database(spark, "cfg")
    s = settings_from_config(
        7,
        "cfg_feed",
        json.dumps({"connection_id": 3, "Container_Name": "c", "file_location": "c/landing/orders_*.csv",
                    "first_row_is_header": "true", "file_encoding": "UTF-8", "is_collation": True}),
        json.dumps({"current_database": db, "history_database": db, "current_table": "o", "history_table": "o_h"}),
        SCHEMA,
        f"{db}.run_log",
        root=tmp_dir,
        source_load_type="increment",
        source_load_details=json.dumps({"increment_data": [{"key_column": "id", "consider_max_val": True, "value": None}]}),
        dq_rules=[{"check": "range", "column": "amount", "min": 0, "action": "quarantine"}],
        dq_detail=[{"failJob": False, "ticket": True}],
    )
    r = IngestionRun(spark, s).run(epoch_id=100)
    assert r.metrics["target_row_count"] == 1 and r.dq_status == Q.STATUS_PASSED_QUARANTINE
    assert r.metrics["increment_data"][0]["value"] == "1"
    assert Q.ticket_flag(s.rule_settings) == "Yes"


@pytest.mark.parametrize("per_trigger", [1, None])
def test_streamed_run_equals_the_batch_run(spark, tmp_dir, per_trigger):
    """The files of a trigger only change speed: current, history, quarantine, ledger
    and metrics are those of the batch run, also for a key that repeats across
    files and for a row that does not parse."""
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|-1|2024-01-01T10:00:00+0000|FR",
                                "9|1|2024-01-01T10:00:00+0000|DE"])
    drop(land, "orders_2.csv", ["3|5|2024-01-01T10:00:00+0000|DE", "9|2|2024-01-01T10:00:00+0000|DE"])
    drop(land, "orders_3.csv", ["4|5|2024-01-01T10:00:00+0000|DE", "6|six|2024-01-01T10:00:00+0000|DE"])
    drop(land, "notes.csv", ["8|9|2024-01-01T10:00:00+0000|DE"])
    rules = [R.in_range("amount", min_value=0, action="quarantine"), R.unique("id", action="quarantine"),
             R.parsed("_raw", action="quarantine")]
    src = SourceSettings(root=tmp_dir, file_location="landing/orders_*.csv", schema=SCHEMA, is_collation=True, corrupt_column="_raw")
    kw = dict(table_checks=[{"subStrategy": [K.TABLE_COUNT]}], profile=False, rules=rules, source=src)
    s, batch = settings(spark, tmp_dir, **kw), settings(spark, tmp_dir, **kw)
    wf, ck = IngestionRun(spark, s), f"{tmp_dir}/ck"
    by_batch = IngestionRun(spark, batch).run()

    first = wf.run_stream(ck, max_files_per_trigger=per_trigger)
    assert len(first) == 1
    streamed = {k: v for k, v in first[0].metrics.items() if not k.startswith("stream_")}
    assert {**streamed, "epoch_id": 0} == {**by_batch.metrics, "epoch_id": 0}
    assert streamed["source_file_count"] == 3 and streamed["source_row_count"] == 7
    rows = lambda t: sorted(map(repr, (x.asDict() for x in spark.table(t).drop("epoch_id", "etl_Create_date", "etl_Update_date").collect())))
    for t in ("current", "quarantine", "files"):
        assert rows(getattr(s.target, t)) == rows(getattr(batch.target, t))
    assert ids(spark, s.target.current) == [1, 3, 4] and ids(spark, s.target.quarantine) == [2, 6, 9, 9]
    assert [x["_raw"] for x in spark.table(s.target.quarantine).where("id = 6").collect()] == ["6|six|2024-01-01T10:00:00+0000|DE"]
    # loaded batches are gone, and a restart reads only files not read before
    landed = wf.landed_table(ck)
    assert spark.table(landed).count() == 0
    assert wf.run_stream(ck, max_files_per_trigger=per_trigger) == []
    drop(land, "orders_4.csv", ["5|1|2024-01-02T10:00:00+0000|FR"])
    again = wf.run_stream(ck, max_files_per_trigger=per_trigger)
    assert len(again) == 1 and again[0].metrics["source_row_count"] == 1
    assert ids(spark, s.target.current) == [5] and ids(spark, s.target.history) == [1, 3, 4]


def test_streamed_run_moves_finished_files_away(spark, tmp_dir):
    """Spark moves the files of a batch once a later one is done."""
    land, gone = f"{tmp_dir}/landing", f"{tmp_dir}/archive"
    s = settings(spark, tmp_dir, table_checks=[], profile=False, rules=[])
    wf, ck = IngestionRun(spark, s), f"{tmp_dir}/ck"
    for i in range(3):
        drop(land, f"orders_{i}.csv", [f"{i}|10|2024-01-01T10:00:00+0000|DE"])
        assert len(wf.run_stream(ck, archive_dir=gone)) == 1
        assert ids(spark, s.target.current) == [i]
    kept = {f for f in os.listdir(land) if f.endswith(".csv")}
    moved = {f for _, _, names in os.walk(gone) for f in names if f.endswith(".csv")}
    assert kept | moved == {f"orders_{i}.csv" for i in range(3)} and not kept & moved
    assert "orders_0.csv" in moved


def test_streamed_run_reads_a_prefix_pattern(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "o_[1].csv", ["1|10|2024-01-01T10:00:00+0000|DE"])
    drop(land, "x_2.csv", ["2|10|2024-01-01T10:00:00+0000|DE"])
    src = SourceSettings(root=tmp_dir, file_location="landing/o_[1]", schema=SCHEMA, is_collation=True)
    s = settings(spark, tmp_dir, source=src, rules=[], profile=False, table_checks=[])
    IngestionRun(spark, s).run_stream(f"{tmp_dir}/ck")
    assert [x["id"] for x in spark.table(s.target.current).collect()] == [1]


def test_stopped_streamed_run_is_loaded_once(spark, tmp_dir, monkeypatch):
    """The driver dies after the files were landed and the load was shown, before
    the load is logged: the next run loads the same batches, once."""
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|20|2024-01-01T10:00:00+0000|FR"])
    drop(land, "orders_2.csv", ["3|5|2024-01-01T10:00:00+0000|DE"])
    s = settings(spark, tmp_dir, table_checks=[], profile=False)
    wf, ck = IngestionRun(spark, s), f"{tmp_dir}/ck"
    real = IngestionRun.write_to_target

    def stopped(self, *a):
        real(self, *a)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(IngestionRun, "write_to_target", stopped)
        with pytest.raises(RuntimeError):
            wf.run_stream(ck, max_files_per_trigger=1)
    assert spark.table(s.target.current).count() == 3  # shown, not logged
    assert len(wf.run_stream(ck, max_files_per_trigger=1)) == 1
    assert sorted(x["id"] for x in spark.table(s.target.current).collect()) == [1, 2, 3]
    assert not spark.catalog.tableExists(s.target.history)


def test_first_load_shown_but_not_logged_is_repeated_once(spark, tmp_dir, monkeypatch):
    drop(f"{tmp_dir}/landing", "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|20|2024-01-01T10:00:00+0000|FR"])
    s = settings(spark, tmp_dir, table_checks=[], profile=False)
    wf = IngestionRun(spark, s)
    real = M.RunLog.append

    def append(self, workflow_id, run_id, step, *a, **kw):
        if step == M.LOAD_STEP:
            raise RuntimeError("driver lost")
        return real(self, workflow_id, run_id, step, *a, **kw)

    with monkeypatch.context() as m:
        m.setattr(M.RunLog, "append", append)
        with pytest.raises(RuntimeError):
            wf.run(epoch_id=100)
    wf.run(epoch_id=101)
    assert sorted((x["id"], x["epoch_id"]) for x in spark.table(s.target.current).collect()) == [(1, 101), (2, 101)]
    assert not spark.catalog.tableExists(s.target.history)


def test_unparsable_rows_are_quarantined_with_their_text(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|ten|2024-01-01T10:00:00+0000|FR",
                                "3|7|yesterday|DE"])
    src = SourceSettings(root=tmp_dir, file_location="landing/orders_*.csv", schema=SCHEMA,
                         is_collation=True, corrupt_column="_raw")
    s = settings(spark, tmp_dir, source=src, rules=[R.parsed("_raw", action="quarantine")], table_checks=[])
    r = IngestionRun(spark, s).run(epoch_id=100)
    assert r.metrics["source_column_count"] == 4
    cur = spark.table(s.target.current)
    assert "_raw" not in cur.columns and [x["id"] for x in cur.collect()] == [1]
    q = {x["id"]: x["_raw"] for x in spark.table(s.target.quarantine).collect()}
    assert sorted(q) == [2, 3] and "ten" in q[2] and "yesterday" in q[3]


def test_epochs_always_increase():
    from corral.plans.workflow import next_epoch

    assert next_epoch(None, 100) == 100
    with pytest.raises(ValueError):
        next_epoch(100, 100)
    now = next_epoch(None)
    # a load within the same second as the previous one still gets a new epoch
    assert next_epoch(now) == now + 1 and next_epoch(now + 5) == now + 6


def test_stored_mark_filters_the_next_run(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    drop(land, "orders_1.csv", [f"{i}|10|2024-01-01T10:00:00+0000|DE" for i in (1, 2, 3)], age=-50)
    s = settings(
        spark, tmp_dir, rules=[], profile=False, table_checks=[], source_load_type="increment", increments=[IncrementSetting("id")]
    )
    IngestionRun(spark, s).run(epoch_id=100)
    drop(land, "orders_2.csv", [f"{i}|10|2024-01-01T10:00:00+0000|DE" for i in (2, 3, 4)])
    r = IngestionRun(spark, s).run(epoch_id=200)
    assert [x["id"] for x in spark.table(s.target.current).collect()] == [4]
    assert r.metrics["increment_data"][0]["value"] == "4"


def test_dropped_key_column_stops_before_the_load(spark, tmp_dir):
    drop(f"{tmp_dir}/landing", "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE"])
    s = settings(
        spark,
        tmp_dir,
        rules=[],
        profile=False,
        table_checks=[],
        transformations=["SELECT amount FROM {src}"],
        source_load_type="increment",
        increments=[IncrementSetting("id")],
    )
    with pytest.raises(ValueError, match="id"):
        IngestionRun(spark, s).run(epoch_id=100)
    assert not spark.catalog.tableExists(s.target.current)


def test_table_checks_without_rules(spark, tmp_dir):
    drop(f"{tmp_dir}/landing", "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE", "2|20|2024-01-01T10:00:00+0000|FR"])
    checks = [{"subStrategy": [K.TABLE_COUNT], "email": True}]
    # a name of its own: stages are named by workflow and run, and a failed run keeps its stage
    s = settings(spark, tmp_dir, workflow_name="unruled_feed", rules=[], profile=False, table_checks=checks)
    r = IngestionRun(spark, s).run(epoch_id=100)
    assert (r.metrics["source_row_count"], r.metrics["target_row_count"]) == (2, 2)
    assert r.metrics["table_checks"] == {K.TABLE_COUNT: True}


def test_summary_report_has_every_rule(spark, tmp_dir):
    drop(f"{tmp_dir}/landing", "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE"])
    rules = [R.in_range("amount", min_value=i, action="report") for i in range(12)]
    s = settings(spark, tmp_dir, rules=rules, profile=False, table_checks=[])
    r = IngestionRun(spark, s).run(epoch_id=100)
    rows = r.reports["dq_summary"].collect()
    assert [x["Impacted_Records"] for x in rows] == [0] * 11 + [1]


def test_summary_counts_above_32_bits(spark):
    df = spark.createDataFrame([(1,)], "id long")
    mv = Q.MaterializedValidation(Q.validate(df, [R.not_null("id")]), lambda: df, {"n0": 3_000_000_000})
    assert mv.summary.first()["Impacted_Records"] == 3_000_000_000


def test_files_of_the_watermarks_second_are_read_once(spark, tmp_dir):
    """Object stores give whole seconds: files may come at the stored watermark's own
    time after its run, and at the newest time while a run reads."""
    land, t0 = f"{tmp_dir}/landing", int(time.time()) - 1000
    row = "{}|10|2024-01-01T10:00:00+0000|DE"
    s = settings(spark, tmp_dir, rules=[], profile=False, table_checks=[])
    wf = IngestionRun(spark, s)
    drop(land, "orders_1.csv", [row.format(1)]), at(land, "orders_1.csv", t0)
    drop(land, "orders_0.csv", []), at(land, "orders_0.csv", t0)
    wf.run(epoch_id=100)
    drop(land, "orders_2 é%.csv", [row.format(2)]), at(land, "orders_2 é%.csv", t0)
    r = wf.run(epoch_id=200)
    assert (r.metrics["source_file_count"], ids(spark, s.target.current)) == (1, [2])
    with pytest.raises(NoNewFileError):
        wf.run(epoch_id=300)
    # a late file together with a newer one, and a loaded one written anew in the same second
    drop(land, "orders_3.csv", [row.format(3)]), at(land, "orders_3.csv", t0)
    drop(land, "orders_4.csv", [row.format(4)]), at(land, "orders_4.csv", t0 + 5)
    drop(land, "orders_1.csv", [row.format(1), row.format(11)]), at(land, "orders_1.csv", t0)
    wf.run(epoch_id=400)
    assert ids(spark, s.target.current) == [1, 3, 4, 11] and ids(spark, s.target.history) == [1, 2]
    files = {(x["epoch_id"], x["file_key"]): x["row_count"] for x in wf.targets.loaded_files().collect()}
    assert files == {
        (100, "landing/orders_1.csv"): 1, (100, "landing/orders_0.csv"): 0, (200, "landing/orders_2 é%.csv"): 1,
        (400, "landing/orders_1.csv"): 2, (400, "landing/orders_3.csv"): 1, (400, "landing/orders_4.csv"): 1}
    with pytest.raises(NoNewFileError):
        wf.run(epoch_id=500)
    # a load recorded without a ledger: its files are not read again
    spark.sql(f"DROP TABLE {s.target.files}")
    with pytest.raises(NoNewFileError):
        wf.run(epoch_id=600)


def test_files_of_a_load_that_was_not_recorded_stay_new(spark, tmp_dir, monkeypatch):
    drop(f"{tmp_dir}/landing", "orders_1.csv", ["1|10|2024-01-01T10:00:00+0000|DE"])
    s = settings(spark, tmp_dir, rules=[], profile=False, table_checks=[])
    wf, real = IngestionRun(spark, s), IngestionRun.write_to_target

    def stopped(self, *a):
        real(self, *a)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(IngestionRun, "write_to_target", stopped)
        with pytest.raises(RuntimeError):
            wf.run(epoch_id=100)
    assert wf.targets.files_of(100).count() == 1
    wf.run(epoch_id=101)
    assert [(x["file_key"], x["epoch_id"]) for x in wf.targets.loaded_files().collect()] == [("landing/orders_1.csv", 101)]


def test_latest_file_mode_takes_a_late_file_of_the_same_second(spark, tmp_dir):
    land, t0 = f"{tmp_dir}/landing", int(time.time()) - 1000
    src = SourceSettings(root=tmp_dir, file_location="landing/orders_*.csv", schema=SCHEMA, is_collation=False)
    s = settings(spark, tmp_dir, rules=[], profile=False, table_checks=[], source=src)
    for name, key, epoch in (("orders_2.csv", 2, 100), ("orders_1.csv", 1, 200), ("orders_3.csv", 3, 300)):
        drop(land, name, [f"{key}|10|2024-01-01T10:00:00+0000|DE"]), at(land, name, t0)
        IngestionRun(spark, s).run(epoch_id=epoch)
        assert ids(spark, s.target.current) == [key]
    with pytest.raises(NoNewFileError):
        IngestionRun(spark, s).run(epoch_id=400)


def test_workflows_of_one_name_do_not_meet(spark, tmp_dir):
    """Names that fold to the same text, the same run number, a stage that was kept and
    one that a dead driver left behind."""
    from corral.sources.stage import INTERMEDIATE, Stage

    for folder, keys in (("a", [1, 2]), ("b", [7, 8, 9])):
        drop(f"{tmp_dir}/{folder}", "orders_1.csv", [f"{k}|10|2024-01-01T10:00:00+0000|DE" for k in keys])
    src = lambda f: SourceSettings(root=tmp_dir, file_location=f"{f}/orders_*.csv", schema=SCHEMA, is_collation=True)
    plain = dict(rules=[], profile=False, table_checks=[], workflow_id=1)
    one = settings(spark, tmp_dir, **plain, workflow_name="orders feed", source=src("a"), keep_stage=True,
                   transformations=["SELECT id, amount * 2 AS amount FROM {src}"])
    two = settings(spark, tmp_dir, **plain, workflow_name="orders-feed", source=src("b"))
    left = Stage(spark, "1_orders-feed", 1000)
    left.save(INTERMEDIATE, spark.range(3))
    IngestionRun(spark, one).run(epoch_id=100)
    IngestionRun(spark, two).run(epoch_id=100)
    assert ids(spark, one.target.current) == [1, 2] and ids(spark, two.target.current) == [7, 8, 9]
    # two open stages of one workflow and run number
    x, y = Stage(spark, "w", 1), Stage(spark, "w", 1)
    x.save(INTERMEDIATE, spark.range(1))
    assert not y.exists(INTERMEDIATE)
    for stage in (left, x, y):
        stage.drop()


def test_increment_keys_with_nulls_and_several_marks(spark, tmp_dir):
    schema = "id long, upd long, note string"

    def put(name, rows, age):
        os.makedirs(land, exist_ok=True)
        with open(f"{land}/{name}", "w") as fh:
            fh.write("id|upd|note\n" + "".join(f"{r}\n" for r in rows))
        os.utime(f"{land}/{name}", (time.time() + age,) * 2)

    for undecided, more in (("read", ["g"]), ("leave", [])):
        land = f"{tmp_dir}/{undecided}"
        src = SourceSettings(root=tmp_dir, file_location=f"{undecided}/k_*.csv", schema=schema, is_collation=True)
        s = settings(spark, tmp_dir, rules=[], profile=False, source=src, source_load_type="increment",
                     table_checks=[{"subStrategy": [K.CONTROL_FILE_COUNT], "control_file": f"{tmp_dir}/control.csv"}],
                     increments=[IncrementSetting("id"), IncrementSetting("upd")], undecided_increments=undecided)
        put("k_1.csv", ["5|10|first"], -100)
        with open(f"{tmp_dir}/control.csv", "w") as fh:
            fh.write("file_name|expected_count\nk_1.csv|1\n")
        IngestionRun(spark, s).run(epoch_id=100)
        put("k_2.csv", ["1|50|a", "9|5|b", "|99|c", "9|99|d", "5|10|e", "4|9|f", "|3|g"], -50)
        with open(f"{tmp_dir}/control.csv", "w") as fh:
            fh.write("file_name|expected_count\nk_2.csv|7\n")
        r = IngestionRun(spark, s).run(epoch_id=200)
        assert sorted(x["note"] for x in spark.table(s.target.current).collect()) == ["a", "b", "c", "d", *more]
        assert r.metrics["increment_undecided_rows"] == 1 and r.metrics["source_rows_scanned"] == 7
        # files are counted before the increment filter
        assert r.metrics["table_checks"] == {K.CONTROL_FILE_COUNT: True}
        assert [m["value"] for m in r.metrics["increment_data"]] == ["9", "99"]


def test_marks_are_observed_in_the_load_and_equal_in_every_zone(spark, tmp_dir, monkeypatch):
    land = f"{tmp_dir}/landing"
    zone = spark.conf.get("spark.sql.session.timeZone")
    marks = []
    monkeypatch.setattr("corral.operators.increments.advance", None)  # no pass of its own
    try:
        for i, tz in enumerate(("Asia/Kolkata", "America/New_York")):
            spark.conf.set("spark.sql.session.timeZone", tz)
            folder = f"{land}{i}"
            drop(folder, "orders_1.csv", ["1|1|2024-01-01T00:00:00.25+0000|DE", "2|1|2023-11-05T05:30:00+0000|DE"], age=-50)
            src = SourceSettings(root=tmp_dir, file_location=f"landing{i}/orders_*.csv", schema=SCHEMA, is_collation=True)
            s = settings(spark, tmp_dir, rules=[], profile=False, table_checks=[], source=src, source_load_type="increment",
                         increments=[IncrementSetting("ts")])
            r = IngestionRun(spark, s).run(epoch_id=100)
            marks.append(r.metrics["increment_data"][0])
            # the next run is in another zone: only rows above the instant are read
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            drop(folder, "orders_2.csv", ["3|1|2024-01-01T00:00:00.25+0000|DE", "4|1|2024-01-01T00:00:00.250001+0000|DE"])
            IngestionRun(spark, s).run(epoch_id=200)
            assert ids(spark, s.target.current) == [4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert marks[0] == marks[1] == {
        "key_column": "ts", "consider_max_val": True, "value": "2024-01-01 00:00:00.25", "data_type": "timestamp"}


def test_table_source_reads_only_newer_partitions(spark, tmp_dir):
    from corral.sources.database import TableSource

    db = fresh_database(spark, "src")
    day = lambda d, *ks: spark.createDataFrame([(k, d) for k in ks], "id long, day int")
    day(1, 1, 2).write.partitionBy("day").saveAsTable(f"{db}.feed")
    s = settings(spark, tmp_dir, rules=[R.in_range("id", max_value=100)], profile=False, table_checks=[{"subStrategy": [K.TABLE_COUNT]}],
                 source=TableSource(f"{db}.feed"), source_load_type="increment", increments=[IncrementSetting("day")])
    wf = IngestionRun(spark, s)
    r = wf.run(epoch_id=100)
    assert ids(spark, s.target.current) == [1, 2] and r.metrics["table_checks"] == {K.TABLE_COUNT: True}
    with pytest.raises(Exception, match="no records"):
        wf.run(epoch_id=150)
    day(2, 3, 4, 500).write.insertInto(f"{db}.feed")
    wf._last_load = wf.last_load_details()
    plan = wf.source_rows()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    r = wf.run(epoch_id=200)
    assert ids(spark, s.target.current) == [3, 4] and ids(spark, s.target.history) == [1, 2]
    assert r.metrics["source_row_count"] == 3 and r.metrics["increment_data"][0]["value"] == "2"
    assert r.reports["dq_status"].first()["table_name"] == "feed"


def test_profiles_of_loads_merge_without_their_rows(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    s = settings(spark, tmp_dir, rules=[], profile=False, table_checks=[], profile_sketches=True)
    wf = IngestionRun(spark, s)
    for i, epoch in enumerate((100, 200)):
        drop(land, f"orders_{i}.csv", [f"{k}|{k % 7}.5|2024-01-0{i + 1}T10:00:00+0000|{'D' * (k % 3)}" for k in range(i * 50, 100 + i * 50)], age=i)
        r = wf.run(epoch_id=epoch)
    spark.sql(f"DROP TABLE {s.target.loads}")  # the rows are not needed
    got = {x["column_name"]: tuple(x)[2:] for x in r.reports["profile_all_loads"].collect()}
    assert got["id"][0] == 200 and abs(got["id"][2] - 150) <= 5 and got["id"][3:] == ("0", "149")
    assert got["amount"] == (200, 0, 7, "0.5", "6.5")
    assert got["country"][:2] == (200, 67) and got["country"][2:] == (2, "D", "DD")


ONE_TASK_WRITES = """
import glob, json, sys
sys.path.insert(0, sys.argv[1])
from corral.plans import queries
from corral.session import build_session
from pyspark.sql import functions as F
w = sys.argv[2]
conf = {"spark.eventLog.enabled": "true", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
spark = build_session("local[2]", extra_conf=conf | {"spark.eventLog.dir": f"{w}/log", "spark.sql.warehouse.dir": f"{w}/wh"})
i = F.col("id")
status = F.when(i % 5 == 4, None).otherwise(F.substring(F.lit("FOPF"), (i % 5 + 1).cast("int"), 1))
rows = spark.range(3000).select(
    i.alias("o_orderkey"), i.alias("o_custkey"), status.alias("o_orderstatus"), (i * 1.0).alias("o_totalprice"),
    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
)
rows.write.parquet(f"{w}/sf/orders.parquet")
root = queries._orders_by_status(spark, f"{w}/sf")
files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/landing").select("path").collect()
text = spark.read.option("header", "true").option("delimiter", "|").csv(f"{root}/landing")
counts = {r["status"]: r["count"] for r in text.groupBy("status").count().collect()}
left = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
spark.stop()
events = [json.loads(line) for f in glob.glob(f"{w}/log/*") for line in open(f)]
plans = [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart")]
written = [p for p in plans if "csv" in p.lower() and "InsertIntoHadoopFsRelationCommand" in p]
found = {"names": [r["path"].rsplit("/", 1)[1] for r in files], "counts": [[k, n] for k, n in counts.items()]}
print(json.dumps(found | {"writes": len(written), "sorted": sum("Sort" in p for p in written), "left": left}))
"""


def test_files_by_status_are_written_without_a_sort(spark, tmp_dir):
    """One task writes a file for each status as rows come; the setting is only the write's."""
    os.mkdir(f"{tmp_dir}/log")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    own = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "_PYSPARK"))}
    done = subprocess.run([sys.executable, "-c", ONE_TASK_WRITES, here, tmp_dir], env=own, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    got = json.loads(done.stdout.strip().splitlines()[-1])
    assert len(got["names"]) == 4 and len(set(got["names"])) == 1
    assert dict(map(tuple, got["counts"])) == {"F": 1200, "O": 600, "P": 600, None: 600}
    assert got["writes"] == 1 and got["sorted"] == 0
    assert got["left"] == "0"
