"""Versioned loads: three epochs, idempotent archive, quarantine."""

import os

import pytest
from pyspark.sql import functions as F

from corral.operators import target as W
from corral.session import fresh_database

T = "2024-01-01T10:00:00.000+00:00"


def tables(spark):
    return W.TargetTables(spark, W.TargetSettings(fresh_database(spark, "cur"), fresh_database(spark, "hist"), "t", "t_hist"))


def keys(df):
    return sorted((r["k"], r["epoch_id"]) for r in df.select("k", "epoch_id").collect())


def test_three_loads(spark):
    t = tables(spark)
    batches = {100: [1, 2], 200: [3], 300: [4, 5, 6]}
    for epoch, ks in batches.items():
        r = t.load(spark.createDataFrame([(k,) for k in ks], "k long"), epoch_id=epoch, etl_time=T)
        assert r.target_row_count == len(ks) and r.target_column_count == 4
    assert keys(t.current_frame()) == [(4, 300), (5, 300), (6, 300)]
    assert keys(t.history_frame()) == [(1, 100), (2, 100), (3, 200)]
    assert t.current_epoch() == 300
    row = t.current_frame().first()
    assert str(row["etl_Create_date"]) == "2024-01-01 10:00:00" and row["etl_Create_date"] == row["etl_Update_date"]


def test_no_step_of_a_load_shows_an_epoch_in_both_views_or_in_neither(spark, monkeypatch):
    """Every SQL statement of a load (each metadata change is one) is followed by a reader."""
    t = tables(spark)
    t.load(spark.createDataFrame([(1,), (2,)], "k long"), epoch_id=100, etl_time=T)
    seen, real = [], spark.sql

    def watched(text, *a, **kw):
        out = real(text, *a, **kw)
        history = keys(t.history_frame()) if spark.catalog.tableExists(t.s.history) else []
        seen.append((history, keys(t.current_frame())))
        return out

    with monkeypatch.context() as m:
        m.setattr(spark, "sql", watched)
        t.load(spark.createDataFrame([(3, "x")], "k long, v string"), epoch_id=200, etl_time=T)
        t.load(spark.createDataFrame([(4, "y")], "k long, v string"), epoch_id=300, etl_time=T)
    states = [s for i, s in enumerate(seen) if i == 0 or s != seen[i - 1]]
    one, two = [(1, 100), (2, 100)], [(3, 200)]
    assert states == [([], one), (one, two), (one + two, [(4, 300)])]
    assert len(seen) > 15 and t.current_frame().select("v").first()["v"] == "y"


def test_views_of_the_earlier_layout_are_taken_over(spark):
    t = tables(spark)
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T)
    t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=200, etl_time=T)
    spark.sql(f"DROP VIEW {t.s.published}")
    for view, condition in ((t.s.current, "= 200"), (t.s.history, "<= 100")):
        spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{W.SHOWN}' = '{condition.split()[1]}') "
                  f"AS SELECT * FROM {t.s.loads} WHERE epoch_id {condition}")
    t.load(spark.createDataFrame([(3,)], "k long"), epoch_id=300, etl_time=T)
    assert keys(t.current_frame()) == [(3, 300)] and keys(t.history_frame()) == [(1, 100), (2, 200)]


def test_ledger_rows_come_and_go_with_their_load(spark):
    t = tables(spark)
    files = lambda *ks: spark.createDataFrame(
        [(7, k, None, 5, 1) for k in ks], "workflow_id long, file_key string, last_modified timestamp_ntz, file_size long, row_count long")
    rows = spark.createDataFrame([(1,)], "k long")
    assert t.loaded_files().collect() == []
    t.load(rows, epoch_id=100, etl_time=T, files=files("a", "b"), metrics=[F.max("k").alias("top")])
    r = t.load(rows, epoch_id=200, etl_time=T, files=files("c"), owner="7", metrics=[F.max("k").alias("top")])
    assert r.observed["top"] == 1
    assert sorted(x["file_key"] for x in t.files_of(100).collect()) == ["a", "b"]
    plan = t.files_of(100)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch_id" in plan
    t.recover("7", logged_epoch=100)
    assert sorted(x["file_key"] for x in t.loaded_files().collect()) == ["a", "b"]


def test_refresh_finds_partitions_of_outside_writers(spark):
    t = tables(spark)
    t.refresh()  # nothing there yet
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T)
    t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=200, etl_time=T)
    base = spark.sql(f"DESCRIBE TABLE EXTENDED {t.s.loads}").where("col_name = 'Location'").first()["data_type"]
    spark.createDataFrame([(9,)], "k long").write.parquet(f"{base}/epoch_id=150")
    assert keys(t.history_frame()) == [(1, 100)]
    t.refresh()
    assert keys(t.history_frame()) == [(1, 100), (9, 150)]


def test_quarantine_overwrite_and_append(spark):
    t = tables(spark)
    q = spark.createDataFrame([(7,)], "k long")
    t.write_quarantine(q, 100, T)
    t.write_quarantine(q.where(F.lit(False)), 200, T)
    assert spark.table(t.s.quarantine).count() == 0  # overwritten, even when empty
    t.write_quarantine(q, 300, T, mode="append")
    t.write_quarantine(q, 400, T, mode="append")
    assert sorted(r["epoch_id"] for r in spark.table(t.s.quarantine).collect()) == [300, 400]


def test_partition_filter_reaches_scan(spark):
    t = tables(spark)
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T)
    t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=200, etl_time=T)
    plan = t.history_frame().where(F.col("epoch_id") == 100)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch_id" in plan


def test_repeated_epoch_is_refused(spark):
    t = tables(spark)
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T)
    with pytest.raises(ValueError):
        t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=100, etl_time=T)
    assert keys(t.current_frame()) == [(1, 100)]


STOPS = ["after the mark", "after the partition", "after the views"]


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("stop", STOPS)
def test_retry_after_a_stopped_load_is_exact(spark, monkeypatch, stop, first):
    t = tables(spark)
    if not first:
        t.load(spark.createDataFrame([(1,), (2,)], "k long"), epoch_id=100, etl_time=T)
        t.load(spark.createDataFrame([(3,)], "k long"), epoch_id=200, etl_time=T)
    rows = spark.createDataFrame([(4,), (5,)], "k long")

    def stopped(*a, **kw):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        if stop == "after the mark":
            m.setattr(W, "write_epoch", stopped)
        elif stop == "after the views":
            m.setattr(t, "publish" if first else "finish", stopped)
        else:
            real = W.write_epoch

            def write(df, table, epoch_id):
                real(df, table, epoch_id)
                stopped()

            m.setattr(W, "write_epoch", write)
        with pytest.raises(RuntimeError):
            t.load(rows, epoch_id=300, etl_time=T)
    if not first and stop != "after the views":
        assert keys(t.current_frame()) == [(3, 200)]  # readers still see the load before
    if stop == "after the views" and not first:
        # everything was shown, only the mark was left: the load counts
        t.recover()
        assert keys(t.current_frame()) == [(4, 300), (5, 300)]
        assert keys(t.history_frame()) == [(1, 100), (2, 100), (3, 200)]
        return
    t.load(rows, epoch_id=301, etl_time=T)
    assert keys(t.current_frame()) == [(4, 301), (5, 301)]
    assert first or keys(t.history_frame()) == [(1, 100), (2, 100), (3, 200)]
    assert W.epochs(spark, t.s.loads) == ([301] if first else [100, 200, 301])


def test_files_without_a_partition_are_dropped(spark):
    """Files committed by a load that died before registering its partition."""
    t = tables(spark)
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T)
    base = spark.sql(f"DESCRIBE TABLE EXTENDED {t.s.loads}").where("col_name = 'Location'").first()["data_type"]
    spark.createDataFrame([(9,)], "k long").write.parquet(f"{base}/epoch_id=200")
    spark.sql(f"ALTER TABLE {t.s.loads} SET TBLPROPERTIES ('{W.PENDING}' = '200:')")
    assert t.recover() == 200
    assert not os.path.exists(f"{base.removeprefix('file:')}/epoch_id=200")
    t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=200, etl_time=T)
    assert keys(t.current_frame()) == [(2, 200)] and keys(t.history_frame()) == [(1, 100)]


def test_load_shown_but_not_recorded_is_undone(spark):
    t = tables(spark)
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=100, etl_time=T, owner="7")
    # first load shown, never recorded: the owner's retry reads the same rows again
    t.load(spark.createDataFrame([(1,)], "k long"), epoch_id=101, etl_time=T, owner="7")
    assert keys(t.current_frame()) == [(1, 101)] and not t.history_exists()
    t.write_quarantine(spark.createDataFrame([(8,)], "k long"), 101, T, mode="append")
    # recorded, but the mark was not removed: the load stays
    t.load(spark.createDataFrame([(2,)], "k long"), epoch_id=200, etl_time=T, owner="7", previous_epoch=101)
    assert keys(t.history_frame()) == [(1, 101)]
    with pytest.raises(RuntimeError):
        t.load(spark.createDataFrame([(3,)], "k long"), epoch_id=300, etl_time=T, owner="8")
    t.write_quarantine(spark.createDataFrame([(9,)], "k long"), 200, T, mode="append")
    assert t.recover("7", logged_epoch=101) == 200
    assert keys(t.current_frame()) == [(1, 101)]
    assert [r["k"] for r in spark.table(t.s.quarantine).collect()] == [8]


def test_new_and_missing_columns(spark):
    t = tables(spark)
    t.load(spark.createDataFrame([(1, "a")], "k long, v string"), epoch_id=100, etl_time=T)
    t.load(spark.createDataFrame([(2, 0.5)], "k long, w double"), epoch_id=200, etl_time=T)
    assert tuple(t.current_frame().select("k", "v", "w").first()) == (2, None, 0.5)
    assert [r["v"] for r in t.history_frame().collect()] == ["a"]


_WRITE_PLANS = '''
import glob, json, sys
sys.path.insert(0, sys.argv[1])
from corral.operators import target as W
from corral.session import build_session, fresh_database
ev = sys.argv[2]
spark = build_session("local[2]", shuffle_partitions=2, extra_conf={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev, "spark.eventLog.compress": "false"})
spark.sparkContext.setCheckpointDir(sys.argv[3])
db = fresh_database(spark, "plans")
t = W.TargetTables(spark, W.TargetSettings(db, db, "cur", "hist"))
rows = spark.range(1000).selectExpr("id AS k")
t.load(rows, epoch_id=100, etl_time="2024-01-01T10:00:00.000+00:00")
t.load(rows, epoch_id=200, etl_time="2024-01-01T10:00:00.000+00:00")
t.write_quarantine(rows, epoch_id=200)
spark.stop()
for f in glob.glob(ev + "/**/*", recursive=True):
    try:
        lines = open(f).read().splitlines()
    except (IsADirectoryError, UnicodeDecodeError):
        continue
    for line in lines:
        e = json.loads(line)
        plan = e.get("physicalPlanDescription", "")
        if e["Event"].endswith("SQLExecutionStart") and "InsertIntoHadoopFsRelationCommand" in plan:
            print(json.dumps(plan[: plan.find(chr(10) + chr(10))]))
'''


def test_epoch_partitioned_writes_plan_no_sort(tmp_path):
    """Loads and quarantine are partitioned by a constant epoch: Spark must
    not sort the rows by it (a full per-task sort at scale).  Plans are read
    from the event log of a separate session."""
    import json
    import subprocess
    import sys

    script = tmp_path / "plans.py"
    script.write_text(_WRITE_PLANS)
    ev, ck = tmp_path / "events", tmp_path / "ck"
    ev.mkdir()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, str(script), repo, str(ev), str(ck)], capture_output=True, text=True,
                         timeout=600, check=True).stdout
    plans = [json.loads(line) for line in out.splitlines() if line.startswith('"')]
    # first load, second load, quarantine: archiving copies nothing
    assert len(plans) == 3
    assert all("WriteFiles" in p and "Sort" not in p for p in plans), plans
