"""Run log reads: run ids, upserts, metrics, state, report counts; count checks; profile."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corral.operators import counts as K
from corral.operators import increments as I
from corral.operators import profile as P
from corral.operators import runlog as M
from corral.plans.workflow import run_report
from corral.session import fresh_database


def log_frame(spark, rows):
    data = [
        (w, r, s, st, datetime.fromisoformat(t), datetime.fromisoformat(t), json.dumps(d))
        for w, r, s, st, t, d in rows
    ]
    return spark.createDataFrame(data, M.RUN_LOG_SCHEMA)


@pytest.fixture()
def log(spark):
    return log_frame(
        spark,
        [
            (1, 1000, M.READ_STEP, M.SUCCESS, "2024-01-01 10:00:00", {"source_row_count": 5}),
            (1, 1000, M.LOAD_STEP, M.FAILED, "2024-01-01 10:05:00", {"source_row_count": 5}),
            # the load step written twice: the newer record wins
            (1, 1000, M.LOAD_STEP, M.SUCCESS, "2024-01-01 10:06:00", {"source_row_count": 5, "target_row_count": 4}),
            (1, 1001, M.READ_STEP, M.SUCCESS, "2024-01-02 10:00:00", {"source_row_count": 0}),
            # text order and time order differ: "9" > "10" as text
            (2, 1000, M.READ_STEP, M.SUCCESS, "2024-01-01 09:00:00", {"source_row_count": 9}),
            (2, 1000, M.READ_STEP, M.SUCCESS, "2024-01-01 11:00:00", {"source_row_count": 10}),
        ],
    )


def test_run_ids(spark, log):
    wf = spark.createDataFrame([(1,), (2,), (3,)], "workflow_id long")
    got = {r["workflow_id"]: r["current_run_id"] for r in M.next_run_id(log, wf).collect()}
    assert got == {1: 1002, 2: 1001, 3: 1000}
    assert {r[0]: r[1] for r in M.current_run_id(log).collect()} == {1: 1001, 2: 1000}


def test_latest_records_and_metrics(spark, log):
    latest = M.latest_records(log)
    load = latest.where((F.col("workflow_id") == 1) & (F.col("step_name") == M.LOAD_STEP)).collect()
    assert len(load) == 1 and load[0]["step_completion_status"] == M.SUCCESS
    m = M.merge_run_metrics(log, [M.Metric(M.READ_STEP, "source_row_count", "source_row_count")])
    got = {(r["workflow_id"], r["run_id"]): r["source_row_count"] for r in m.collect()}
    assert got[(2, 1000)] == 10  # newest, not the greatest text


def test_state_and_status(spark, log):
    st = {r["workflow_id"]: r for r in M.workflow_state(log).collect()}
    assert st[1]["last_run_id"] == 1001 and st[1]["last_step"] == M.READ_STEP
    js = {(r["workflow_id"], r["run_id"]): r["w_status"] for r in M.job_status(log).collect()}
    assert js == {(1, 1000): "Success", (1, 1001): "Failed", (2, 1000): "Failed"}


def test_report_counts(spark, log):
    rep = {(r["workflow_id"], r["run_id"]): r for r in run_report(log).collect()}
    assert (rep[(1, 1000)]["source_row_count"], rep[(1, 1000)]["target_row_count"]) == (5, 4)
    assert rep[(1, 1001)]["empty"] is True and rep[(1, 1001)]["w_status"] == "Failed"
    assert (rep[(2, 1000)]["source_row_count"], rep[(2, 1000)]["empty"]) == (10, False)


def test_run_log_table_append(spark):
    db = fresh_database(spark, "meta")
    rl = M.RunLog(spark, f"{db}.run_log")
    assert rl.frame().count() == 0
    rl.append(7, 1000, M.READ_STEP, M.SUCCESS, details={"source_row_count": 3})
    rl.append(7, 1000, M.READ_STEP, M.FAILED, details=M.error_details({}, ValueError("a\nb")))
    assert rl.frame().count() == 2
    assert json.loads(rl.frame().where(F.col("step_completion_status") == M.FAILED).first()["run_details"])["error_log"] == "a b"


def test_run_log_partitions_by_workflow_and_compacts(spark):
    db = fresh_database(spark, "meta")
    rl = M.RunLog(spark, f"{db}.run_log")
    for run in range(1000, 1004):
        rl.append(7, run, M.READ_STEP, M.SUCCESS, details={"source_row_count": run})
        rl.append(7, run, M.LOAD_STEP, M.SUCCESS, details={"epoch_id": run})
    rl.append(8, 1000, M.READ_STEP, M.FAILED)
    one = rl.frame(7)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(workflow_id" in plan and "(workflow_id" in plan
    assert one.columns == M.RUN_LOG_SCHEMA.fieldNames()
    before = sorted(tuple(r) for r in one.collect())
    assert len(one.inputFiles()) == 8 and len(rl.frame(8).inputFiles()) == 1
    assert rl.compact(7) == 8
    assert sorted(tuple(r) for r in rl.frame(7).collect()) == before  # the replaced files are still there
    assert rl.purge(7) == 0
    after = rl.frame(7)
    assert sorted(tuple(r) for r in after.collect()) == before
    assert len(after.inputFiles()) == 1 and "Aggregate" not in after._jdf.queryExecution().executedPlan().toString()
    assert [r["step_completion_status"] for r in rl.frame(8).collect()] == [M.FAILED]
    assert rl.compact(9) == 0


class Lost(Exception):
    pass


def test_compaction_loses_no_record_at_any_stop(spark, monkeypatch):
    """The driver dies before each statement of a compaction, and between its writes;
    a writer that still holds the old generation appends at the same moment."""
    db = fresh_database(spark, "meta")
    rl = M.RunLog(spark, f"{db}.run_log")
    rl.append(7, 1, M.READ_STEP, M.SUCCESS)
    rl.append(8, 1, M.READ_STEP, M.SUCCESS)
    runs = {1}
    real = spark.sql
    seen = lambda: sorted(r["run_id"] for r in rl.frame(7).collect())

    def stop_at(n):
        count = [0]

        def sql(text, *a, **kw):
            if text.startswith("ALTER"):
                count[0] += 1
                if count[0] == n:
                    late = M.RunLog(spark, rl.table)
                    late.open_generation = lambda w: generation
                    late.append(7, 100 + n, M.READ_STEP, M.SUCCESS)
                    runs.add(100 + n)
                    raise Lost
            return real(text, *a, **kw)

        return sql

    n = stops = 0
    while True:
        n += 1
        generation = rl.open_generation(7)
        with monkeypatch.context() as m:
            m.setattr(spark, "sql", stop_at(n))
            try:
                rl.compact(7)
            except Lost:
                stops += 1
            else:
                break
        assert seen() == sorted(runs)
        rl.append(7, 10 + n, M.LOAD_STEP, M.SUCCESS)
        runs.add(10 + n)
    assert stops >= 3 and seen() == sorted(runs)
    # a slow writer puts a record into a generation that was replaced: seen at once, and carried over
    late = M.RunLog(spark, rl.table)
    late.open_generation = lambda w: generation
    late.append(7, 99, M.READ_STEP, M.SUCCESS)
    runs.add(99)
    assert generation < rl.open_generation(7) and seen() == sorted(runs)
    assert rl.purge(7) >= 1 and seen() == sorted(runs)
    assert rl.compact(7) == len(runs) and rl.purge(7) == 0 and seen() == sorted(runs)
    assert [r["run_id"] for r in rl.frame(8).collect()] == [1]
    assert len(rl.frame().collect()) == len(runs) + 1


def test_log_of_the_earlier_layout_is_appended_to(spark):
    db = fresh_database(spark, "meta")
    row = (7, 1000, M.READ_STEP, M.SUCCESS, None, None, "{}")
    spark.createDataFrame([row], M.RUN_LOG_SCHEMA).write.partitionBy("workflow_id").saveAsTable(f"{db}.run_log")
    rl = M.RunLog(spark, f"{db}.run_log")
    rl.append(7, 1001, M.READ_STEP, M.SUCCESS)
    assert sorted(r["run_id"] for r in rl.frame(7).collect()) == [1000, 1001]
    with pytest.raises(ValueError):
        rl.compact(7)


def test_reconciliation_of_files(spark):
    control = spark.createDataFrame([("a/x.csv", 2), ("b/x.csv", 0), (None, 1)], "file_key string, expected_count long")
    actual = spark.createDataFrame([("a/x.csv", 2), ("c/x.csv", 5), (None, 1)], "file_key string, actual_count long")
    got = {r["file_key"]: tuple(r)[1:] for r in K.reconcile_files(control, actual).collect()}
    assert got == {"a/x.csv": (2, 2, True), "b/x.csv": (0, None, True), "c/x.csv": (None, 5, False), None: (1, 1, True)}


def test_merged_profile_equals_the_direct_one(spark):
    df = spark.range(3000).selectExpr(
        "id AS k", "CAST(id % 40 AS decimal(10,2)) AS d", "IF(id % 5 = 0, NULL, concat('t', id % 900)) AS t",
        "CAST(id - 1500 AS double) / 7 AS x", "CAST(CAST(id * 60 AS timestamp) AS timestamp_ntz) AS ts", "id % 2 = 0 AS b")
    parts = [df.where("k < 1000"), df.where("k >= 1000 AND k < 1001"), df.where("k > 1000"), df.limit(0)]
    sketches = P.sketch_profile(parts[0])
    for part in parts[1:]:
        sketches = sketches.union(P.sketch_profile(part))
    direct = {r["column_name"]: r for r in P.profile_columns(df).collect()}
    merged = P.merge_profiles(sketches).collect()
    assert len(merged) == len(df.columns)
    for r in merged:
        want = direct[r["column_name"]]
        for c in ("row_count", "null_count", "min_value", "max_value"):
            assert r[c] == want[c], (r["column_name"], c)
        assert abs(r["distinct_count"] - want["distinct_count"]) <= 0.05 * want["distinct_count"]
    assert "Expand" not in df.agg(*P.sketch_metrics(df.schema))._jdf.queryExecution().executedPlan().toString()


def test_control_file_cases(spark):
    control = spark.createDataFrame([("f1", 2), ("f2", 5), ("f3", 1)], "file string, expected_count long")
    loaded = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "file string")
    got = {r["file_key"]: (r["actual_count"], r[K.CONTROL_FILE_COUNT]) for r in K.control_file_check(control, loaded, "file").collect()}
    assert got == {"f1": (2, True), "f2": (1, False), "f3": (None, False)}


def test_count_checks(spark):
    s, t = spark.range(100), spark.range(95)
    assert K.table_count_check(s, t).first()[K.TABLE_COUNT] is False
    assert K.threshold_count_check(s, t, 5).first()[K.THRESHOLD_COUNT] is True
    assert K.threshold_count_check(s, t, 4.9).first()[K.THRESHOLD_COUNT] is False


def test_profile_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "x int, y string")
    p = {r["column_name"]: r for r in P.profile_columns(df).collect()}
    assert (p["x"]["null_count"], p["x"]["distinct_count"], p["x"]["min_value"], p["x"]["max_value"]) == (1, 2, "1", "3")
    assert (p["y"]["null_count"], p["y"]["distinct_count"]) == (1, 1)
    approx = {r["column_name"]: r["distinct_count"] for r in P.profile_columns(df, exact_distinct=False).collect()}
    assert approx == {"x": 2, "y": 1}
    assert P.profile_report(P.profile_columns(df).withColumn("action", F.lit("x"))).columns[-1] == "max_value"


def test_profile_from_observed_validation_pass(spark, tmp_path):
    """Rows, nulls, min and max observed while the validated rows are written
    give the same profile as the two-aggregate form, with one read fewer."""
    from corral.functions import rules as R
    from corral.operators import quality as Q

    df = spark.createDataFrame(
        [(1, "b", "2024-01-02 03:04:05"), (None, "a", None), (3, None, "2023-12-31 23:59:59"), (3, "b", None)],
        "x int, y string, t string",
    ).withColumn("t", F.col("t").cast("timestamp"))
    mv = Q.validate(df, [R.not_null("x", action="quarantine")]).materialize(
        location=str(tmp_path / "dq"), extra_metrics=P.simple_metrics(df.columns)
    )
    assert mv.good_count == 3
    key = lambda rows: sorted(tuple(r) for r in rows)
    assert key(P.profile_with_observed(df, mv.metrics).collect()) == key(P.profile_columns(df).collect())
    empty = df.where(F.lit(False))
    mv0 = Q.validate(empty, [R.not_null("x")]).materialize(
        location=str(tmp_path / "dq0"), extra_metrics=P.simple_metrics(empty.columns)
    )
    assert key(P.profile_with_observed(empty, mv0.metrics).collect()) == key(P.profile_columns(empty).collect())


def test_frontier_of_several_keys(spark):
    df = spark.createDataFrame([(1, 50), (9, 5), (None, 99), (9, 99), (5, 10), (None, 3), (None, None)], "id long, upd long")
    marks = [I.IncrementSetting("id", True, "5"), I.IncrementSetting("upd", True, "10")]
    read = lambda u: sorted((tuple(r) for r in I.incremental_filter(df, marks, u).collect()), key=repr)
    newer = [(1, 50), (9, 5), (9, 99), (None, 99)]
    assert read(I.LEAVE_UNDECIDED) == newer
    assert read(I.READ_UNDECIDED) == sorted([*newer, (None, 3), (None, None)], key=repr)
    above, undecided = I.frontier(marks, df.schema)
    counts = df.agg(F.count_if(above).alias("a"), F.count_if(undecided).alias("u")).first()
    assert tuple(counts) == (4, 2)
    assert I.frontier([I.IncrementSetting("id")], df.schema) is None


def test_frontier_is_one_pushed_predicate(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS upd").write.parquet(str(tmp_path / "t"))
    marks = [I.IncrementSetting("id", True, "5"), I.IncrementSetting("upd", True, "10")]
    plan = I.incremental_filter(spark.read.parquet(str(tmp_path / "t")), marks)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert pushed.count("Or(") >= 3 and "GreaterThan(id,5)" in pushed and "IsNull(upd)" in pushed


def test_increments(spark):
    df = spark.createDataFrame([(1, 10), (5, 20)], "k long, v long")
    settings = [I.IncrementSetting("k"), I.IncrementSetting("v", consider_max_val=False, value="15")]
    new = I.advance(df, settings)
    assert new[0].value == "5" and new[1].value == "15"
    assert [r["k"] for r in I.incremental_filter(df, [I.IncrementSetting("k", True, "1")]).collect()] == [5]
