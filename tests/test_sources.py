"""File discovery, CSV reading, staging, file stream."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corral.sources import delimited as CSV
from corral.sources import discovery as D
from corral.sources.stage import RAW, Stage
from corral.streaming.file_stream import stream_new_files


def listing(spark, rows):
    return spark.createDataFrame(
        [(p, datetime.fromisoformat(t)) for p, t in rows], "path string, last_modified timestamp_ntz"
    )


@pytest.fixture()
def files(spark):
    return listing(
        spark,
        [
            ("in/a_1.csv", "2024-01-01 10:00:00"),
            ("in/a_2.csv", "2024-01-01 10:00:00"),
            ("in/a_0.csv", "2024-01-01 09:00:00"),
            ("in/a_3.csv", "2024-01-01 10:00:00.5"),
            ("in/a_4.txt", "2024-01-02 00:00:00"),
            ("in/sub/b_1.csv", "2024-01-01 08:00:00"),
        ],
    )


def paths(df):
    return sorted(r["path"] for r in df.collect())


def test_glob_forms(spark, files):
    assert paths(D.match_glob(files, "in/a_*.csv")) == ["in/a_0.csv", "in/a_1.csv", "in/a_2.csv", "in/a_3.csv"]
    assert paths(D.match_glob(files, "in/a_*")) == ["in/a_0.csv", "in/a_1.csv", "in/a_2.csv", "in/a_3.csv", "in/a_4.txt"]
    assert paths(D.match_glob(files, "in/a_1")) == ["in/a_1.csv"]
    # '*' crosses '/' like a key-prefix listing
    assert paths(D.match_glob(files, "in/*.csv")) == ["in/a_0.csv", "in/a_1.csv", "in/a_2.csv", "in/a_3.csv", "in/sub/b_1.csv"]
    # more than one '*': parts in order
    assert paths(D.match_glob(files, "in/*/b_*.csv")) == ["in/sub/b_1.csv"]


def test_latest_breaks_ties_by_path(spark, files):
    latest = D.latest_file(D.match_glob(files, "in/a_*.csv")).collect()
    assert [r["path"] for r in latest] == ["in/a_3.csv"]
    tie = listing(spark, [("x/b", "2024-01-01 10:00:00"), ("x/a", "2024-01-01 10:00:00")])
    assert D.latest_file(tie).first()["path"] == "x/a"


def test_collation_and_guards(spark, files):
    sel = D.select_files(files, "in/a_*.csv", watermark="2024-01-01 09:59:59.999999", collation=True)
    assert paths(sel.files(files)) == ["in/a_1.csv", "in/a_2.csv", "in/a_3.csv"] and sel.file_count == 3
    assert sel.watermark == "2024-01-01 10:00:00.500000"
    # exact times: a file half a second newer still counts
    sel = D.select_files(files, "in/a_*.csv", watermark="2024-01-01 10:00:00", collation=True)
    assert paths(sel.files(files)) == ["in/a_3.csv"]
    with pytest.raises(D.NoNewFileError):
        D.select_files(files, "in/a_*.csv", watermark="2024-01-01 10:00:00.5", collation=True)
    with pytest.raises(D.NoNewFileError):
        D.select_files(files, "in/a_*.csv", watermark="2024-01-01 10:00:00.5", collation=False)
    first = D.select_files(files, "in/a_*.csv", watermark=None, collation=False)
    assert first.latest == "in/a_3.csv" and paths(first.files(files)) == ["in/a_3.csv"]
    with pytest.raises(D.NoNewFileError):
        D.select_files(listing(spark, []), "in/*", None)


def _scan_files_read(df) -> int:
    """Files the scan of ``df`` opened (its ``numFiles`` metric), after a run."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    stack, seen = [plan], 0
    while stack:
        node = stack.pop()
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            seen += metrics.apply("numFiles").value()
        it = node.children().iterator()
        while it.hasNext():
            stack.append(it.next())
    return seen


def test_scan_reads_only_the_chosen_files(spark, tmp_dir):
    root = f"{tmp_dir}/bucket"
    os.makedirs(f"{root}/land ing/old")
    now = time.time()
    names = {"land ing/o_1.csv": -300, "land ing/o_2 x.csv": -100, "land ing/o_3+y%.csv": -50,
             "land ing/old/o_0.csv": -400, "land ing/notes.txt": -10}
    for i, (name, age) in enumerate(names.items()):
        with open(f"{root}/{name}", "w") as fh:
            fh.write("id|v\n" + "".join(f"{i * 10 + j}|{j}\n" for j in range(3)))
        os.utime(f"{root}/{name}", (now + age, now + age))
    listing = D.list_files(spark, root)
    wm = D.watermark_text(listing.where(F.col("path") == "land ing/o_1.csv"))
    sel = D.select_files(listing, "land ing/o_*.csv", watermark=wm, collation=True)
    assert paths(sel.files(listing)) == ["land ing/o_2 x.csv", "land ing/o_3+y%.csv"]
    df = CSV.read_delimited(spark, root, "id long, v long", recursive=True).where(sel.scan_condition(root, spark))
    got = df.select("id", D.scan_file_name().alias("f"))
    assert sorted({r["f"] for r in got.collect()}) == ["o_2 x.csv", "o_3+y%.csv"]
    assert got.count() == 6
    # the other three files are skipped before reading
    assert _scan_files_read(got) == 2
    latest = D.select_files(listing, "land ing/o_", watermark=None, collation=False)
    assert latest.latest == "land ing/o_3+y%.csv" and latest.file_count == 1
    one = CSV.read_delimited(spark, root, "id long, v long", recursive=True).where(latest.scan_condition(root, spark))
    assert sorted(r["id"] for r in one.collect()) == [20, 21, 22] and _scan_files_read(one) == 1


def test_scan_condition_with_qualified_root_matches_the_key_form(spark, tmp_dir):
    root = f"{tmp_dir}/plain"
    os.makedirs(f"{root}/land/sub")
    now = time.time()
    names = {"land/o_1.csv": -300, "land/o_2.csv": -100, "land/sub/o_3.csv": -50,
             "land/x.csv": -10, "land/o_4.txt": -20, "land/ab.csv": -30, "x.csv": -40,
             "land/o_120b.csv": -60, "land/o_x b.csv": -70}
    for i, (name, age) in enumerate(names.items()):
        with open(f"{root}/{name}", "w") as fh:
            fh.write("id|v\n" + "".join(f"{i * 10 + j}|{j}\n" for j in range(3)))
        os.utime(f"{root}/{name}", (now + age, now + age))
    listing = D.list_files(spark, root, with_root=True)
    assert listing.columns == ["path", "last_modified", D.ROOT_URI]
    df = CSV.read_delimited(spark, root, "id long, v long", recursive=True)
    # "land/a*b.csv": head and tail overlap in "land/ab.csv"; "*/x.csv" needs the length test
    for pattern, collation in [("land/o_*.csv", True), ("land/*/o_3.csv", True), ("land/o_", False),
                               ("land/*", True), ("land/*o_*.csv", True), ("land/a*b.csv", True),
                               ("land/*.csv", True)]:
        sel = D.select_files(listing, pattern, None, collation=collation)
        assert sel.root_uri and sel.root_uri.endswith("/plain/")
        fast = sel.scan_condition(root, spark)
        assert "instr" not in str(fast).lower()
        key_form = D.FileSelection(sel.pattern, sel.since, sel.watermark, sel.file_count, sel.latest)
        got = sorted(r["id"] for r in df.where(fast).collect())
        assert got == sorted(r["id"] for r in df.where(key_form.scan_condition(root, spark)).collect())
        assert len(got) == 3 * sel.file_count
    # "o_x b.csv" is scanned as "o_x%20b.csv", which ends with "20b.csv"; its key does not
    sel = D.select_files(listing, "land/o_*20b.csv", None, collation=True)
    assert sel.file_count == 1 and sorted(r["id"] for r in df.where(sel.scan_condition(root, spark)).collect()) == [
        70, 71, 72]
    # the root-level "x.csv" is shorter than the tail "/x.csv": not chosen
    sel = D.select_files(listing, "*/x.csv", None, collation=True)
    assert sel.file_count == 1 and sorted(r["id"] for r in df.where(sel.scan_condition(root, spark)).collect()) == [30, 31, 32]


def test_run_lists_only_the_pattern_folder(spark, tmp_dir):
    root = f"{tmp_dir}/shared"
    for name in ["feed_a/a_1.csv", "feed_a/old/a_0.csv", "feed_b/b_1.csv", "top.csv"]:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as fh:
            fh.write("id|v\n1|2\n")
    assert [D.pattern_folder(p) for p in ["feed_a/a_*.csv", "feed_a/a_", "*.csv", "feed_a/*/x*.csv"]] == [
        "feed_a", "feed_a", "", "feed_a"]
    listing = D.list_files(spark, root, with_root=True, folder="feed_a")
    # keys stay relative to the root; other feeds are not listed
    assert paths(listing) == ["feed_a/a_1.csv", "feed_a/old/a_0.csv"]
    sel = D.select_files(listing, "feed_a/a_*.csv", None, collation=True)
    assert sel.file_count == 1 and sel.root_uri.endswith("/shared/")
    df = CSV.read_delimited(spark, D.join_key(root, "feed_a"), "id long, v long", recursive=True)
    assert df.where(sel.scan_condition(root, spark)).count() == 1
    # a folder that does not exist holds no new file
    assert D.list_files(spark, root, folder="feed_c").count() == 0
    with pytest.raises(D.NoNewFileError):
        D.select_files(D.list_files(spark, root, with_root=True, folder="feed_c"), "feed_c/c_*.csv", None, True)


def test_list_files_reads_a_real_folder(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in/sub")
    for name in ["in/a_1.csv", "in/a_2.csv", "in/sub/b.csv"]:
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write("x\n")
    os.utime(f"{tmp_dir}/in/a_2.csv", (time.time() + 10, time.time() + 10))
    lst = D.list_files(spark, tmp_dir)
    assert paths(lst) == ["in/a_1.csv", "in/a_2.csv", "in/sub/b.csv"]
    assert D.latest_file(D.match_glob(lst, "in/a_*.csv")).first()["path"] == "in/a_2.csv"
    assert D.blob_key("container/in/a_*.csv") == "in/a_*.csv"


SCHEMA = "id int, amount double, ts timestamp, note string"


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as fh:
        fh.write(text)


def test_csv_header_encoding_bad_values(spark, tmp_dir):
    write(
        f"{tmp_dir}/h.csv",
        "id|amount|ts|note\n1|1.5|2024-01-01T10:00:00+0000|café\n2|x|2024-01-01T10:00:00.1+0000|b\n"
        "3|2|2024-01-01T10:00:00.123+0000|c\n4|3|not a time|d\n",
        encoding="iso-8859-1",
    )
    df = CSV.read_delimited(spark, f"{tmp_dir}/h.csv", SCHEMA, encoding="ISO-8859-1", corrupt_column="_bad")
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["note"] == "café"
    assert rows[2]["amount"] is None and rows[2]["_bad"] is not None
    assert rows[3]["ts"] == datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert rows[2]["ts"] == datetime(2024, 1, 1, 10, 0, 0, 100000)
    assert rows[1]["ts"] == datetime(2024, 1, 1, 10, 0, 0)
    assert rows[4]["ts"] is None and rows[4]["_bad"] is not None


def test_csv_without_header_and_empty_file(spark, tmp_dir):
    write(f"{tmp_dir}/n.csv", "1|2.0|2024-01-01T10:00:00+0000|a\n")
    df = CSV.read_delimited(spark, f"{tmp_dir}/n.csv", SCHEMA, header=False, columns=["id", "note"])
    assert [tuple(r) for r in df.collect()] == [(1, "a")]
    write(f"{tmp_dir}/e.csv", "id|amount|ts|note\n")
    e = CSV.read_delimited(spark, f"{tmp_dir}/e.csv", SCHEMA)
    assert CSV.empty_check(e).first()["is_empty"] is True
    with pytest.raises(CSV.EmptySourceError):
        CSV.enforce_empty_policy(0, allow_empty=False)
    CSV.enforce_empty_policy(0, allow_empty=True)


def test_file_metrics_from_metadata(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", "id|amount|ts|note\n1|1|2024-01-01T10:00:00+0000|a\n")
    write(f"{tmp_dir}/b.csv", "id|amount|ts|note\n2|1|2024-01-01T10:00:00+0000|a\n3|1|2024-01-01T10:00:00+0000|a\n")
    df = CSV.read_delimited(spark, [f"{tmp_dir}/a.csv", f"{tmp_dir}/b.csv"], SCHEMA)
    m = CSV.file_metrics(df).first()
    assert (m["source_row_count"], m["source_file_count"]) == (3, 2)


def test_stage_roundtrip_and_drop(spark):
    st = Stage(spark, "wf test", 1001)
    st.save(RAW, spark.range(5))
    assert st.kinds() == ["raw"] and st.load(RAW).count() == 5
    st.drop()
    assert not spark.catalog.databaseExists(st.database)


def test_stream_reads_each_file_once(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    os.makedirs(src)
    write(f"{src}/1.csv", "id|amount|ts|note\n1|1|2024-01-01T10:00:00+0000|a\n")
    assert stream_new_files(spark, src, SCHEMA, sink, ck) == 1
    assert stream_new_files(spark, src, SCHEMA, sink, ck) == 0
    write(f"{src}/2.csv", "id|amount|ts|note\n2|1|2024-01-01T10:00:00+0000|a\n3|1|2024-01-01T10:00:00+0000|b\n")
    assert stream_new_files(spark, src, SCHEMA, sink, ck) == 2
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_stream_batches_validate_each_new_batch(spark, tmp_dir):
    """Streaming ingestion: every micro-batch of new files is validated and
    its good rows appended; a restart sees only files not read before."""
    from corral.functions import rules as R
    from corral.operators import quality as Q
    from corral.streaming.file_stream import stream_batches

    src, ck, out = f"{tmp_dir}/src", f"{tmp_dir}/ck", f"{tmp_dir}/good"
    os.makedirs(src)
    write(f"{src}/1.csv", "id|amount|ts|note\n1|1|2024-01-01T10:00:00+0000|a\n2|-1|2024-01-01T10:00:00+0000|b\n")

    def handle(batch, batch_id):
        v = Q.validate(batch, [R.in_range("amount", min_value=0)])
        v.correct_data.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    stream_batches(spark, src, SCHEMA, ck, handle)
    write(f"{src}/2.csv", "id|amount|ts|note\n3|5|2024-01-01T10:00:00+0000|c\n")
    stream_batches(spark, src, SCHEMA, ck, handle)
    got = sorted((r["id"], r["batch_id"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0), (3, 1)]


def test_watermark_is_utc_whatever_the_session_zone(spark):
    zoned = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 10, 0)), ("b", datetime(2024, 1, 1, 11, 0))], "path string, ts timestamp_ntz"
    ).select("path", F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC").alias("last_modified"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        wm_utc = D.watermark_text(zoned.where(F.col("path") == "a"))
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        wm_ny = D.watermark_text(zoned.where(F.col("path") == "a"))
        assert wm_utc == wm_ny
        # stored in one zone, compared in another: only the newer file is new
        assert paths(D.new_files_since(zoned, wm_utc)) == ["b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
