"""Report tables: job status, DQ counts, profile, count-check alerts.

The reference mails these; here they are DataFrames (mail is out of scope).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corral.functions.scalar import local_clock
from corral.operators.profile import profile_report  # noqa: F401  (R3)
from corral.operators.runlog import LOAD_STEP, load_succeeded, status_from_flags


def run_counts(log: DataFrame, keys: Sequence[str] = ("workflow_id",), load_step: str = LOAD_STEP) -> DataFrame:
    """Per key: number of records, number of successful loads and status,
    from one aggregation."""
    ok = load_succeeded(load_step)
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.count_if(ok).alias("target_row_count"),
        status_from_flags(ok).alias("w_status"),
    )


def job_status_report(jobs: DataFrame, runs: DataFrame, key: str = "workflow_id") -> DataFrame:
    """Job name with its counts and status (inner join on the workflow)."""
    return jobs.join(runs, key, "inner").select(key, "job_name", "source_row_count", "target_row_count", "w_status")


def schedule_steps(schedule: DataFrame, log: DataFrame, key: str = "workflow_id") -> DataFrame:
    """Schedule rows joined to the step records of their workflow."""
    return schedule.join(log, key, "inner")


def report_clock(df: DataFrame, ts: str, zone: str, alias: str = "local_time") -> DataFrame:
    return df.withColumn(alias, local_clock(ts, zone))


def check_settings_frame(spark: SparkSession, settings: Sequence[dict]) -> DataFrame:
    """Stored table-check settings ({subStrategy: [...], email, threshold_value})
    as (check_name, email), one row per named check."""
    rows = [
        (
            str(name).lower(),
            bool(s.get("email", False)),
            None if s.get("threshold_value") is None else float(s["threshold_value"]),
        )
        for s in settings
        for name in s.get("subStrategy", [])
    ]
    return spark.createDataFrame(rows, "check_name string, email boolean, threshold_value double")


def count_alerts(settings: DataFrame, results: DataFrame) -> DataFrame:
    """Failed checks whose settings ask for an e-mail: (check_name, passed).

    ``settings`` is configuration (one row per configured check, a size
    fixed by the workflow's set-up), so it is broadcast."""
    s = F.broadcast(settings.select("check_name", "email"))
    return results.join(s, "check_name", "inner").where(F.col("email") & ~F.col("passed")).select("check_name", "passed")
