"""Table-level count checks: source = target, within a threshold, and
against a control file of expected counts per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The stored names of the three table checks.
TABLE_COUNT = "source_target_table_count_validation"
THRESHOLD_COUNT = "source_target_threshold_based_count_validation"
CONTROL_FILE_COUNT = "source_target_control_file_based_count_validation"


def source_target_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (source_count, target_count) from one job: the two inputs are
    projected to a side marker and unioned, so each scan reads no columns and
    a single global aggregate counts both."""
    marked = source.select(F.lit(True).alias("_src")).unionByName(target.select(F.lit(False).alias("_src")))
    return marked.agg(
        F.count_if(F.col("_src")).alias("source_count"),
        F.count_if(~F.col("_src")).alias("target_count"),
    )


def table_count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    c = source_target_counts(source, target)
    return c.select("source_count", "target_count", (F.col("source_count") == F.col("target_count")).alias(TABLE_COUNT))


def threshold_condition(threshold_pct: float):
    """|source - target| is at most ``threshold_pct`` percent of source."""
    return F.abs(F.col("source_count") - F.col("target_count")) * 100 <= F.lit(threshold_pct) * F.col("source_count")


def threshold_count_check(source: DataFrame, target: DataFrame, threshold_pct: float) -> DataFrame:
    c = source_target_counts(source, target)
    return c.select("source_count", "target_count", threshold_condition(threshold_pct).alias(THRESHOLD_COUNT))


def count_checks(source: DataFrame, target: DataFrame, threshold_pct: float) -> DataFrame:
    """Both count checks from the same two counts, as (check_name, passed)."""
    c = source_target_counts(source, target)
    return c.select(
        F.inline(
            F.array(
                F.struct(F.lit(TABLE_COUNT).alias("check_name"), (F.col("source_count") == F.col("target_count")).alias("passed")),
                F.struct(F.lit(THRESHOLD_COUNT).alias("check_name"), threshold_condition(threshold_pct).alias("passed")),
            )
        )
    )


def control_file_check(
    control: DataFrame,
    loaded: DataFrame,
    key: str,
    expected_col: str = "expected_count",
) -> DataFrame:
    """Expected count per file key against the rows loaded per key.

    ``control`` has (key, expected_col); ``loaded`` is the loaded rows with a
    ``key`` column.  The loaded side is aggregated (partially, before the
    shuffle) to one row per key before the join, so only counts move.
    """
    actual = loaded.groupBy(F.col(key).alias("file_key")).agg(F.count(F.lit(1)).alias("actual_count"))
    return reconcile_files(control.select(F.col(key).alias("file_key"), F.col(expected_col).alias("expected_count")), actual)


def reconcile_files(control: DataFrame, actual: DataFrame) -> DataFrame:
    """The control table (file_key, expected_count) against the counted files
    (file_key, actual_count), in both directions: a listed file that did not come
    counts 0 rows, and a file that is not listed fails.  A null or repeated key is
    matched like any other value."""
    a = actual.select(F.col("file_key").alias("_k"), "actual_count")
    joined = control.select("file_key", "expected_count").join(a, F.col("file_key").eqNullSafe(F.col("_k")), "full_outer")
    listed = F.col("expected_count").isNotNull()
    return joined.select(
        F.coalesce("file_key", "_k").alias("file_key"),
        "expected_count",
        "actual_count",
        (listed & (F.col("expected_count") == F.coalesce(F.col("actual_count"), F.lit(0)))).alias(CONTROL_FILE_COUNT),
    )
