"""Column profiling: one aggregate over all columns, unpivoted to one row
per column."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    ByteType,
    DataType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
)


# Names of the observed profile aggregates (prefixed so they never clash
# with other metrics collected in the same pass).
_P = "_prof_"
_ROWS = _P + "rows"


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact_distinct: bool = True,
    relative_sd: float = 0.01,
) -> DataFrame:
    """column_name, row_count, null_count, distinct_count, min_value, max_value.

    Two aggregates over the same scan, each one job-stage:

    - rows, non-null counts, min and max of every column in one global
      aggregate (min/max in the column's own type, shown as text);
    - distinct counts of every column in a second aggregate with only
      distinct counts in it, so Spark plans it as Expand + hash aggregation
      with partial aggregation before the shuffle (a min/max on text in the
      same aggregate would force a sort of every expanded row).

    Both are turned into one row per column and merged by column name (a
    k-row aggregate).  ``exact_distinct=False`` uses HyperLogLog++ instead:
    no expansion at all, one small sketch per partition — the choice for
    very wide or very large tables.
    """
    cols = list(columns or df.columns)
    simple = _simple_rows(df.agg(*simple_metrics(cols)), cols)
    return _merge(simple, _distinct_rows(df, cols, exact_distinct, relative_sd))


def simple_metrics(columns: Sequence[str]) -> list[Column]:
    """The aggregates of the first part of a profile (rows, non-null counts,
    min and max as text).  They are plain aggregates, so they can also be
    collected with ``Dataset.observe`` on a pass that happens anyway, such as
    the write of the validated rows."""
    out = [F.count(F.lit(1)).alias(_ROWS)]
    for i, c in enumerate(columns):
        col = F.col(c)
        out += [
            F.count(col).alias(f"{_P}nn{i}"),
            F.min(col).cast("string").alias(f"{_P}min{i}"),
            F.max(col).cast("string").alias(f"{_P}max{i}"),
        ]
    return out


def profile_with_observed(
    df: DataFrame,
    observed: dict,
    columns: Sequence[str] | None = None,
    exact_distinct: bool = True,
    relative_sd: float = 0.01,
) -> DataFrame:
    """``profile_columns`` when the ``simple_metrics`` of ``df`` were already
    observed (``observed`` holds them by name): only the distinct counts are
    computed, in one aggregate over ``df``."""
    cols = list(columns or df.columns)
    fields = [StructField(_ROWS, LongType())] + [
        StructField(f"{_P}{m}{i}", LongType() if m == "nn" else StringType())
        for i in range(len(cols))
        for m in ("nn", "min", "max")
    ]
    wide = df.sparkSession.createDataFrame([tuple(observed[f.name] for f in fields)], StructType(fields))
    return _merge(_simple_rows(wide, cols), _distinct_rows(df, cols, exact_distinct, relative_sd))


def _simple_rows(wide: DataFrame, cols: list[str]) -> DataFrame:
    null_long = F.lit(None).cast("bigint")
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(_ROWS).alias("row_count"),
                        (F.col(_ROWS) - F.col(f"{_P}nn{i}")).alias("null_count"),
                        null_long.alias("distinct_count"),
                        F.col(f"{_P}min{i}").alias("min_value"),
                        F.col(f"{_P}max{i}").alias("max_value"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )


def _distinct_rows(df: DataFrame, cols: list[str], exact: bool, relative_sd: float) -> DataFrame:
    if exact:
        distinct = [F.count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(cols)]
    else:
        distinct = [F.approx_count_distinct(F.col(c), relative_sd).alias(f"_d{i}") for i, c in enumerate(cols)]
    null_long, null_str = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    return df.agg(*distinct).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        null_long.alias("row_count"),
                        null_long.alias("null_count"),
                        F.col(f"_d{i}").cast("bigint").alias("distinct_count"),
                        null_str.alias("min_value"),
                        null_str.alias("max_value"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )


def _merge(simple: DataFrame, distinct: DataFrame) -> DataFrame:
    return simple.unionByName(distinct).groupBy("column_name").agg(
        F.max("row_count").alias("row_count"),
        F.max("null_count").alias("null_count"),
        F.max("distinct_count").alias("distinct_count"),
        F.max("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """column_name, mean, stddev (sample), min_value, max_value for numeric
    columns, in one aggregate job."""
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(c).cast("double")
        aggs += [
            F.avg(col).alias(f"_mean{i}"),
            F.stddev_samp(col).alias(f"_sd{i}"),
            F.min(col).alias(f"_min{i}"),
            F.max(col).alias(f"_max{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.round(F.col(f"_mean{i}"), digits).alias("mean"),
            F.round(F.col(f"_sd{i}"), digits).alias("stddev"),
            F.col(f"_min{i}").alias("min_value"),
            F.col(f"_max{i}").alias("max_value"),
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*rows)))


def profile_report(profile: DataFrame) -> DataFrame:
    """The profile as shown in the report: without an ``action`` column."""
    return profile.drop("action") if "action" in profile.columns else profile


# --------------------------------------------------------------------------
# Mergeable profiles: one small row per column and load, merged without the rows
# --------------------------------------------------------------------------

SKETCH_SCHEMA = StructType(
    [
        StructField("column_name", StringType()),
        StructField("data_type", StringType()),
        StructField("row_count", LongType()),
        StructField("null_count", LongType()),
        StructField("min_value", StringType()),
        StructField("max_value", StringType()),
        StructField("distinct_sketch", BinaryType()),
    ]
)
#: 2 ** 12 registers: a relative standard error of about 1.6 %, 4 KB a sketch at most.
LG_REGISTERS = 12
_S = "_sketch_"


def _sketched(column: str, dtype: DataType) -> Column:
    """The column in a type that the sketch takes; equal values stay equal, others differ."""
    col = F.col("`" + column.replace("`", "``") + "`")
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return col.cast("bigint")
    return col if isinstance(dtype, (StringType, BinaryType)) else col.cast("string")


def sketch_metrics(schema: StructType) -> list[Column]:
    """Aggregates of a mergeable profile: rows, non-null counts, min, max and one
    distinct-count sketch per column, to be observed on a write or aggregated; no
    row is expanded and nothing but the sketches is shuffled."""
    out = [F.count(F.lit(1)).alias(f"{_S}rows")]
    for i, f in enumerate(schema.fields):
        col = F.col("`" + f.name.replace("`", "``") + "`")
        out += [
            F.count(col).alias(f"{_S}nn{i}"),
            F.min(col).cast("string").alias(f"{_S}min{i}"),
            F.max(col).cast("string").alias(f"{_S}max{i}"),
            F.hll_sketch_agg(_sketched(f.name, f.dataType), F.lit(LG_REGISTERS)).alias(f"{_S}hll{i}"),
        ]
    return out


def sketch_rows(spark: SparkSession, schema: StructType, observed: Mapping) -> DataFrame:
    """One row per column (``SKETCH_SCHEMA``) from the values of ``sketch_metrics``."""
    n = observed[f"{_S}rows"]
    rows = [
        (
            f.name,
            f.dataType.simpleString(),
            n,
            n - observed[f"{_S}nn{i}"],
            observed[f"{_S}min{i}"],
            observed[f"{_S}max{i}"],
            bytearray(observed[f"{_S}hll{i}"]) if observed[f"{_S}hll{i}"] is not None else None,
        )
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, SKETCH_SCHEMA)


def sketch_profile(df: DataFrame) -> DataFrame:
    """The mergeable profile of ``df`` in one aggregate."""
    return sketch_rows(df.sparkSession, df.schema, df.agg(*sketch_metrics(df.schema)).first().asDict())


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """column_name, data_type, row_count, null_count, distinct_count, min_value,
    max_value over all rows behind ``sketches`` (``SKETCH_SCHEMA``, any number of
    loads), without reading them.  Distinct counts are estimates (see
    ``LG_REGISTERS``), the rest is exact; min and max compare as the column's
    type does.  A column that changed its type has a row per type."""
    number = F.col("data_type").rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")

    def order(value: str) -> Column:
        # numbers by size (doubles first: decimals settle what a double cannot tell apart), the rest as text
        as_number = lambda t: F.when(number, F.expr(f"try_cast({value} AS {t})"))
        known = F.struct(as_number("double"), as_number("decimal(38,10)"), F.when(~number, F.col(value)))
        return F.when(F.col(value).isNotNull(), known)

    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch", F.lit(True))).alias("distinct_count"),
        F.min_by("min_value", order("min_value")).alias("min_value"),
        F.max_by("max_value", order("max_value")).alias("max_value"),
    )
