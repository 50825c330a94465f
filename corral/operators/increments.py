"""Increment tracking: high-water marks of key columns and the filtered
extract of the next run.

Marks are stored as text with the type of their column; a time is stored in
UTC, so a later run in another session zone reads the same instant.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampType

MARK = "__mark_{}"
# Rows that no key tells to be new or old (no key above its mark, one of them null).
READ_UNDECIDED, LEAVE_UNDECIDED = "read", "leave"


@dataclass(frozen=True)
class IncrementSetting:
    key_column: str
    consider_max_val: bool = True
    value: str | None = None  # stored mark, as text
    data_type: str | None = None  # type of the column the mark was taken from (a run stores it)


def _key(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _greatest(key: Column, dtype: DataType) -> Column:
    """Aggregate: the greatest key as text; an instant as its UTC wall clock, to the microsecond."""
    if not isinstance(dtype, TimestampType):
        return F.max(key).cast("string")
    seconds = (F.max(F.unix_micros(key)) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).cast("string")


def tracked(settings: Sequence[IncrementSetting]) -> list[IncrementSetting]:
    return [s for s in settings if s.consider_max_val]


def mark_metrics(settings: Sequence[IncrementSetting], schema: StructType) -> list[Column]:
    """One aggregate per tracked key (``MARK`` names), for ``observe`` on a write that
    happens anyway or for an aggregation."""
    return [_greatest(_key(s.key_column), schema[s.key_column].dataType).alias(MARK.format(i)) for i, s in enumerate(tracked(settings))]


def observed_marks(
    settings: Sequence[IncrementSetting], schema: StructType, observed: Mapping[str, str | None]
) -> list[IncrementSetting]:
    """``settings`` with the marks of ``mark_metrics``; untracked ones and keys
    without any value stay as they are."""
    found = {s.key_column: observed[MARK.format(i)] for i, s in enumerate(tracked(settings))}
    return [
        replace(s, value=found[s.key_column], data_type=schema[s.key_column].dataType.simpleString())
        if found.get(s.key_column) is not None
        else s
        for s in settings
    ]


def high_water_marks(df: DataFrame, settings: Sequence[IncrementSetting]) -> DataFrame:
    """(key_column, value): max of each tracked key, as text; one aggregate
    job for all keys."""
    keys = tracked(settings)
    if not keys:
        return df.sparkSession.createDataFrame([], "key_column string, value string")
    wide = df.agg(*mark_metrics(settings, df.schema))
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s.key_column).alias("key_column"), F.col(MARK.format(i)).alias("value"))
                    for i, s in enumerate(keys)
                ]
            )
        )
    )


def advance(df: DataFrame, settings: Sequence[IncrementSetting]) -> list[IncrementSetting]:
    """New settings with each tracked mark set from ``df`` (one small row to
    the driver); untracked settings are kept as they are."""
    metrics = mark_metrics(settings, df.schema)
    return observed_marks(settings, df.schema, df.agg(*metrics).first().asDict()) if metrics else list(settings)


def with_stored_marks(settings: Sequence[IncrementSetting], stored) -> list[IncrementSetting]:
    """``settings`` with the marks that a run stored (a list of dicts, or None):
    a stored mark replaces the configured one of a tracked key."""
    marks = {m["key_column"]: m for m in stored or []}

    def pick(s: IncrementSetting) -> IncrementSetting:
        m = marks.get(s.key_column) if s.consider_max_val else None
        return s if m is None or m.get("value") is None else replace(s, value=m["value"], data_type=m.get("data_type"))

    return [pick(s) for s in settings]


def mark_literal(setting: IncrementSetting, dtype: DataType) -> Column:
    """The mark as a literal of the key's type.  A stored time is UTC; a configured
    one (no ``data_type``) is read as Spark reads text, in the session zone."""
    utc = isinstance(dtype, TimestampType) and setting.data_type in ("timestamp", "timestamp_ntz")
    return F.lit(f"{setting.value}+00:00" if utc else setting.value).cast(dtype)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def frontier(settings: Sequence[IncrementSetting], schema: StructType) -> tuple[Column, Column] | None:
    """``(newer, undecided)`` of a row against the stored marks, None without any.

    A row is newer if any key is above its mark.  It is undecided if none is
    and some key is null: nothing tells whether an earlier run read it.  Both
    are plain comparisons with literals, so a scan can take them as filters.
    """
    marked = [s for s in settings if s.value is not None]
    if not marked:
        return None
    above = [_key(s.key_column) > mark_literal(s, schema[s.key_column].dataType) for s in marked]
    newer = F.coalesce(_any(above), F.lit(False))
    return newer, ~newer & _any([_key(s.key_column).isNull() for s in marked])


def incremental_filter(
    df: DataFrame, settings: Sequence[IncrementSetting], undecided: str = READ_UNDECIDED
) -> DataFrame:
    """Rows above the mark of any key, and (unless ``undecided`` is ``leave``) those
    with a null key.  One predicate of literals of the keys' types, which is
    pushed into a parquet or JDBC scan and prunes partitions."""
    marked = [s for s in settings if s.value is not None]
    if not marked:
        return df
    above = [_key(s.key_column) > mark_literal(s, df.schema[s.key_column].dataType) for s in marked]
    if undecided not in (READ_UNDECIDED, LEAVE_UNDECIDED):
        raise ValueError(f"undecided rows are read or left, not {undecided!r}")
    nulls = [_key(s.key_column).isNull() for s in marked] if undecided == READ_UNDECIDED else []
    return df.where(_any([*above, *nulls]))
