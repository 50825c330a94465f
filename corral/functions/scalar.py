"""Scalar column helpers used across steps (all built-in expressions)."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Text form of the load time, and the report clock format.
AUDIT_TIME_FORMAT = "%Y-%m-%dT%H:%M:%S.000+00:00"
REPORT_CLOCK = "hh:mm a"
CLOCK_WITH_ZONE = "%I:%M %p %Z"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def audit_time_text(now: datetime | None = None) -> str:
    """The load time as text, in UTC: one fixed value for the whole run."""
    now = now or datetime.now(timezone.utc)
    return now.astimezone(timezone.utc).strftime(AUDIT_TIME_FORMAT)


def utc_wall_clock(ts: str | Column, spark: SparkSession) -> Column:
    """An instant (timestamp) as its UTC wall-clock time (timestamp_ntz),
    whatever the session time zone is."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def text_to_timestamp(text: str, spark: SparkSession, zoned: bool = False) -> Column:
    """Constant time from text such as ``2024-01-01T10:00:00.000+00:00``.

    ``zoned=False`` (default) gives the UTC wall-clock as timestamp_ntz, like
    the data tables; ``zoned=True`` gives a timestamp (instant)."""
    instant = F.lit(text).cast("timestamp")
    return instant if zoned else utc_wall_clock(instant, spark)


def local_clock(ts: str | Column, zone: str, fmt: str = REPORT_CLOCK) -> Column:
    """Format a UTC wall-clock time (timestamp_ntz) as local clock text."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts)), fmt)


def clock_text(t: datetime | None, zone: str) -> str | None:
    """A UTC time of the driver as local clock text with the zone's short name at that time."""
    if t is None:
        return None
    utc = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t
    return utc.astimezone(ZoneInfo(zone)).strftime(CLOCK_WITH_ZONE)


def json_field(doc: str | Column, key: str, data_type: str = "string") -> Column:
    """One field of a JSON text column, cast to ``data_type`` (null if absent)."""
    v = F.get_json_object(_c(doc), f"$.{key}")
    return v if data_type == "string" else v.try_cast(data_type)


def table_name_from_path(path: str | Column) -> Column:
    """Last ``/`` part of a path, up to its first ``.``."""
    return F.substring_index(F.substring_index(_c(path), "/", -1), ".", 1)


def table_name_from_location(location: str) -> str:
    """Same rule on a configured location string."""
    return location.split("/")[-1].split(".")[0]
