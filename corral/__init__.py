"""corral: governed batch ingestion on Spark.

Find newly arrived files, read them with a fixed schema, stage and transform
them, check each row against declared data-quality rules, split good rows from
bad ones, quarantine or stop the load, profile columns, compare source and
target counts, load versioned current and history tables, track increments,
and keep a queryable run log with report tables.

Everything is expressed with the DataFrame API, Spark SQL and the Structured
Streaming file source; Catalyst and AQE pick the physical plans.
"""

from corral.session import build_session, scratch_location, fresh_database

__all__ = ["build_session", "scratch_location", "fresh_database"]
