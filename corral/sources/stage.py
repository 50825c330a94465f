"""Per-run staging: one database per run in shared scratch.

Each kind of staged data (``raw``, ``files``, ``intermediate``, ``dq``,
``dq_validation``, ``data_profile``) is a parquet table of that database.
A stage begins empty and is nobody else's: its name ends in a random token, so
workflows whose names fold to the same text, runs with the same number and
stages left behind never meet.  Dropping the run's stage drops the database,
which removes all its files.
"""

from __future__ import annotations

import re
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from corral.session import scratch_root, sql_text

RAW = "raw"
FILES = "files"
INTERMEDIATE = "intermediate"
DQ = "dq"
DQ_VALIDATION = "dq_validation"
DATA_PROFILE = "data_profile"


def _ident(text: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", str(text)).lower()


class Stage:
    def __init__(self, spark: SparkSession, workflow: str, run_id: int | str, root: str | None = None):
        self.spark = spark
        self.database = f"stage_{_ident(workflow)}_{_ident(run_id)}_{uuid.uuid4().hex[:12]}"
        self.location = f"{(root or scratch_root(spark)).rstrip('/')}/{self.database}.db"
        spark.sql(f"CREATE DATABASE `{self.database}` LOCATION {sql_text(self.location)}")

    def table_name(self, kind: str) -> str:
        return f"`{self.database}`.`{_ident(kind)}`"

    def save(self, kind: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Overwrite the staged data of ``kind``; the write is one job."""
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.table_name(kind))
        return self.table_name(kind)

    def load(self, kind: str) -> DataFrame:
        return self.spark.table(self.table_name(kind))

    def exists(self, kind: str) -> bool:
        return self.spark.catalog.tableExists(self.table_name(kind))

    def kinds(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database))

    def drop(self) -> None:
        """Delete every staged table of the run and their files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
