"""Session set-up and shared scratch storage.

Scratch data (stages, checkpoints, per-run databases) lives under the shared
folder the cluster names in ``spark.checkpoint.dir``.  A local folder is only
made when that setting is unset *and* the session runs in local mode, as in
tests; on a cluster an unset checkpoint dir is an error, because a
machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings that matter for this library's plans.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "corral",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a SparkSession with the settings the plans expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: the session's checkpoint dir.

    Reads ``spark.checkpoint.dir`` (or a dir set with ``setCheckpointDir``);
    sets a local one only for local-mode sessions where it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(for example an object-store or HDFS path) visible to all executors"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="corral-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_location(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting ``name`` is ``value`` inside the block, and as before after it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def sql_text(value: str) -> str:
    """A value as a SQL string literal (quotes and backslashes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fresh_database(spark: SparkSession, prefix: str) -> str:
    """Create a uniquely named database whose location is in shared scratch."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    return ensure_database(spark, name)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create ``name`` if missing, by default under shared scratch."""
    location = location or f"{scratch_root(spark)}/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION {sql_text(location)}")
    return name
