"""File discovery: list, match, pick the latest or all new files, watermark.

A listing is any DataFrame with ``path`` (string) and ``last_modified``
(timestamp).  ``list_files`` builds one from a folder with the ``binaryFile``
source restricted to ``path`` and ``modificationTime``, so file contents are
never read and Spark lists large folders in parallel.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from corral.functions.scalar import utc_wall_clock

# Text form in which a file watermark is stored and compared.
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# Listing column with the full URI of the listed root (``with_root=True``).
ROOT_URI = "root_uri"
SIZE = "file_size"


class NoNewFileError(RuntimeError):
    """Raised when no file is newer than the stored watermark."""


def list_files(
    spark: SparkSession,
    root: str,
    relative: bool = True,
    with_root: bool = False,
    folder: str = "",
    with_size: bool = False,
) -> DataFrame:
    """(path, last_modified) of every file under ``root``, recursively, with
    ``with_size`` also ``file_size`` in bytes.

    With ``relative`` the path is the key below ``root`` (as object-store keys
    are below a container); otherwise the full URI.  ``folder`` (a key
    prefix ending at a ``/``, see ``pattern_folder``) lists only below
    ``root/folder``; keys stay relative to ``root``, and a missing folder
    is an empty listing.
    """
    location = join_key(root, folder)
    try:
        raw = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(location)
            .select("path", F.col("modificationTime").alias("last_modified"), F.col("length").alias(SIZE))
        )
    except AnalysisException as e:
        if not folder or (e.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame(
            [],
            StructType(
                [StructField("path", StringType()), StructField("last_modified", TimestampType()), StructField(SIZE, LongType())]
            ),
        )
    size = [SIZE] if with_size else []
    if not relative:
        return raw.select("path", "last_modified", *size)
    extra = [root_uri(F.col("path"), root).alias(ROOT_URI)] if with_root else []
    return raw.select(relative_key(F.col("path"), root).alias("path"), "last_modified", *extra, *size)


def pattern_folder(pattern: str) -> str:
    """The deepest folder every key matching ``pattern`` lies in: the text
    before the first ``*`` up to its last ``/`` (``''`` for the root).  A
    run lists and scans only there, as a prefix listing of the pattern would,
    instead of every feed under a shared landing root."""
    return pattern.split("*", 1)[0].rpartition("/")[0]


def join_key(root: str, folder: str) -> str:
    return f"{root.rstrip('/')}/{folder}" if folder else root


def _marker(root: str) -> str:
    return root.split("://", 1)[-1].lstrip("/").rstrip("/") + "/"


def relative_key(path: Column, root: str) -> Column:
    """The part of a full file URI below ``root``."""
    marker = _marker(root)
    return F.substr(path, F.instr(path, marker) + F.lit(len(marker)))


def root_uri(path: Column, root: str) -> Column:
    """The part of a full file URI up to and including ``root``, as the file
    system qualified it (scheme, authority), with a closing ``/``."""
    marker = _marker(root)
    return F.substr(path, F.lit(1), F.instr(path, marker) + F.lit(len(marker) - 1))


def decode_uri_text(text: Column) -> Column:
    """Undo the URI encoding of a scan's file path or name (a space is
    ``%20``, ``%`` is ``%25``, a literal ``+`` stays).  ``url_decode`` would
    read that ``+`` as a space, so it is protected first."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def scan_file_path() -> Column:
    """A file scan's ``_metadata.file_path`` in the form a listing gives it."""
    return decode_uri_text(F.col("_metadata.file_path"))


def scan_file_name() -> Column:
    """``_metadata.file_name``, decoded like ``scan_file_path``."""
    return decode_uri_text(F.col("_metadata.file_name"))


# Characters a file URI keeps as they are (a fixed subset of the ones
# java.net.URI leaves unquoted in a path).  When the root and the pattern
# use only these, matching the encoded scan path gives the same answer as
# matching the decoded one, and the per-row decoding is skipped.
_URI_PLAIN = re.compile(r"[A-Za-z0-9._/*=@-]*")


def _plain(text: str) -> bool:
    return _URI_PLAIN.fullmatch(text) is not None


def _same_on_encoded(pattern: str) -> bool:
    """Matching a plain ``pattern`` against encoded keys gives the decoded
    answer.  A part after a ``*`` may match anywhere, so it could start
    inside an escape (``%20b.csv`` ends with ``20b.csv``, while ``" b.csv"``
    does not): that cannot happen when no such part starts with a hex
    digit as escapes write them (``java.net.URI`` quotes with upper-case
    hex).  The first part is anchored at the start and is safe."""
    return all(not part or part[0] not in "0123456789ABCDEF" for part in pattern.split("*")[1:])


# A qualified root may also hold the scheme's and the port's ``:``.
_URI_PLAIN_ROOT = re.compile(r"[A-Za-z0-9._/=@:-]*")


def blob_key(file_location: str) -> str:
    """Drop the first segment (the container) of a configured location."""
    parts = file_location.split("/")
    return "/".join(parts[1:]) if len(parts) > 1 else file_location


def glob_condition(pattern: str, path: Column | str = "path") -> Column:
    """Match condition for a location pattern.

    No ``*``: the path starts with the pattern.  One ``*`` (``a*b``): starts
    with ``a`` and ends with ``b`` (``*`` may cross ``/``, as in a key prefix
    listing).  More ``*``: the parts appear in order, anchored at both ends.
    """
    p = F.col(path) if isinstance(path, str) else path
    if "*" not in pattern:
        return p.startswith(pattern)
    parts = pattern.split("*")
    if len(parts) == 2:
        head, tail = parts
        cond = p.startswith(head)
        return cond & p.endswith(tail) if tail else cond
    quoted = [f"\\Q{s}\\E" if s else "" for s in parts]
    return p.rlike("^" + ".*".join(quoted) + "$")


def _glob_below(pattern: str, prefix: str, path: Column) -> Column:
    """``glob_condition(pattern)`` on the key below ``prefix``, evaluated on
    the full ``path`` (which starts with ``prefix``) without cutting the key
    out: prefix tests, suffix tests and one length test, no substring."""
    if "*" not in pattern:
        return path.startswith(prefix + pattern)
    parts = pattern.split("*")
    if len(parts) == 2:
        head, tail = parts
        cond = path.startswith(prefix + head)
        if tail:
            # the key ends with tail: so does the path, and the key is long enough
            cond = cond & path.endswith(tail) & (F.length(path) >= F.lit(len(prefix) + len(tail)))
        return cond
    return glob_condition(prefix + pattern, path)


def match_glob(listing: DataFrame, pattern: str) -> DataFrame:
    return listing.where(glob_condition(pattern))


def latest_file(listing: DataFrame) -> DataFrame:
    """The newest file; ties on time are broken by path so runs repeat."""
    return listing.orderBy(F.col("last_modified").desc(), F.col("path").asc()).limit(1)


def _utc(listing: DataFrame, col: Column | None = None) -> Column:
    """``last_modified`` as UTC wall-clock time (timestamp_ntz).  A zoned
    timestamp (as file listings give) is converted from the session zone;
    a timestamp_ntz is taken to be UTC already.  Watermarks are stored and
    compared in this form, so a later run in another session zone reads
    them the same way."""
    col = F.col("last_modified") if col is None else col
    if isinstance(listing.schema["last_modified"].dataType, TimestampType):
        return utc_wall_clock(col, listing.sparkSession)
    return col


def new_files_since(listing: DataFrame, watermark: str | None) -> DataFrame:
    """Every file strictly newer than ``watermark`` (UTC text; all files when
    None)."""
    if watermark is None or watermark == "":
        return listing
    return listing.where(_utc(listing) > F.lit(watermark).cast("timestamp_ntz"))


def unseen_files(listing: DataFrame, ledger: DataFrame, since: str | None) -> DataFrame:
    """Files at or above ``since`` (UTC text; all when None) that the ledger of
    loaded files (file_key, last_modified in UTC, file_size) does not hold.

    A store with whole-second times gives many files one time, so the watermark's
    own second is not done when its first files are loaded.  A file written anew
    under its old name has another time or size, and is a new file.
    """
    at = _utc(listing)
    if since:
        bound = F.lit(since).cast("timestamp_ntz")
        listing, ledger = listing.where(at >= bound), ledger.where(F.col("last_modified") >= bound)
    seen = ledger.select(F.col("file_key").alias("_k"), F.col("last_modified").alias("_t"), F.col(SIZE).alias("_s"))
    same = F.col("path").eqNullSafe(F.col("_k")) & at.eqNullSafe(F.col("_t")) & F.col(SIZE).eqNullSafe(F.col("_s"))
    return listing.join(seen, same, "left_anti")


def in_utc(listing: DataFrame) -> DataFrame:
    """The listing with ``last_modified`` as UTC wall-clock time, as the ledger holds it."""
    return listing.withColumn("last_modified", _utc(listing))


def file_watermark(files: DataFrame) -> DataFrame:
    """One row: newest time (the next watermark) and the number of files."""
    return files.agg(
        F.max("last_modified").alias("last_load_file_detail"),
        F.count(F.lit(1)).alias("source_file_count"),
    )


@dataclass(frozen=True)
class FileSelection:
    """The files of one run, as a condition rather than a list of paths.

    Collation: the keys matching ``pattern`` modified after ``since`` and no
    later than ``watermark`` (the newest chosen time, the next stored
    watermark, so a file arriving after the choice waits for the next run),
    and ``late`` files that came at ``since`` itself after the run before.
    Latest-file mode: the one key ``latest``.  ``files`` applies the
    condition to a listing; ``scan_condition`` applies it to the hidden
    ``_metadata`` of a file scan, where Spark uses it to skip files before
    reading them, so no path list passes through the driver.
    """

    pattern: str
    since: str | None  # stored watermark (exclusive), UTC wall-clock text
    watermark: str  # newest chosen time (inclusive), UTC wall-clock text
    file_count: int
    latest: str | None = None  # latest-file mode: the chosen key
    root_uri: str | None = None  # qualified URI of the listed root, when the listing had it
    late: int = 0  # chosen files whose time is ``since`` itself (chosen by a ledger)

    def _condition(self, key: Column, modified_utc: Column) -> Column:
        if self.latest is not None:
            return key == F.lit(self.latest)
        return self._condition_on(glob_condition(self.pattern, key), modified_utc)

    def _condition_on(self, matched: Column, modified_utc: Column) -> Column:
        cond = matched & (modified_utc <= F.lit(self.watermark).cast("timestamp_ntz"))
        if self.since:
            cond = cond & (modified_utc > F.lit(self.since).cast("timestamp_ntz"))
        return cond

    def _scan_window(self, matched: Column, spark: SparkSession) -> Column:
        """The time window on the scan's modification time (an instant):
        compared with the bounds as instants, parsed once here, so no row
        goes through a zone conversion.  Bounds in a form Python cannot
        parse fall back to converting each row's time."""
        bounds = [_utc_instant(self.watermark)] + ([_utc_instant(self.since)] if self.since else [])
        modified = F.col("_metadata.file_modification_time")
        if any(b is None for b in bounds):
            return self._condition_on(matched, utc_wall_clock(modified, spark))
        cond = matched & (modified <= F.lit(bounds[0]))
        if self.since:
            cond = cond & (modified > F.lit(bounds[1]))
        return cond

    def files(self, listing: DataFrame) -> DataFrame:
        """The chosen rows of a (path, last_modified) listing."""
        return listing.where(self._condition(F.col("path"), _utc(listing)))

    def scan_condition(self, root: str, spark: SparkSession) -> Column:
        """The same choice on a file scan of ``root`` (read recursively).

        Spark evaluates it once per file to skip files, and again on every
        row read, so the row-level cost is kept low.  When the root and the
        pattern have no character a URI encodes, the scan path is used as it
        is; with the qualified root from the listing (``with_root=True``) the
        key is then matched through prefix and suffix tests on the whole
        path, with no search or substring per row.  Otherwise the path is
        decoded and the key cut out."""
        chosen = self.latest if self.latest is not None else self.pattern
        plain = _plain(_marker(root)) and _plain(chosen) and (self.latest is not None or _same_on_encoded(chosen))
        if plain and self.root_uri and _URI_PLAIN_ROOT.fullmatch(self.root_uri):
            path = F.col("_metadata.file_path")
            if self.latest is not None:
                return path == F.lit(self.root_uri + self.latest)
            return self._scan_window(_glob_below(self.pattern, self.root_uri, path), spark)
        key = relative_key(F.col("_metadata.file_path") if plain else scan_file_path(), root)
        if self.latest is not None:
            return key == F.lit(self.latest)
        return self._scan_window(glob_condition(self.pattern, key), spark)

    def at_mark(self, spark: SparkSession) -> Column:
        """Condition on a file scan: the file's time is ``since`` itself."""
        modified, instant = F.col("_metadata.file_modification_time"), _utc_instant(self.since)
        if instant is not None:
            return modified == F.lit(instant)
        return utc_wall_clock(modified, spark) == F.lit(self.since).cast("timestamp_ntz")

    @property
    def described(self) -> str:
        """The chosen files in words for the run log: the key, or the pattern."""
        return self.latest if self.latest is not None else self.pattern


def _utc_instant(text: str) -> datetime | None:
    """UTC wall-clock text (``WATERMARK_FORMAT`` or another ISO form) as an
    aware datetime, which Spark takes as that exact instant."""
    try:
        parsed = datetime.fromisoformat(text)
    except ValueError:
        return None
    return None if parsed.tzinfo is not None else parsed.replace(tzinfo=timezone.utc)


def choose_files(
    listing: DataFrame,
    pattern: str,
    watermark: str | None = None,
    collation: bool = False,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Rows of the listing that one run reads.

    ``collation``: all matching files newer than ``watermark``; otherwise the
    latest matching file, which must be newer than ``watermark``.  With a
    ``ledger`` of loaded files (and ``file_size`` in the listing) a file counts as
    new when the ledger does not hold it, at the watermark's own time as well.
    """
    matched = match_glob(listing, pattern)
    if ledger is not None:
        unseen = unseen_files(matched, ledger, watermark)
        return unseen if collation else latest_file(unseen)
    return new_files_since(matched, watermark) if collation else new_files_since(latest_file(matched), watermark)


def selection_of(chosen: DataFrame, pattern: str, watermark: str | None = None, collation: bool = False) -> FileSelection:
    """The condition that stands for ``chosen``; raises ``NoNewFileError`` when it has
    no file.  One aggregate row (newest time, counts, and in latest-file mode the
    one key) reaches the driver."""
    late = _utc(chosen) == F.lit(watermark).cast("timestamp_ntz") if watermark else F.lit(False)
    aggs = [
        F.date_format(_utc(chosen, F.max("last_modified")), WATERMARK_FORMAT).alias("wm"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(late).alias("late"),
    ]
    if not collation:
        aggs.append(F.max("path").alias("latest"))
    if ROOT_URI in chosen.columns:
        aggs.append(F.min(ROOT_URI).alias(ROOT_URI))
    agg = chosen.agg(*aggs).first()
    if not agg or agg["n"] == 0:
        raise NoNewFileError("Load from source failed: no new file has arrived")
    latest = None if collation else agg["latest"]
    root = agg[ROOT_URI] if ROOT_URI in chosen.columns else None
    return FileSelection(pattern, watermark or None, agg["wm"], int(agg["n"]), latest, root, int(agg["late"]))


def select_files(
    listing: DataFrame,
    pattern: str,
    watermark: str | None = None,
    collation: bool = False,
    ledger: DataFrame | None = None,
) -> FileSelection:
    """Choose the files of one run (``choose_files``), as a condition."""
    return selection_of(choose_files(listing, pattern, watermark, collation, ledger), pattern, watermark, collation)


def watermark_text(files: DataFrame) -> str | None:
    """Newest ``last_modified`` as stored text (UTC wall clock)."""
    row = files.agg(F.date_format(_utc(files, F.max("last_modified")), WATERMARK_FORMAT).alias("wm")).first()
    return row["wm"] if row else None
