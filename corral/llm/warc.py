"""WARC archives: written by Spark's text writer, read back by boundary chains.

A reader that starts in the middle of a file finds record starts by their magic
line, but a payload may hold that line too.  So every task turns each magic
line of its split into a candidate link (its offset, and the offset right after
the record that its header announces).  The links are followed from offset 0
of each file: inside a split by the task itself, across splits by pointer
jumping.  Only records that are reached are kept, whatever payloads hold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corral.llm.common import map_batches, staged

# The magic line, line end and record end of the file format.
MAGIC = "WARC/1.1\r\n"
EOL = "\r\n"
RECORD_END = b"\r\n\r\n"
RESPONSE, REVISIT = "response", "revisit"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
LEAST_REVISIT_BYTES = 100

_CANDIDATES = (
    "file string, block long, split_bytes long, at long, next long, whole boolean, leaves long, rank long, rank_end long, "
    "record_type string, record_id string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
_PARSED = ("record_type", "record_id", "refers_to", "payload_bytes", "payload_digest", "payload")


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(EOL)) for name, value in pairs]
    return F.concat(*[F.coalesce(line, F.lit("")) for line in lines])


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """One record text per page, whole but for its closing line end.

    Of pages with equal payloads of at least 100 bytes those with the smallest
    id are responses; the others are revisits of it, with the headers of the
    response and no payload.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20\x7F]+", "%20").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    # one row per repeated payload, aggregated before it is shuffled; written out, so
    # that its size is known before the payloads are joined with it
    repeated = staged(
        rows.where(F.col("n_bytes") >= LEAST_REVISIT_BYTES)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select("same", "first_id"),
        "warc_repeated",
    )
    joined = rows.join(repeated, F.col("digest") == F.col("same"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}"),
        _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("n_bytes").cast("string"))),
        F.lit(EOL),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    header = _lines(
        ("WARC-Type", F.when(revisit, F.lit(REVISIT)).otherwise(F.lit(RESPONSE))),
        ("WARC-Record-ID", _record_id(F.col("page_id"))),
        ("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(revisit, _record_id(F.col("first_id")))),
        ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    )
    return joined.select("*", block.alias("block")).select(
        F.concat(F.lit(MAGIC), header, F.lit(EOL), F.col("block"), F.lit(EOL)).alias("value")
    )


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write the pages as WARC files below ``path``, committed by Spark.

    A null payload is empty, a null url has no line (white space and control
    characters in a url, which a header line cannot hold, become ``%20``).  A
    page without an id may revisit another one, but none revisits it.  Pages
    that share an id are records of their own.  Other columns, whatever their
    names, are left behind.
    """
    records(pages, id_col, url_col, payload_col).write.option("lineSep", EOL).text(path)


# --------------------------------------------------------------------------
# Reading: candidates of each split
# --------------------------------------------------------------------------

_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*$")


def _fields(head: bytes) -> dict[bytes, bytes]:
    found = (_FIELD.match(line) for line in head.split(b"\r\n"))
    return {m[1].lower(): m[2] for m in found if m}


def _number(text: bytes | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(rb"[0-9]{1,18}", text) else None


def _bare_id(text: bytes | None) -> str | None:
    return None if text is None else text.decode("utf-8", "replace").strip("<>").removeprefix(ID_PREFIX)


def _announced(segment: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Fields, start of the block and block length that the header at the start of
    ``segment`` (what follows a magic line) announces; None if there is none."""
    end = segment.find(RECORD_END)
    if end < 0:
        return None
    fields = _fields(segment[:end])
    length = _number(fields.get(b"content-length"))
    return None if length is None else (fields, end + 4, length)


def _parsed(fields: dict[bytes, bytes], block: bytes, with_payload: bool) -> dict:
    """Columns of a record: length and digest of the payload that is there, or, of a
    revisit, those that its headers give."""
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    at = block.find(RECORD_END)
    payload = block[at + 4 :] if at >= 0 else block
    n_bytes, digest = len(payload), hashlib.sha256(payload).hexdigest()
    if kind == REVISIT:
        n_bytes = _number(_fields(block[:at]).get(b"content-length")) if at >= 0 else None
        digest = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha256:")
    return {
        "record_type": kind,
        "record_id": _bare_id(fields.get(b"warc-record-id")),
        "refers_to": _bare_id(fields.get(b"warc-refers-to")),
        "payload_bytes": n_bytes,
        "payload_digest": digest,
        "payload": payload if with_payload and kind != REVISIT else None,
    }


def local_chains(at: list[int], following: list[int | None]) -> tuple[list[int | None], list[int], list[int]]:
    """For the candidates of one split, by offset: where the chain through each
    leaves the split (None: nowhere), and its place in the forest of links.

    Every link goes forward, so the links form trees whose roots leave the
    split.  ``rank`` numbers the trees' nodes from the root; a candidate lies
    on the chain that starts at ``e`` exactly if ``rank <= rank(e) < rank_end``.
    """
    number = {offset: i for i, offset in enumerate(at)}
    parent = [number.get(n, -1) if n is not None else -1 for n in following]
    size = [1] * len(at)
    for i, p in enumerate(parent):  # children stand before their parents
        if p >= 0:
            size[p] += size[i]
    leaves, rank, free, top = list(following), [0] * len(at), [0] * len(at), 0
    for i in range(len(at) - 1, -1, -1):
        p = parent[i]
        if p >= 0:
            leaves[i], rank[i] = leaves[p], free[p]
            free[p] += size[i]
        else:
            rank[i] = top
            top += size[i]
        free[i] = rank[i] + 1
    return leaves, rank, [r + s for r, s in zip(rank, size)]


class _Split:
    """Candidates of one split, offsets counted from the split's first segment."""

    def __init__(self, file: str, block: int, with_payload: bool):
        self.file, self.block, self.with_payload = file, block, with_payload
        self.rows: list[dict] = []
        self.end = 0
        self.open = False  # the first segment of a file follows no magic line

    def add(self, segment: bytes) -> None:
        if self.open or self.block > 0:
            self._candidate(self.end - len(MAGIC), segment)
        self.open = True
        self.end += len(segment) + len(MAGIC)

    def _candidate(self, at: int, segment: bytes) -> None:
        found = _announced(segment)
        row = dict.fromkeys(_PARSED) | {"at": at, "next": None, "whole": False}
        if found:
            fields, start, length = found
            stop = start + length
            row["next"] = at + len(MAGIC) + stop + len(RECORD_END)
            if stop + len(RECORD_END) <= len(segment):
                if stop + len(RECORD_END) == len(segment) and segment.endswith(RECORD_END):
                    row |= {"whole": True} | _parsed(fields, segment[start:stop], self.with_payload)
                else:
                    row["next"] = None  # what follows the announced end is no record
        self.rows.append(row)

    def columns(self) -> dict:
        leaves, rank, rank_end = local_chains([r["at"] for r in self.rows], [r["next"] for r in self.rows])
        names = ("at", "next", "whole", *_PARSED)
        out = {k: [None, *(r[k] for r in self.rows)] for k in names}  # the first row tells the split's length
        n = len(self.rows)
        return out | {
            "file": [self.file] * (n + 1),
            "block": [self.block] * (n + 1),
            "split_bytes": [self.end] + [None] * n,
            "leaves": [None, *leaves],
            "rank": [None, *rank],
            "rank_end": [None, *rank_end],
        }


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magic lines, in file order inside each split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").cast("long").alias("block"),
        F.col("value").cast("binary").alias("segment"),
    )


def candidates(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per magic line, and one per split with the bytes of its segments.  A task
    holds the links of one split at a time (and its payloads, if they are asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        split = None
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            for file, block, segment in zip(files, blocks, batch.column("segment")):
                if split is None or (split.file, split.block) != (file, block):
                    if split is not None:
                        yield split.columns()
                    split = _Split(file, block, with_payload)
                split.add(segment.as_py())
        if split is not None:
            yield split.columns()

    return map_batches(_segments(spark, path), run, _CANDIDATES)


# --------------------------------------------------------------------------
# Reading: chains across splits
# --------------------------------------------------------------------------


class BrokenArchiveError(ValueError):
    """A file whose chain of records does not end at its end."""


def _splits(found: DataFrame) -> DataFrame:
    """(file, block, base, file_bytes): where the segments of each split begin.  Every
    byte belongs to one segment or magic line, so bases are running sums; the last
    segment of a file has no magic line after it."""
    order = Window.partitionBy("file").orderBy("block")
    whole = Window.partitionBy("file")
    n = F.col("split_bytes")
    return found.where(n.isNotNull()).select(
        "file",
        "block",
        (F.sum(n).over(order) - n).alias("base"),
        (F.sum(n).over(whole) - len(MAGIC)).alias("file_bytes"),
    )


def reached(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, at) reached from ``starts`` (file, at) along ``links`` (file, at, to), and
    for each start the end of its chain, by pointer jumping: every round doubles
    the length of all links, so a chain of n takes log2(n) rounds.  Returns
    (file, at, ends): ``ends`` is null but for starts."""
    seen, jump = starts.select("file", "at"), links.select("file", "at", "to")
    while True:
        more = seen.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        seen = seen.union(more).distinct()
        onward = jump.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        doubled = staged(jump.join(onward, ["file", "to"], "left"), "warc_links")
        if doubled.where("beyond is not null").isEmpty():
            break
        seen = staged(seen, "warc_reached")
        jump = doubled.select("file", "at", F.coalesce("beyond", "to").alias("to"))
    ends = starts.join(jump, ["file", "at"], "left").select("file", "at", F.col("to").alias("ends"))
    return seen.join(ends, ["file", "at"], "left")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the WARC files below ``path``: (file, at, record_type, record_id,
    refers_to, payload_bytes, payload_digest, payload).

    Length and digest are those of the payload that was read; of a revisit, those
    of the payload that it stands for, from its headers.  A file whose chain does
    not lead from its first byte to its last is an error, as is one without a
    record at its start; empty files and folders have no records.
    """
    found = staged(candidates(spark, path, with_payload), "warc_candidates")
    splits = staged(_splits(found), "warc_splits")
    place = found.where("at is not null").join(splits, ["file", "block"])
    absolute = place.select(
        "file",
        "block",
        (F.col("base") + F.col("at")).alias("at"),
        (F.col("base") + F.col("leaves")).alias("to"),
        "rank",
    )
    starts = splits.where("block = 0 and file_bytes > 0").select("file", F.lit(0).cast("long").alias("at"), "file_bytes")
    targets = absolute.select("file", F.col("to").alias("at")).where("at is not null").distinct()
    entered = absolute.join(targets.union(starts.select("file", "at")).distinct(), ["file", "at"], "left_semi")
    entries = staged(entered, "warc_entries")
    seen = staged(reached(entries.where("to is not null"), starts), "warc_chain")
    broken = starts.join(seen, ["file", "at"]).where("ends is null or ends != file_bytes").select("file").limit(3).collect()
    if broken:
        raise BrokenArchiveError(f"records do not lead to the end of {[r['file'] for r in broken]}")
    # one chain runs through a file, so a split has one entry
    entry = entries.join(seen.select("file", "at"), ["file", "at"]).select("file", "block", F.col("rank").alias("entry"))
    kept = place.join(entry, ["file", "block"]).where("rank <= entry and entry < rank_end")
    out = ["file", F.expr("base + at").alias("at"), *_PARSED]
    whole = kept.where("whole").select(*out)
    cut = staged(kept.where("not whole").select("file", F.expr("base + at").alias("at"), F.expr("base + next").alias("next")), "warc_cut")
    if cut.isEmpty():
        return whole
    return whole.unionByName(_joined(spark, path, cut, splits, with_payload))


def _joined(spark: SparkSession, path: str, cut: DataFrame, splits: DataFrame, with_payload: bool) -> DataFrame:
    """The records (file, at, next) whose payload holds magic lines, put together from
    their segments in a second scan."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, begins = None, 0
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            offsets = []
            for file, block, segment in zip(files, blocks, batch.column("segment")):
                if key != (file, block):
                    key, begins = (file, block), 0
                offsets.append(begins)
                begins += len(segment.as_py()) + len(MAGIC)
            yield {"file": files, "block": blocks, "begins": offsets, "segment": batch.column("segment")}

    segments = map_batches(_segments(spark, path), placed, "file string, block long, begins long, segment binary")
    after = F.lead("base").over(Window.partitionBy("file").orderBy("block"))
    reach = splits.select("file", "block", "base", F.coalesce(after, F.col("file_bytes") + len(MAGIC)).alias("until"))
    # a record lies in one split or a few in a row
    spans = cut.join(reach, "file").where(F.expr(f"base <= next and until > at + {len(MAGIC)}")).select(
        "file", "block", "base", "at", "next"
    )
    pieces = segments.join(spans, ["file", "block"]).where(F.expr(f"base + begins > at and base + begins < next"))
    one = F.struct(F.expr("base + begins").alias("begins"), F.col("segment").cast("string").alias("segment"))
    records = pieces.groupBy("file", "at").agg(F.array_sort(F.collect_list(one)).alias("parts")).select(
        "file", "at", F.array_join(F.transform("parts", lambda p: p["segment"]), MAGIC).cast("binary").alias("record")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for file, at, record in zip(batch.column("file"), batch.column("at"), batch.column("record")):
                record = record.as_py()
                found = _announced(record)
                if found is None or not record.endswith(RECORD_END) or found[1] + found[2] + len(RECORD_END) != len(record):
                    raise BrokenArchiveError(f"no whole record at {at} of {file}")
                fields, start, length = found
                rows.append(_parsed(fields, record[start : start + length], with_payload))
            yield {"file": batch.column("file"), "at": batch.column("at")} | {k: [r[k] for r in rows] for k in _PARSED}

    kinds = "file string, at long, record_type string, record_id string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    return map_batches(records, parse, kinds)


def page_digests(records: DataFrame) -> DataFrame:
    """Per record of a page: its id, payload length and digest, kind, and the page that it revisits."""
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


#: The same rows in DuckDB, from the table itself.
PAGES_SQL = f"""
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN revisit THEN '{REVISIT}' ELSE '{RESPONSE}' END AS record_type, CASE WHEN revisit THEN first_id END AS refers_to
FROM (SELECT *, n >= {LEAST_REVISIT_BYTES} AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS revisit
  FROM (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first_id
    FROM (SELECT page_id, coalesce(html,'') AS h FROM pages)))
"""
