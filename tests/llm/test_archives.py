"""WARC archives: round trips, boundary chains, adversarial payloads, odd tables."""

import hashlib
import os
from random import Random

import pytest

from corral.llm import warc

MAGIC = warc.MAGIC
FAKE = (
    f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {{n}}\r\n\r\n"
)
PAGES = "page_id long, url string, html string"


def expected(pages):
    payloads = [(p, (h or "").encode()) for p, _, h in pages]
    first = {}
    for p, b in payloads:
        if p is not None and len(b) >= 100:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, b in payloads:
        revisit = b in first and p != first[b]
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None))
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def round_trip(spark, path, pages, split=None):
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(2), path)
    return split_read(spark, path, split)


def split_read(spark, path, split=None, **kw):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        if split:
            for n in names:
                spark.conf.set(n, str(split))
        return key(warc.page_digests(warc.read_archives(spark, path, **kw)).collect())
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def adversarial(rng, n=60):
    """Payloads with magic lines, whole records, records that reach past the real one, and cut headers."""
    pages = []
    for i in range(n):
        inner = "".join(
            rng.choice(
                [
                    "plain words é 日本 ",
                    MAGIC,
                    FAKE.format(n=rng.randrange(0, 400)),
                    FAKE.format(n=10**9),
                    FAKE.format(n=3) + "abc\r\n\r\n",
                    "WARC/1.1\r",
                    "\r\n\r\n",
                    f"{MAGIC}Content-Length: x\r\n\r\n",
                ]
            )
            for _ in range(rng.randrange(0, 9))
        )
        pages.append((i, f"http://h/{i}", inner))
    return pages


def test_magic_inside_payloads(spark, tmp_dir):
    pages = adversarial(Random(7), 25)
    assert round_trip(spark, f"{tmp_dir}/w", pages) == key(expected(pages))
    assert split_read(spark, f"{tmp_dir}/w", 1301) == key(expected(pages))


def test_payload_that_ends_like_a_record(spark, tmp_dir):
    whole = FAKE.format(n=2) + "ab\r\n\r\n"
    pages = [(1, None, whole), (2, "u", whole + whole), (3, "u", "\r\n\r\n" + MAGIC), (4, "u", MAGIC * 90)]
    assert round_trip(spark, f"{tmp_dir}/w", pages, 311) == key(expected(pages))


def test_odd_pages(spark, tmp_dir):
    long = "ab" * 400_000
    pages = [
        (None, None, None),
        (None, "u", "x" * 100),
        (5, "a b\r\nEvil: 1", "x" * 100),
        (5, "u", "x" * 100),
        (9, "u", "x" * 100),
        (3, "u", "x" * 99),
        (2, "u", "x" * 99),
        (7, "", long),
        (8, "u", long),
        (11, "u", "ü" * 50),
        (10, "u", "ü" * 50),
        (12, "u", ""),
    ]
    got = round_trip(spark, f"{tmp_dir}/w", pages, 100_000)
    assert got == key(expected(pages))
    clash = spark.createDataFrame([(*p, 1, 2, 3) for p in pages], PAGES + ", digest int, value int, first_id int")
    warc.write_archives(clash, f"{tmp_dir}/c")
    assert split_read(spark, f"{tmp_dir}/c") == got
    empty = spark.createDataFrame([], PAGES)
    warc.write_archives(empty, f"{tmp_dir}/e")
    assert split_read(spark, f"{tmp_dir}/e") == []


def test_payloads_and_records_by_the_book(spark, tmp_dir):
    pages = adversarial(Random(1), 20) + [(100, "u", "y" * 300), (101, "u", "y" * 300)]
    path = f"{tmp_dir}/w"
    warc.write_archives(spark.createDataFrame(pages, PAGES).coalesce(1), path)
    rows = {r.record_id: r for r in warc.read_archives(spark, path, with_payload=True).collect()}
    assert rows["101"].payload is None and rows["101"].refers_to == "100"
    assert {i: bytes(rows[str(i)].payload).decode() for i, *_ in pages if i != 101} == {p[0]: p[2] for p in pages if p[0] != 101}
    # the files themselves, read record by record from the start
    seen = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            data = open(f"{path}/{name}", "rb").read()
            at = 0
            while at < len(data):
                head, _, rest = data[at:].partition(b"\r\n\r\n")
                fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
                n = int(fields[b"Content-Length"])
                assert head.startswith(MAGIC.encode()) and rest[n : n + 4] == b"\r\n\r\n"
                seen.append(fields[b"WARC-Record-ID"].decode())
                at += len(head) + 4 + n + 4
    assert sorted(seen) == sorted(f"<urn:page:{p[0]}>" for p in pages)


@pytest.mark.parametrize("harm", [lambda b: b[:-5], lambda b: b"x" + b, lambda b: b + b"tail", lambda b: b.replace(b"Content-Length: ", b"Content-Length: 1", 1)])
def test_broken_files_are_errors(spark, tmp_dir, harm):
    path = f"{tmp_dir}/w"
    warc.write_archives(spark.createDataFrame([(i, "u", f"page {i}") for i in range(6)], PAGES).coalesce(1), path)
    part = next(f"{path}/{n}" for n in os.listdir(path) if n.startswith("part-"))
    crc = f"{path}/.{os.path.basename(part)}.crc"
    data = open(part, "rb").read()
    os.replace(crc, f"{tmp_dir}/old.crc")
    open(part, "wb").write(harm(data))
    with pytest.raises(warc.BrokenArchiveError):
        split_read(spark, path, 700)


def test_local_chains_against_walking():
    rng = Random(3)
    for _ in range(300):
        at = sorted(rng.sample(range(60), rng.randrange(1, 15)))
        following = [rng.choice([None, a + rng.randrange(1, 30)]) for a in at]
        leaves, rank, rank_end = warc.local_chains(at, following)
        for i, a in enumerate(at):
            path, now = [a], following[i]
            while now in at:
                path.append(now)
                now = following[at.index(now)]
            assert leaves[i] == now
            assert [b for j, b in enumerate(at) if rank[j] <= rank[i] < rank_end[j]] == path


def test_pointer_jumping_against_walking(spark):
    rng = Random(4)
    links = [(f, a, a + rng.randrange(1, 6)) for f in "ab" for a in range(12)]
    to = {(f, a): b for f, a, b in links}
    starts = spark.createDataFrame([("a", 0), ("b", 3), ("c", 0)], "file string, at long")
    got = warc.reached(spark.createDataFrame(links, "file string, at long, to long"), starts).collect()
    want = set()
    for f, a in [("a", 0), ("b", 3), ("c", 0)]:
        first, last = a, None
        want.add((f, a))
        while (f, a) in to:
            a = last = to[f, a]
            want.add((f, a))
        assert [r.ends for r in got if (r.file, r.at) == (f, first)] == [last]
    assert {(r.file, r["at"]) for r in got} == want
