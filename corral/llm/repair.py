"""Token files compressed by Re-Pair grammars, one grammar per shard.

A shard holds consecutive documents in ascending id order.  Frequent pairs of
neighbouring symbols are replaced by nonterminals, round after round; the shard
stores the rules, the expansion length of every nonterminal and the remaining
symbols.  No rule crosses a document's end, so any document or range of ids is
decoded from its own symbols alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.encode import word_encoder

END_ID = 0
#: doc_ids, doc_tokens: the shard's documents in order, end id included.
#: rules: left and right symbol of each nonterminal; lengths: ids it expands to;
#: body: the symbols; all as byte planes of little-endian unsigned 32-bit values.
SHARDS = (
    "part int, shard int, n_docs long, n_tokens long, base long, "
    "doc_ids array<long>, doc_tokens array<long>, rules binary, lengths binary, body binary"
)


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values, all first bytes, then all second bytes, and so on
    (high bytes are mostly zero and compress to nothing)."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


_TABLE_BITS = 20


def _place(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).view(np.int64)


def _frequent(pair: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that occur at least ``min_count`` times, in order, and how often."""
    ranked = np.sort(pair)
    firsts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.diff(np.concatenate([firsts, [len(ranked)]]))
    enough = counts >= min_count
    return ranked[firsts[enough]], counts[enough].astype(np.int32)


def _chosen(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of neighbouring places the heavier; in a stretch of equal weights (as in a a a a)
    every other place, from the left."""
    k = np.arange(len(at), dtype=np.int32)
    follows = at[1:] == at[:-1] + 1
    before, after = np.zeros_like(weight), np.zeros_like(weight)
    np.multiply(weight[:-1], follows, out=before[1:])
    np.multiply(weight[1:], follows, out=after[:-1])
    begin = np.maximum.accumulate(np.where(before != weight, k, np.int32(0)))
    late = before.take(begin) > weight
    k -= begin
    k -= late
    return (weight >= after) & (k & 1 == 0)


def compress(ids: np.ndarray, base: int, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over ``ids``: ``(rules (n, 2), expansion lengths, body)``.

    Each round counts pairs of neighbours, takes those that occur at least
    ``min_count`` times, and replaces their occurrences, a more frequent pair
    first where two overlap and else the left one.  It ends when no pair is
    that frequent.  A pair can only become frequent where a symbol was replaced,
    so after the first round only those places, and the frequent ones that were
    passed over, are counted: a round costs what the one before replaced.
    ``END_ID`` takes part in no pair.
    """
    if len(ids) and int(ids.max()) >= base:
        raise ValueError(f"id {int(ids.max())} is not below the first nonterminal {base}")
    x = ids.astype(np.int32 if base + len(ids) < 1 << 31 else np.int64)
    rules, lengths, top = [], [], base
    size = np.ones(base, dtype=np.int64)
    at = np.flatnonzero((x[:-1] != END_ID) & (x[1:] != END_ID))
    while len(at):
        pair = (x.take(at).astype(np.int64) << 32) | x.take(at + 1)
        keys, counts = _frequent(pair, min_count)
        if not len(keys):
            break
        # many places find their pair in a table by hash; of two pairs in one place of
        # it the earlier waits a round
        if len(at) > 1 << 14:
            table = np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
            table[_place(keys)] = np.arange(len(keys), dtype=np.int32)
            which = table.take(_place(pair))
            found = np.flatnonzero(which >= 0)
            seen, which = at.take(found), which.take(found)
            exact = np.flatnonzero(keys.take(which) == pair.take(found))
            at, which = seen.take(exact), which.take(exact)
        else:
            which = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            exact = np.flatnonzero(keys.take(which) == pair)
            seen = at = at.take(exact)
            which = which.take(exact)
        taken = np.flatnonzero(_chosen(at, counts.take(which)))
        which = which.take(taken)
        used = np.bincount(which, minlength=len(keys))
        twice = np.flatnonzero(used.take(which) >= 2)
        hits, which = at.take(taken.take(twice)), which.take(twice)
        if not len(hits):
            break
        live = np.flatnonzero(used >= 2)
        symbol = np.zeros(len(keys), dtype=x.dtype)
        symbol[live] = top + np.arange(len(live))
        first, second = keys[live] >> 32, keys[live] & 0xFFFFFFFF
        rules.append(np.stack([first, second], axis=1))
        lengths.append(size[first] + size[second])
        size = np.concatenate([size, lengths[-1]])
        top += len(live)
        x[hits] = symbol.take(which)
        stays = np.ones(len(x), dtype=bool)
        stays[hits + 1] = False
        # places to count: passed over, or beside a new symbol
        again = np.concatenate([seen, hits[hits > 0] - 1])
        if len(again) > 1 << 14:
            marked = np.zeros(len(x), dtype=bool)
            marked[again] = True
            stays = np.flatnonzero(stays)
            x, at = x.take(stays), np.flatnonzero(marked.take(stays))
        else:
            again = np.unique(again[stays[again]])
            x, at = x.take(np.flatnonzero(stays)), again - np.searchsorted(hits, again)
        at = at[: np.searchsorted(at, len(x) - 1)]
        at = at.take(np.flatnonzero((x.take(at) != END_ID) & (x.take(at + 1) != END_ID)))
    none = np.zeros((0, 2), dtype=np.int64)
    return (
        np.concatenate(rules) if rules else none,
        np.concatenate(lengths) if lengths else none[:, 0],
        x,
    )


class Shard:
    """Random-access reader of one shard."""

    def __init__(self, row: dict):
        base = row["base"]
        self.body = from_planes(row["body"]).astype(np.int64)
        lengths = from_planes(row["lengths"]).astype(np.int64)
        rules = from_planes(row["rules"]).reshape(-1, 2)
        plain = np.unique(rules[rules < base])
        data = plain.tobytes()
        table: dict[int, bytes] = {i: data[4 * k : 4 * k + 4] for k, i in enumerate(plain.tolist())}
        for symbol, (left, right) in enumerate(rules.tolist(), base):
            table[symbol] = table[left] + table[right]
        grown = b"".join([table[symbol] for symbol in range(base, base + len(rules))])
        # every id, then what each nonterminal expands to; where a symbol's ids begin there
        self._ids = np.concatenate([np.arange(base, dtype="<u4"), np.frombuffer(grown, dtype="<u4")])
        at = np.concatenate([np.arange(base), base + np.cumsum(lengths) - lengths])
        size = np.concatenate([np.ones(base, dtype=np.int64), lengths]).take(self.body)
        self.starts = np.zeros(len(size) + 1, dtype=np.int64)  # of each body symbol, in ids
        np.cumsum(size, out=self.starts[1:])
        self._shift = at.take(self.body) - self.starts[:-1]

    def ids(self, start: int, stop: int) -> bytes:
        """Ids ``start`` to ``stop`` of the shard (unsigned 32-bit, little-endian),
        from the body symbols that cover them."""
        if stop <= start:
            return b""
        first = int(np.searchsorted(self.starts, start, side="right")) - 1
        last = int(np.searchsorted(self.starts, stop, side="left"))
        edges = np.clip(self.starts[first : last + 1], start, stop)
        places = np.repeat(self._shift[first:last], np.diff(edges))
        places += np.arange(edges[0], edges[-1])
        return self._ids.take(places).tobytes()


def write_token_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocab_size: int | None = None,
    shard_tokens: int = 500_000,
    min_count: int = 12,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` and write the token files to the folder ``path``.

    Rows are range-partitioned by (id, text hash) and sorted, so files follow
    ascending ids (null ids first; rows with equal ids by text); each task
    writes shards of about ``shard_tokens`` ids, holding one at a time.
    ``vocab_size`` is the first nonterminal, above every id (the tokenizer's own size,
    if not given).  Null text: empty,
    so only the end id.  Empty table: no shards.
    """
    first = vocab_size or max(END_ID, *Tokenizer.from_file(tokenizer).get_vocab().values()) + 1
    ordered = texts_of(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")

    def shard_row(part: int, number: int, doc_ids: list, datas: list[bytes]) -> dict:
        ids = np.frombuffer(b"".join(datas), dtype="<u4")
        rules, lengths, body = compress(ids, first, min_count)
        row = {
            "part": part,
            "shard": number,
            "n_docs": len(doc_ids),
            "n_tokens": len(ids),
            "base": first,
            "doc_ids": doc_ids,
            "doc_tokens": [len(d) // 4 for d in datas],
            "rules": to_planes(rules.reshape(-1)),
            "lengths": to_planes(lengths),
            "body": to_planes(body),
        }
        return {k: [v] for k, v in row.items()}

    def run(batches) -> Iterator[dict]:
        enc, part, number = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, datas, held = [], [], 0
        for ids, texts in text_batches(batches):
            for doc_id, data in zip(ids, enc.encode(texts)):
                doc_ids.append(doc_id)
                datas.append(data + END_ID.to_bytes(4, "little"))
                held += len(data) // 4 + 1
                if held >= shard_tokens:
                    yield shard_row(part, number, doc_ids, datas)
                    doc_ids, datas, held, number = [], [], 0, number + 1
        if doc_ids:
            yield shard_row(part, number, doc_ids, datas)

    map_batches(ordered, run, SHARDS).write.option("compression", "zstd").parquet(path)


def read_token_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document, decoded from the files: ``doc_id``, ``start`` (ids of
    all documents before it), ``n_tokens``, ``ids_crc32`` and (``with_ids``) its ``ids``
    as bytes."""
    store = spark.read.parquet(path)
    sizes = store.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("part").alias("part_"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sizes.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(parts, F.col("part") == F.col("part_"))
        .select("part", "shard", (F.col("part_start") + F.col("in_part")).alias("shard_start"))
    )

    ddl = "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    keys = [f.split()[0] for f in ddl.split(", ")]

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: c[0] for k, c in batch.slice(i, 1).to_pydict().items()}
                shard, at = Shard(row), 0
                whole = shard.ids(0, row["n_tokens"])
                out: dict[str, list] = {k: [] for k in keys}
                for doc_id, n in zip(row["doc_ids"], row["doc_tokens"]):
                    data = whole[4 * at : 4 * (at + n)]
                    values = (row["part"], row["shard"], doc_id, at, n, zlib.crc32(data), data)[: len(keys)]
                    for k, v in zip(keys, values):
                        out[k].append(v)
                    at += n
                yield out

    rows = map_batches(store, run, ddl)
    return rows.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )
