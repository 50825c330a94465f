"""Approximate nearest neighbours by multi-index hashing of learned binary codes."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corral.llm.common import staged

SUBSTRING_BITS = 8
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
#: The substring values within 0, 1, ... 8 bits of zero.
_BALLS = [np.flatnonzero(_POPCOUNT <= s).astype(np.uint8) for s in range(SUBSTRING_BITS + 1)]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the rows that take part: ``v`` (array of doubles) has no
    null and no non-finite component and is not null, empty or zero."""
    v = F.col(vector_col).cast("array<double>")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
        .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one value
    )


def learn_codes(sample: np.ndarray, bits: int, rounds: int = 25, seed: int = 7) -> np.ndarray:
    """Projection (dimensions x bits) whose signs are the code.

    Principal axes of the normalised sample, then rotations found by iterative
    quantisation: alternate between the signs and the orthogonal rotation that
    brings the axes closest to them.  One rotation gives as many bits as there
    are axes; more bits come from rotations with other random starts.
    """
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    d = x.shape[1]
    if len(axes) < d:  # fewer sample rows than dimensions: fill up with further axes
        axes = np.linalg.qr(np.concatenate([axes, np.eye(d)]).T)[0].T[:d]
    v = x @ axes.T
    rng, out = np.random.default_rng(seed), []
    for _ in range(math.ceil(bits / d)):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = b.T @ a.T
        out.append(axes.T @ r)
    return np.concatenate(out, axis=1)[:, :bits]


def codes_of(x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Packed codes, one byte per substring."""
    return np.packbits(x @ projection > 0, axis=1)


def learn_radius(sample: np.ndarray, projection: np.ndarray, k: int, coverage: float) -> int:
    """Hamming radius that holds the share ``coverage`` of the sample's true ``k``
    nearest (in a sample they are farther than among all rows, so it is wide)."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    q = np.arange(0, len(x), max(1, len(x) // 400))
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -9
    near = np.argsort(-s, axis=1)[:, : min(k, len(x) - 1)]
    c = codes_of(sample, projection)
    far = _POPCOUNT[c[q][:, None, :] ^ c[near]].sum(axis=2, dtype=np.int64)
    return int(np.quantile(far, coverage)) + 1 if far.size else 0


class BlockIndex:
    """Postings of every code substring of a block of vectors."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        self.starts = np.stack(
            [np.searchsorted(np.sort(codes[:, j]), np.arange(257)) for j in range(codes.shape[1])]
        )

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` bits of ``code``.

        Pigeonhole: with m substrings and radius = m * s + a, a code in reach
        differs by at most s bits in one of the first a + 1 substrings or by at
        most s - 1 bits in one of the others.
        """
        m = len(code)
        s, a = divmod(min(radius, SUBSTRING_BITS * m), m)
        seen = np.zeros(len(self.codes), dtype=bool)
        for j in range(m):
            reach = s if j <= a else s - 1
            if reach < 0:
                continue
            starts = self.starts[j]
            for value in (_BALLS[reach] ^ code[j]).tolist():
                lo, hi = starts[value], starts[value + 1]
                if hi > lo:
                    seen[self.order[lo:hi, j]] = True
        rows = np.flatnonzero(seen)
        return rows[_POPCOUNT[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    bits: int = 128,
    sample_rows: int = 4096,
    coverage: float = 0.985,
    block_rows: int = 8192,
    query_block_rows: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found for each query row, by cosine.

    ``is_query`` is a condition on ``vec_id``.  Codes and radius are learned on
    a sample of at most ``sample_rows`` distinct vectors (smallest hashes); every
    distinct vector is indexed.  Rows with equal vectors share one index entry
    with their ``k + 1`` smallest ids, which is all that ``k`` places can need
    (ties go to the smaller id), and equal query vectors are searched once.
    Index blocks and query blocks meet in pairs; inside a pair the multi-index
    retrieves every code within the radius and ranks it by cosine in double
    precision on the original vectors.  Each pair returns at most ``k + 1`` rows
    per query vector, so what is gathered per query is small.  Query vectors with
    fewer than ``k + 1`` rows in reach (their own is one) are searched again with
    the radius doubled, at last with all bits, which compares all vectors: a query
    gets fewer than ``k`` rows only if there are no more.  Of the others a vector
    whose code is not within the radius is missed; recall is set by ``coverage``.

    Result: ``query_id, rank, vec_id, score``.  Rows of null id and null, zero or
    non-finite vectors take no part; a vector of another length than the
    query's is never near.  Repeated ids are rows of their own, except that a
    query never returns its own id.  No queries or no rows: empty result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    dims = F.size("v")
    # k + 1 smallest ids of every distinct vector; ranked before the shuffle too
    near_ids = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("n", F.row_number().over(near_ids)).where(F.col("n") <= k + 1)
    entries = staged(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "mih_entries")
    picked = (
        entries.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(sample_rows).select("v").collect()
    )
    result = "query_id long, rank int, vec_id long, score double"
    if not picked:
        return spark.createDataFrame([], result)
    common = max(set(len(r["v"]) for r in picked), key=[len(r["v"]) for r in picked].count)
    sample = np.array([r["v"] for r in picked if len(r["v"]) == common])
    projection = learn_codes(sample, bits)
    radius = learn_radius(sample, projection, k, coverage) if len(sample) > 1 else bits

    count = entries.count()
    queries = rows.where(is_query)
    index_blocks = max(24, -(-count // block_rows))
    block = lambda n: F.pmod(F.xxhash64("v"), F.lit(n)).cast("int")

    def search(index: pd.DataFrame, wanted: pd.DataFrame, radius: int) -> pd.DataFrame:
        out_v, out_id, out_score = [], [], []
        for d, ask in wanted.groupby(wanted["v"].map(len)) if len(wanted) and len(index) else ():
            have = index[index["v"].map(len) == d]
            if not len(have):
                continue
            x = np.array(have["v"].tolist(), dtype=np.float64)
            norms = np.sqrt(np.einsum("ij,ij->i", x, x))
            ids = have["ids"].tolist()
            # vectors of an uncommon length have no learned code: all are candidates, as
            # they are when the radius holds all bits
            index_of = BlockIndex(codes_of(x, projection)) if d == common and radius < bits else None
            for v in ask["v"]:
                q = np.asarray(v, dtype=np.float64)
                if index_of is None:
                    found = np.arange(len(x))
                else:
                    found = index_of.within(codes_of(q[None, :], projection)[0], radius)
                if not len(found):
                    continue
                near = x[found]
                score = np.einsum("ij,j->i", near, q) / (norms[found] * math.sqrt(float(q @ q)))
                # all entries that can take one of k + 1 places, ties included
                least = np.partition(score, -(k + 1))[-(k + 1)] if len(score) > k + 1 else -math.inf
                for s, i in zip(score[score >= least].tolist(), found[score >= least].tolist()):
                    for vec_id in ids[i]:
                        out_v.append(v)
                        out_id.append(vec_id)
                        out_score.append(s)
        return pd.DataFrame(
            {"v": pd.Series(out_v, dtype=object), "vec_id": pd.Series(out_id, dtype="int64"), "score": pd.Series(out_score, dtype="float64")}
        )

    best = Window.partitionBy("v").orderBy(F.col("score").desc(), "vec_id")

    def within(wanted: DataFrame, radius: int) -> DataFrame:
        """The best k + 1 rows in reach of each wanted vector."""
        query_blocks = max(1, -(-wanted.count() // query_block_rows))
        left = entries.select(
            block(index_blocks).alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), "v", "ids"
        )
        right = wanted.select(
            F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("ib"), block(query_blocks).alias("qb"), "v"
        )
        pairs = (
            right.groupBy("ib", "qb")
            .cogroup(left.groupBy("ib", "qb"))
            .applyInPandas(lambda a, b: search(b, a, radius), "v array<double>, vec_id long, score double")
        )
        return pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")

    wanted = queries.select("v").distinct()
    parts = []
    while True:
        rows_in_reach = staged(within(wanted, radius), "mih_found")
        if radius >= bits:
            parts.append(rows_in_reach)
            break
        # the query's own row takes a place; vectors of uncommon length were compared with all
        enough = rows_in_reach.groupBy("v").count().where((F.col("count") > k) | (dims != common)).select("v")
        parts.append(rows_in_reach.join(enough, "v", "left_semi"))
        wanted = staged(wanted.where(dims == common).join(enough, "v", "left_anti"), "mih_short")
        if not wanted.limit(1).count():
            break
        radius = min(bits, max(1, 2 * radius))
    found = reduce(DataFrame.unionAll, parts)
    answers = found.groupBy("v").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("near")
    )
    mine = queries.join(answers, "v").select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("near"),
    )
    return mine.select("query_id", F.posexplode("near").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score")
    )
