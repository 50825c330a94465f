"""N-gram Jaccard join: a MinHash LSH forest, then exact verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import log1p

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corral.llm.common import in_files, kept_between_tasks, map_batches, staged, text_batches, texts_of

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_WORDS: dict[str, int] = kept_between_tasks()


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingles(text: str, n: int) -> frozenset:
    """The set of word n-grams; a shorter text that has words is one shingle."""
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def shingle_hashes(texts: list[str], n: int) -> list[np.ndarray]:
    """64-bit hashes of each text's distinct shingles, sorted."""
    known = _WORDS
    if len(known) > 500_000:
        known.clear()
    out = []
    for text in texts:
        words = words_of(text)
        try:
            codes = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            codes = [known[w] for w in words]
        h = np.array(codes, dtype=np.uint64)
        if len(h):
            k = min(n, len(h))
            total = np.zeros(len(h) - k + 1, dtype=np.uint64)
            for i in range(k):
                total = (total ^ h[i : len(h) - k + 1 + i]) * _PRIME
                total ^= total >> np.uint64(29)
            h = np.unique(total)
        out.append(h)
    return out


def recall(threshold: float, depths: Iterable[int]) -> float:
    """Probability that a pair at the threshold shares its prefix of the tree's depth in some tree."""
    miss = 1.0
    for depth in depths:
        miss *= 1 - threshold**depth
    return 1 - miss


def forest_depths(pairs: dict[tuple[int, int], int], threshold: float, trees: int, longest: int, target: float) -> list[int]:
    """Matched prefix length of every tree.

    All trees start at ``longest`` hashes.  The prefix of one tree after the other
    is shortened by a hash, always where that brings the most recall for the
    candidate pairs that it adds (``pairs``: by tree and depth), until a pair at
    the threshold meets with the target probability.  No prefix gets shorter than
    all would have to be if they were alike: a very short one gathers large
    subtrees, which cost more than the pairs tell.
    """
    depths = [longest] * trees
    least = next((d for d in range(longest, 1, -1) if recall(threshold, [d] * trees) >= target), 1)

    def price(tree: int) -> float:
        d = depths[tree]
        more = pairs.get((tree, d - 1), 0) - pairs.get((tree, d), 0)
        return (1 + max(more, 0)) / (log1p(-(threshold**d)) - log1p(-(threshold ** (d - 1))))

    while recall(threshold, depths) < target:
        open_trees = [t for t in range(trees) if depths[t] > least]
        if not open_trees:
            break
        depths[min(open_trees, key=price)] -= 1
    return depths


def _permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32)


def signatures(hashes: list[np.ndarray], count: int, seed: int) -> np.ndarray:
    """MinHash signatures (texts x count); empty sets get the largest value."""
    out = np.full((len(hashes), count), 0xFFFFFFFF, dtype=np.uint32)
    full = [i for i, h in enumerate(hashes) if len(h)]
    if not full:
        return out
    a, b = _permutations(count, seed)
    group, held = [], 0
    for i in full:
        group.append(i)
        held += len(hashes[i])
        if held > 50_000 or i == full[-1]:
            x = np.concatenate([hashes[j] for j in group])
            x = ((x ^ (x >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            starts = np.cumsum([0] + [len(hashes[j]) for j in group[:-1]])
            for k in range(count):
                out[group, k] = np.minimum.reduceat(x * a[k] + b[k], starts)
            group, held = [], 0
    return out


def sketch(rows: DataFrame, n: int, trees: int, longest: int, seed: int) -> DataFrame:
    """Per row: a hash of the text (Spark's ``xxhash64``), a 128-bit digest of the
    shingle set, its size, and its path in every tree: ``longest`` MinHash values of
    four bytes each, high byte first, so that paths sort as tries do."""

    def run(batches) -> Iterator[dict]:
        for ids, texts in text_batches(batches, max_chars=1_500_000):
            sets = shingle_hashes(texts, n)
            sigs = signatures(sets, trees * longest, seed).astype(">u4")
            paths = [[path.tobytes() for path in sig] for sig in sigs.reshape(len(texts), trees, longest)]
            yield {
                "doc_id": ids,
                "text_key": [_text_key(t) for t in texts],
                "set_key": [xxhash.xxh128_digest(s.tobytes()) for s in sets],
                "n": [len(s) for s in sets],
                "paths": paths,
            }

    return map_batches(rows, run, "doc_id long, text_key long, set_key binary, n long, paths array<binary>")


def _text_key(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def _prefix(depth: Column | int) -> Column:
    return F.substring("path", F.lit(1), F.lit(4) * depth)


def prefix_pairs(leaves: DataFrame, shortest: int, longest: int, counters: int = 256) -> dict[tuple[int, int], int]:
    """About how many pairs of classes share a prefix, by tree and prefix length.

    All leaves are counted, in a few counters per tree and length that prefixes
    are dealt to with a random sign: the squares of the counters add up to the
    squares of the group sizes, to about a tenth.  The numbers only say which
    tree is cheap to shorten; what is found does not depend on them.
    """
    lengths = F.explode(F.sequence(F.lit(shortest), F.lit(longest))).alias("depth")
    hashed = leaves.select("tree", lengths, "path").select("tree", "depth", F.xxhash64(_prefix(F.col("depth")), "depth").alias("h"))
    sign = F.when(F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(-1))
    sums = hashed.groupBy("tree", "depth", F.pmod("h", F.lit(counters)).alias("counter")).agg(
        F.sum(sign).cast("decimal(19,0)").alias("s"), F.count(F.lit(1)).alias("n")
    )
    counts = sums.groupBy("tree", "depth").agg(F.sum(F.col("s") * F.col("s")).alias("squares"), F.sum("n").alias("n"))
    return {(r["tree"], r["depth"]): max(0, int(r["squares"] - r["n"]) // 2) for r in counts.collect()}


def _candidates(leaves: DataFrame, depths: list[int], hot: int, threshold: float) -> DataFrame:
    """Walk every tree's sorted paths; classes under one prefix of the tree's depth are
    candidates.

    Groups of at most ``hot`` classes give their pairs whose sizes allow the
    threshold.  A larger group gives one row per member, tied to its first:
    it is verified in blocks elsewhere.  A task holds one group's first ``hot``
    members.
    """

    def run(batches) -> Iterator[dict]:
        prefix, members, head = None, [], None
        out: dict[str, list] = {"a": [], "b": [], "hot": []}

        def close() -> None:
            """Rows of the members held: pairs, or ties to the group's first."""
            if head is not None:
                out["a"].extend([head] * len(members))
                out["b"].extend(members)
                out["hot"].extend([True] * len(members))
                return
            for i, (a, n) in enumerate(members):
                for b, m in members[:i]:
                    if min(n, m) >= threshold * max(n, m) - 1e-9:
                        out["a"].append(min(a, b))
                        out["b"].append(max(a, b))
                        out["hot"].append(False)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("tree", "prefix", "class_id", "n"))
            for tree, path, c, n in zip(*columns):
                p = (tree, path)
                if p != prefix:
                    close()
                    prefix, members, head = p, [], None
                if head is not None:
                    members.append(c)
                else:
                    members.append((c, n))
                    if len(members) > hot:
                        head, members = members[0][0], [m[0] for m in members]
                if len(out["a"]) + (len(members) if head is not None else 0) >= 20_000:
                    if head is not None:
                        close()
                        members = []
                    yield out
                    out = {"a": [], "b": [], "hot": []}
        close()
        yield out

    # a subtree of a trie lies in one task, subtrees in the order of their prefixes; in
    # each the smallest class comes first, so a large group has one head in every tree
    depth = F.get(F.lit(depths), F.col("tree"))
    short = leaves.select("tree", _prefix(depth).alias("prefix"), "class_id", "n")
    order = short.repartition("tree", "prefix").sortWithinPartitions("tree", "prefix", "class_id")
    return map_batches(order, run, "a binary, b binary, hot boolean")


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)``: smallest node of every connected component of ``(a, b)``.

    Rounds of hooking to the smallest neighbouring root and of jumping to the
    root's root; every round is written to shared storage, in as many files as
    the edges need.  Only counts of edges and of changed nodes reach the driver.
    ``edges`` is read twice, once to count.
    """
    rows = 2 * edges.count()  # no round has more
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(in_files(both.where("a <> b").distinct(), rows), name)
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    labels = staged(in_files(labels, rows), name)
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b")
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(nearest, "node").select("node", F.least("root", "near").alias("new"), F.col("root").alias("old"))
        # a root learns the smallest label that any node under it saw
        under = hooked.groupBy(F.col("old").alias("root_")).agg(F.min("new").alias("best"))
        joined = hooked.join(under, F.col("new") == F.col("root_"), "left")
        new = joined.select("node", F.least("new", F.coalesce("best", "new")).alias("root"), "old")
        new = staged(in_files(new, rows), name)
        labels = new.select("node", "root")
        if not new.where("root <> old").limit(1).count():
            return labels


def _jaccard_ok(x: frozenset, y: frozenset, threshold: float) -> float | None:
    both = len(x & y)
    union = len(x) + len(y) - both
    return both / union if union and both >= threshold * union - 1e-9 else None


def _verify_pairs(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Pairs whose exact similarity reaches the threshold."""
    left = texts.select(F.col("class_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("class_id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(left, "a").join(right, "b")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out = {"a": [], "b": [], "jaccard": []}
            kept: dict[bytes, frozenset] = {}
            for i in range(batch.num_rows):
                sets = []
                for c, t in (("a", "ta"), ("b", "tb")):
                    key = batch.column(c)[i].as_py()
                    if key not in kept:
                        if len(kept) > 64:
                            kept.clear()
                        kept[key] = shingles(batch.column(t)[i].as_py(), n)
                    sets.append(kept[key])
                j = _jaccard_ok(*sets, threshold)
                if j is not None:
                    out["a"].append(batch.column("a")[i].as_py())
                    out["b"].append(batch.column("b")[i].as_py())
                    out["jaccard"].append(j)
            yield out

    return map_batches(joined, run, "a binary, b binary, jaccard double")


def _verify_blocks(members: DataFrame, texts: DataFrame, n: int, threshold: float, block: int) -> DataFrame:
    """All links inside large candidate groups, in pairs of blocks.

    ``members``: ``(class_id, grp)``.  A task gets two blocks of about ``block``
    classes, checks every pair between them and returns, per class, how many
    links it has there and the smallest class it is connected to there: as many
    rows as classes, not as links.
    """
    size = members.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = (
        members.join(size, "grp")
        .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .join(texts, "class_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class_id", "text")
    )

    def run(g: pd.DataFrame) -> pd.DataFrame:
        ids, own = g["class_id"].tolist(), g["own"].to_numpy()
        sets = [shingles(t, n) for t in g["text"]]
        i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
        holders: dict[str, list[int]] = {}
        for k, s in enumerate(sets):
            for x in s:
                holders.setdefault(x, []).append(k)
        common = [h for h in holders.values() if len(h) > 1]
        shared = np.zeros((len(ids), len(ids)), dtype=np.float32)
        for at in range(0, len(common), 8192):  # counts of common shingles, a slice at a time
            part = common[at : at + 8192]
            has = np.zeros((len(ids), len(part)), dtype=np.float32)
            for column, h in enumerate(part):
                has[h, column] = 1.0
            shared += has @ has.T
        sizes = np.array([len(s) for s in sets])
        union = sizes[:, None] + sizes[None, :] - shared
        linked = shared >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if i != j:  # pairs inside one block belong to that block's own task
            linked &= own[:, None] != own[None, :]
        by_rank = np.empty(len(ids), dtype=object)  # digests, not numpy's strings: those drop zero bytes
        by_rank[:] = sorted(ids)
        place = {c: k for k, c in enumerate(by_rank)}
        rank = np.array([place[c] for c in ids])
        low = rank.copy()
        while True:  # smallest class reached over links
            new = np.minimum(low, np.where(linked, low[None, :], len(ids)).min(axis=1, initial=len(ids)))
            if (new == low).all():
                break
            low = new
        return pd.DataFrame({"class_id": ids, "reach": by_rank[low], "links": linked.sum(axis=1)})[linked.any(axis=1)]

    return placed.groupBy("grp", "i", "j").applyInPandas(run, "class_id binary, reach binary, links long")


def jaccard_join(
    docs: DataFrame,
    threshold: float = 0.8,
    shingle_words: int = 5,
    trees: int = 40,
    longest: int = 8,
    target_recall: float = 0.99999,
    hot: int = 64,
    block: int = 192,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Similarity join of all texts on the sets of their word shingles.

    Returns ``(membership, links)``.  ``membership`` has one row per document:
    ``doc_id``, ``copy_id`` (smallest id with the same shingle set), ``class_id``
    (smallest id of the connected component of all links) and ``n_links`` (other
    shingle sets that are similar to this one's).  ``links`` has the verified
    pairs of copy classes that were found as pairs: ``a, b, jaccard``.

    Copies become one class first, by a digest of their shingle set, so a group
    of copies costs one class.  MinHash signatures of the classes are paths of ``trees``
    sorted prefix tries; the matched prefixes are shortened from ``longest`` hashes,
    tree by tree where it adds the fewest candidates, until a pair at the
    threshold meets with probability ``target_recall`` (:func:`forest_depths`).  Candidates
    are verified exactly on their texts.  Under a prefix with more than ``hot``
    classes no pairs are listed: such classes are joined to groups, and all
    pairs of a group are verified in blocks of ``block`` classes that return
    counts and connections only.  Nothing is capped.

    Null or blank text: the empty set, similar to other empty sets only (one
    copy class).  Null ids: rows of a class of their own kind, with the smallest
    non-null id of their class or null.  Repeated ids and rows are copies or
    texts like others; classes are named by ids, so texts that share an id are
    told apart by their digest and named by the id only in the result.  Empty
    table: no rows.
    """
    rows = texts_of(docs, id_col, text_col)
    members, links = _joined(rows, threshold, shingle_words, trees, longest, target_recall, hot, block, seed)
    return members.select("doc_id", "copy_id", "class_id", "n_links"), links


def _joined(
    rows: DataFrame,
    threshold: float = 0.8,
    shingle_words: int = 5,
    trees: int = 40,
    longest: int = 8,
    target_recall: float = 0.99999,
    hot: int = 64,
    block: int = 192,
    seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """:func:`jaccard_join` of ``(doc_id, text)``; the membership also has ``text_key``
    and ``root``, which names a component whatever ids its rows have."""
    sketched = staged(sketch(rows, shingle_words, trees, longest, seed), "forest_sketch")

    # a class is named by the 128-bit digest of its shingle set
    named = sketched.withColumnRenamed("set_key", "class_id")
    classes = named.groupBy("class_id").agg(F.min("doc_id").alias("copy_id"), F.min("n").alias("n"))
    empty = F.col("n") == 0
    leaves = (
        named.dropDuplicates(["class_id"])
        .where(~empty)
        .select("class_id", "n", F.posexplode("paths").alias("tree", "path"))
    )
    pairs_at = prefix_pairs(leaves, max(1, longest - 3), longest)
    depths = forest_depths(pairs_at, threshold, trees, longest, target_recall)
    n_docs = sketched.count()
    # about as many candidates as leaves, at most half of ``hot`` for each
    found = _candidates(leaves, depths, hot, threshold).distinct()
    found = staged(in_files(found, n_docs * trees), "forest_candidates")

    large = found.where("hot").select("a", "b")
    groups = components(large, "forest_groups").select(F.col("node").alias("class_id"), F.col("root").alias("grp"))
    ga = groups.select(F.col("class_id").alias("a"), F.col("grp").alias("ga"))
    gb = groups.select(F.col("class_id").alias("b"), F.col("grp").alias("gb"))
    pairs = (
        found.where("not hot")
        .select("a", "b")
        .join(ga, "a", "left")
        .join(gb, "b", "left")
        .where("ga is null or gb is null or ga <> gb")
        .select("a", "b")
    )
    pairs = staged(in_files(pairs, found.count()), "forest_pairs")
    n_pairs = pairs.count()

    wanted = pairs.select(F.col("a").alias("class_id")).unionAll(pairs.select("b")).unionAll(groups.select("class_id")).distinct()
    # the text of one document stands for its class
    one = named.groupBy("class_id").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select("class_id", "one.*")
    keyed = _class_texts(rows, wanted.join(one, "class_id"), shingle_words)
    texts = staged(in_files(keyed, min(n_docs, 2 * n_pairs + groups.count()), 2_000), "forest_texts")
    links = staged(in_files(_verify_pairs(pairs, texts, shingle_words, threshold), n_pairs, 2_000), "forest_links")
    blocks = staged(_verify_blocks(groups, texts, shingle_words, threshold, block), "forest_blocks")

    edges = links.select("a", "b").unionAll(blocks.select(F.col("class_id").alias("a"), F.col("reach").alias("b")))
    roots = components(edges, "forest_roots")
    degree = (
        links.select(F.col("a").alias("class_id"), F.lit(1).cast("long").alias("links"))
        .unionAll(links.select("b", F.lit(1).cast("long")))
        .unionAll(blocks.select("class_id", "links"))
        .groupBy("class_id")
        .agg(F.sum("links").alias("n_links"))
    )
    grouped = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "root", F.coalesce("root", "class_id")
    )
    names = grouped.groupBy("root").agg(F.min("copy_id").alias("group_id"))
    per_class = (
        grouped.join(names, "root")
        .join(degree, "class_id", "left")
        .select("class_id", "root", "copy_id", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    membership = named.select("doc_id", "text_key", "class_id").join(per_class, "class_id").select(
        "doc_id", "text_key", "root", "copy_id", F.col("group_id").alias("class_id"), "n_links"
    )
    link_names = per_class.select("class_id", "copy_id")
    named_links = links.join(link_names.select(F.col("class_id").alias("a"), F.col("copy_id").alias("ca")), "a").join(
        link_names.select(F.col("class_id").alias("b"), F.col("copy_id").alias("cb")), "b"
    )
    return membership, named_links.select(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "jaccard"
    )


def _class_texts(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``(class_id, text)`` of the wanted classes: texts of rows with the class's id
    and text hash (ids may be null or repeated), checked against the class's digest."""
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (F.xxhash64(rows["text"]) == wanted["text_key"])
    picked = rows.join(wanted, same).select("class_id", "text")

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            out = {"class_id": [], "text": []}
            for c, t in zip(batch.column("class_id").to_pylist(), batch.column("text")):
                text = t.as_py()
                if xxhash.xxh128_digest(shingle_hashes([text], n)[0].tobytes()) == c:
                    out["class_id"].append(c)
                    out["text"].append(text)
            yield out

    return map_batches(picked, run, "class_id binary, text string").dropDuplicates(["class_id"])


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every group of near copies: the one with the
    group's smallest id (of texts that share it: with the smallest hash).  A null id
    comes after all others, so a group of null ids keeps one document, too."""
    n_docs = docs.count()
    members = _joined(texts_of(docs))[0].select("doc_id", "text_key", "root")
    members = staged(in_files(members, n_docs), "forest_membership")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    keep = members.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_key"), first).alias("one")).select("one.*")
    # the row travels whole, so columns of any name stay as they are
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row")
    own_id = F.col("doc_id").cast("long").alias("own_id")
    left = docs.select(row, own_id, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own_key"))
    same = left["own_id"].eqNullSafe(keep["doc_id"]) & (left["own_key"] == keep["text_key"])
    kept = left.join(keep, same, "left_semi")
    if members.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["own_id", "own_key"])
    return in_files(kept.select("row.*"), n_docs, 2_000)
