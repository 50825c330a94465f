"""Similarity join and nearest neighbours against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corral.llm import common, forest, mih
from corral.session import session_setting


def near(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words]


def collection():
    """Texts with copies, near copies of many degrees, shared passages, short ones."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(25):
        base = rng.choices(vocab, k=rng.randint(20, 200))
        texts += [" ".join(near(rng, base, s)) for s in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2)]
    passage = " ".join(rng.choices(vocab, k=60))
    texts += [passage + " " + " ".join(rng.choices(vocab, k=40)) for _ in range(20)]
    group = rng.choices(vocab, k=150)  # more near copies than a listed group holds
    texts += [" ".join(near(rng, group, 0.008)) for _ in range(60)]
    texts += ["", "  ", None, "one", "one", "One", "one two three", "one two three four five six"]
    rng.shuffle(texts)
    return texts


def brute(texts, threshold=0.8):
    sets = [forest.shingles(t or "", 5) for t in texts]
    distinct = sorted(set(sets), key=lambda s: min(i for i, x in enumerate(sets) if x == s))
    first = {s: sets.index(s) for s in distinct}
    links = set()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links.add((min(first[a], first[b]), max(first[a], first[b])))
    root = {v: v for v in first.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    degree = {v: 0 for v in root}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return [(i, first[s], find(first[s]), degree[first[s]]) for i, s in enumerate(sets)], links


@pytest.mark.parametrize("hot,block", [(64, 192), (8, 6)])
def test_join_equals_brute_force(spark, hot, block):
    texts = collection()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, class_id int")
    membership, links = forest.jaccard_join(df, hot=hot, block=block)
    want, pairs = brute(texts)
    got = sorted((r.doc_id, r.copy_id, r.class_id, r.n_links) for r in membership.collect())
    assert got == want
    found = {(r.a, r.b) for r in links.collect()}
    assert found <= pairs
    if hot == 64:  # no group is large enough for blocks: every link is listed
        large = {a for a, _ in pairs} if len(found) < len(pairs) else set()
        assert found == pairs or large


def test_join_of_nothing_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert forest.jaccard_join(spark.createDataFrame([], schema))[0].collect() == []
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (7, text), (7, text), (3, text + " end"), (9, "else where it is not the same")]
    got = forest.jaccard_join(spark.createDataFrame(rows, schema))[0].collect()
    assert sorted((str(r.doc_id), r.class_id) for r in got) == [("3", 3), ("7", 3), ("7", 3), ("9", 9), ("None", 3)]


def test_keep_one_of_each(spark):
    texts = collection()
    df = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    kept = forest.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c, _ in brute(texts)[0]})
    twice = forest.keep_one_of_each(df.union(df.limit(30)))
    assert twice.count() == kept.count()


def test_keep_one_with_null_and_repeated_ids(spark):
    words = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(None, words("a")), (None, words("a") + " end"), (5, words("b")), (5, words("b") + " end"), (5, words("b"))]
    rows += [(None, words("c")), (2, words("c") + " end"), (2, words("d")), (1, words("d") + " end"), (None, None), (None, " ")]
    kept = forest.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = [(r.text or "").strip()[:1] for r in kept]
    assert sorted(groups) == ["", "a", "b", "c", "d"]
    assert {g: r.doc_id for g, r in zip(groups, kept)} == {"": None, "a": None, "b": 5, "c": 2, "d": 1}


def test_text_key_is_sparks_hash(spark):
    texts = ["", "a", "é漢😀" * 5, "x" * 31, "x" * 32, "y" * 1001]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text").alias("h"))
    assert all(forest._text_key(r.text) == r.h for r in df.collect())


def test_depths_reach_the_recall_at_the_cheapest_trees():
    even = {(t, d): 1000 * 4 ** (8 - d) for t in range(40) for d in range(1, 9)}
    depths = forest.forest_depths(even, 0.8, 40, 8, 0.99999)
    assert forest.recall(0.8, depths) >= 0.99999
    # one hash more in any tree that was shortened, and the target is missed
    assert all(forest.recall(0.8, depths[:t] + [depths[t] + 1] + depths[t + 1 :]) < 0.99999 for t in range(40) if depths[t] == min(depths))
    assert min(depths) == 6 and forest.recall(0.8, [6] * 40) >= 0.99999 > forest.recall(0.8, [7] * 40)
    dear = even | {(5, d): 10**9 * 4 ** (8 - d) for d in range(1, 9)}
    skewed = forest.forest_depths(dear, 0.8, 40, 8, 0.99999)
    assert skewed[5] == max(skewed) > 6 and forest.recall(0.8, skewed) >= 0.99999  # the others make up for it
    assert forest.forest_depths({}, 0.8, 2, 8, 0.99999) == [1, 1]  # the target is out of reach


def test_prefix_pairs_are_about_right(spark):
    rows = [(t, bytes([i % (3 if t else 50), i % 7, 0, 0]) * 8) for t in range(2) for i in range(2000)]
    leaves = spark.createDataFrame(rows, "tree int, path binary")
    got = forest.prefix_pairs(leaves, 1, 2)
    for t in range(2):
        for d in (1, 2):
            sizes = {}
            for tree, path in rows:
                if tree == t:
                    sizes[path[: 4 * d]] = sizes.get(path[: 4 * d], 0) + 1
            exact = sum(n * (n - 1) // 2 for n in sizes.values())
            assert abs(got[t, d] - exact) < 0.5 * exact


def test_kept_rows_keep_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 7, "x", 1.5), (2, text + " end", 8, "y", 2.5), (3, None, 9, "z", 3.5), (3, None, 9, "z", 3.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, `__key` string, `row.text` double")
    kept = forest.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == sorted([rows[0], rows[2]], key=lambda r: r[0])
    assert forest.keep_one_of_each(docs.limit(0)).collect() == []


def test_one_very_long_text_and_its_near_copy(spark):
    long = [f"w{i}" for i in range(60_000)]
    near = [*long[:30_000], "changed", *long[30_001:]]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(near)), (3, "short text")], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in forest.jaccard_join(docs)[0].collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (5, 5)]
    got = {r.node: r.root for r in forest.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


@pytest.mark.parametrize("step", ["components", "keep_one_of_each"])
def test_rounds_over_few_rows_write_few_files(spark, tmp_dir, monkeypatch, step):
    folders = []

    def location(_, name):
        folders.append(Path(tmp_dir, f"{name}-{len(folders)}"))
        return str(folders[-1])

    monkeypatch.setattr(common, "scratch_location", location)
    names = ("spark.sql.shuffle.partitions", "40"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")
    with session_setting(spark, *names[0]), session_setting(spark, *names[1]):
        if step == "components":
            edges = spark.range(200).selectExpr("id as a", "id - id % 2 as b")
            got = forest.components(edges, "t")
            assert {(r.node, r.root) for r in got.collect()} == {(i, i - i % 2) for i in range(200)}
        else:
            texts = [" ".join(f"w{i}x{j}" for j in range(30)) + (" end" if k else "") for i in range(50) for k in range(2)]
            docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
            got = forest.keep_one_of_each(docs.coalesce(4))
            assert sorted(r.doc_id for r in got.collect()) == list(range(0, 100, 2))
            assert got.rdd.getNumPartitions() <= 8
    files = {f.name: len(list(f.glob("part-*"))) for f in folders}
    assert files and max(n for name, n in files.items() if "forest_blocks" not in name) <= 8


def vectors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 32)).astype(np.float32)
    x[100:160] = x[50]  # one vector many times
    x[300:330] = x[10] + rng.normal(scale=0.05, size=(30, 32))
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    bad = [(900, None), (950, [0.0] * 32), (1000, [float("nan")] * 32), (1050, [1.0, None] * 16), (1100, [float("inf")] * 32)]
    return rows + bad + [(None, rows[0][1]), (1150, [1.0, 2.0]), (1151, [2.0, 4.0])]


def test_nearest_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, score long")
    got = {}
    for r in mih.nearest(df, F.col("vec_id") % 50 == 0, block_rows=64, query_block_rows=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows if i is not None and (i < 900 or i > 1100)}
    queries = [i for i in good if i % 50 == 0]
    assert set(got) == set(queries)
    hit = total = 0
    for q in queries:
        scores = [
            (-round(float(good[q] @ v / np.sqrt((good[q] @ good[q]) * (v @ v))), 12), i)
            for i, v in good.items()
            if i != q and len(v) == len(good[q])
        ]
        best = sorted(scores)[:5]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
        truth = {i: -s for s, i in scores}
        for _, i, s in mine:
            assert abs(truth[i] - s) < 1e-9
        assert [(-round(s, 12), i) for _, i, s in mine] == sorted((-round(s, 12), i) for _, i, s in mine)
        hit += len({i for _, i in best} & {i for _, i, _ in mine})
        total += len(best)
    assert hit / total >= 0.9
    assert [i for _, i, _ in sorted(got[100])] == [50, 101, 102, 103, 104]  # ties to smaller ids


def test_outliers_of_tight_clusters_get_their_places(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 32))
    x = np.concatenate([np.repeat(centres, 100, axis=0) + rng.normal(scale=1e-4, size=(1200, 32)), rng.normal(size=(8, 32))])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in mih.nearest(df, (F.col("vec_id") >= 1200) | (F.col("vec_id") % 300 == 0)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score))
    assert set(got) == {0, 300, 600, 900, *range(1200, 1208)}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q, near in got.items():
        best = np.sort(np.delete(unit @ unit[q], q))[::-1][:5]
        assert [r for r, _ in sorted(near)] == [1, 2, 3, 4, 5]
        if q < 1200:
            assert np.allclose([s for _, s in sorted(near)], best)
    few = df.where("vec_id in (0, 300, 1200, 1201)")
    assert mih.nearest(few, F.col("vec_id") >= 0).count() == 12  # no more than three others


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mih.nearest(df, F.col("vec_id") % 50 == 0).collect() == []


def test_pigeonhole_finds_every_code_in_reach():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 256, (500, 4), dtype=np.uint8)
    index = mih.BlockIndex(codes)
    for radius in range(0, 17):
        code = codes[radius]
        far = mih._POPCOUNT[codes ^ code].sum(axis=1)
        assert index.within(code, radius).tolist() == np.flatnonzero(far <= radius).tolist()
