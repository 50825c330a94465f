"""Filter audit and centroid clustering against brute force, with odd tables."""

import hashlib
import re
from collections import defaultdict
from itertools import permutations
from random import Random

import numpy as np
import pytest

from corral.llm import filter_audit, pivot_clusters

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    lowest = {}
    for i, text, _ in docs:
        if i is not None:
            lowest[text or ""] = min(lowest.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > lowest[t],
        }
        parts[lang or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        steps, removed_by = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                earlier = len(rows) - len(left)
                left = [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                assert earlier >= failing - len(gone)
                removed_by[f] += len(gone)
                steps.append((part, "".join(order), step, f, len(left), len(gone), failing - len(gone),
                              sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*s[:3], *s[4:], removed_by[s[3]]) for s in steps]
    return sorted(out)


def audit_fixture():
    rng = Random(2)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(120):
        words = rng.choices(vocab[: rng.choice([60, 300])], k=rng.choice([0, 5, 99, 100, 101, 140]))
        text = rng.choice([" ", "\t", "\x0b\n"]).join(words)
        docs.append((rng.randrange(90), rng.choice([text, text.upper(), text + " #", None, "", "x" * 9 + "Y", "x" * 8 + "YZ"]), rng.choice(["en", "de", None, ""])))
    docs += [(rng.randrange(200, 300), "the same text again", "en") for _ in range(40)]
    docs += [(None, "the same text again", "en"), (None, None, None), (250, "nbsp\xa0joined é", "fr"), (7, "word " * 50_000, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(3, 1, 1), (None, 1, 1), (250, 1, 0)]
    return docs, labels


def test_audit_against_brute_force(spark):
    docs, labels = audit_fixture()
    frame = spark.createDataFrame(docs, DOCS)
    got = sorted(tuple(r) for r in filter_audit.audit(frame, spark.createDataFrame(labels, LABELS)).collect())
    assert got == brute_audit(docs, labels)
    clash = frame.selectExpr("*", "1 AS part", "2 AS mask", "3 AS n", "4 AS good", "'x' AS copy_key")
    again = filter_audit.audit(clash, spark.createDataFrame(labels, LABELS).selectExpr("*", "5 AS n"))
    assert sorted(tuple(r) for r in again.collect()) == got


def test_audit_of_empty_tables(spark):
    none, no_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, no_labels).collect() == []
    rows = filter_audit.audit(spark.createDataFrame([(1, None, None)], DOCS), no_labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.removed, r.kept) for r in rows if r.filter_order == "ABCDE" and r.step == 1} == {(1, 0)}


def test_fields_do_not_run_into_each_other():
    n = 2**55
    table = filter_audit.step_table("p", [(mask, mask % 2 == 0, mask % 3 == 0, n) for mask in range(32)])
    one = filter_audit.step_table("p", [(mask, mask % 2 == 0, mask % 3 == 0, 1) for mask in range(32)])
    for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
        assert (table[c] == one[c] * n).all()
    assert (one["removed"] + one["redundant"] == 16).all()


VECS = "vec_id long, embedding array<float>"


def brute_clusters(rows, k=16, rounds=3, size=64):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: "~" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centroids = [list(v) for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        who = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (c, _) in zip(kept, who) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    who = assign()
    inertia = defaultdict(int)
    for c, d in who:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (c, d) in zip(kept, who)), key=repr)


def vectors(seed, n, spread):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, 64)) * spread
    return [(int(i), [float(x) for x in middles[i % 6] + rng.normal(size=64)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 3.0, 1e4])
def test_clusters_against_brute_force(spark, spread):
    rows = vectors(3, 150, spread)
    odd = [
        (None, rows[0][1]), (4, rows[5][1]), (4, rows[5][1]), (900, rows[5][1]), (901, None), (902, []), (903, rows[1][1][:63]),
        (904, [None, *rows[1][1][1:]]), (905, [float("nan"), *rows[1][1][1:]]), (906, [float("-inf"), *rows[1][1][1:]]),
        (907, [0.0] * 64), (908, [-0.0] * 64), (909, [-1e-9] * 64), *[(1000 + i, rows[7][1]) for i in range(80)],
    ]
    frame = spark.createDataFrame(rows + odd, VECS).repartition(5)
    got = sorted((tuple(r) for r in pivot_clusters.clusters(frame).collect()), key=repr)
    assert got == brute_clusters(rows + odd)
    clash = frame.selectExpr("*", "1 AS cluster", "2 AS vector", "3 AS distance", "4 AS x")
    assert sorted((tuple(r) for r in pivot_clusters.clusters(clash).collect()), key=repr) == got


def test_few_or_no_vectors(spark):
    assert pivot_clusters.clusters(spark.createDataFrame([], VECS)).collect() == []
    assert pivot_clusters.clusters(spark.createDataFrame([(1, None), (2, [1.0])], VECS)).collect() == []
    rows = vectors(1, 5, 1.0)
    got = pivot_clusters.clusters(spark.createDataFrame(rows, VECS)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_clusters(rows)
    with pytest.raises(Exception, match="would not fit"):
        pivot_clusters.clusters(spark.createDataFrame([(1, [1e30] * 64)], VECS)).collect()


def test_pivot_bounds_lose_no_tie():
    rng = np.random.default_rng(5)
    v = rng.integers(-3, 4, size=(5000, 64))
    c = np.concatenate([v[:8], v[:8], rng.integers(-2, 3, size=(8, 64))])
    p = v[10:14]
    who, dist = pivot_clusters.nearest_centroids(v, pivot_clusters.squared(v, p), c, p)
    d = pivot_clusters.squared(v, c)
    assert (who == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
