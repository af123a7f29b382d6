import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataflow.llm import cover_tree
from strataflow.llm.cover_tree import Block, CoverTree, Groups, best_of, kept_pairs, reach, top_k
from strataflow.llm.orchard import Orchard, assign, clusters, fit_centroids
from strataflow.llm.vectors import LONG, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label string"


def whole(vector):
    """By definition; None if the vector can't be used."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def slow_top_k(rows, is_query, k):
    usable = [(i, v) for i, v in ((i, whole(v)) for i, v, *_ in rows) if v is not None]
    out = []
    for n, (i, v) in enumerate(usable):
        if i is not None and is_query(i):
            scores = [(max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(v, w, strict=False)))), j) for m, (j, w) in enumerate(usable) if m != n]
            scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def found_top_k(spark, rows, parts, k):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = top_k(df, F.col("vec_id") % parts == 0, k).collect()
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str)


def gathered(seed, n, centres=8, size=12, noise=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size)) * 3
    return [(i, [float(x) for x in middle[i % centres] + rng.normal(size=size) * noise], "x") for i in range(n)]


@pytest.mark.parametrize("kind", ["gathered", "odd", "copies", "large", "few"])
def test_top_k_against_brute_force(spark, monkeypatch, kind):
    rows, parts, k = gathered(1, 600), 10, 5
    if kind == "gathered":  # many blocks and groups
        monkeypatch.setattr(cover_tree, "QUERY_BLOCK", 8)
        monkeypatch.setattr(cover_tree, "DATA_BLOCK", 32)
        monkeypatch.setattr(cover_tree, "SAMPLE", 40)
    elif kind == "odd":
        rows = rows[:40] + [
            (50, None, "a"), (60, [], "b"), (61, [1.0], None), (70, [None, 1.0], "c"), (80, [float("nan")], "d"), (None, [9.0] * 12, "e"),
            (90, [float("inf")], "f"), (100, [0.5] * 30, "g"), (101, [-0.001] * 3, "h"), (0, [7.0] * 12, "same id"), (0, [7.0] * 12, "same row"),
        ]
    elif kind == "copies":
        rows += [(1000 + i, [2.0] * 12, "copy") for i in range(300)] + [(3000, [0.0] * 12, "zero")]
        monkeypatch.setattr(cover_tree, "DATA_BLOCK", 50)
    elif kind == "large":
        rows = [(i, [x * 10.0 ** (3 * (i % 9)) for x in v], "l") for i, v, _ in rows[:90]] + [(200, [3e38] * 12, "m"), (210, [-3e38] * 12, "n")]
    else:
        rows, k = rows[:4], 7
    assert found_top_k(spark, rows, parts, k) == slow_top_k(rows, lambda i: i % parts == 0, k)


def test_top_k_of_nothing(spark):
    assert found_top_k(spark, [], 10, 5) == [] and found_top_k(spark, [(1, [1.0], "x"), (3, [2.0], "y")], 2, 5) == []
    assert found_top_k(spark, [(2, None, "x"), (4, [2.0], "y")], 2, 5) == []


def test_pairs_out_of_reach_are_pruned():
    rows = np.stack([v for _, v, _ in gathered(2, 2000, size=64)]) * 256
    tree = CoverTree.build(rows[:400], np.arange(400))
    leaf, away = tree.hang(rows)
    count = np.bincount(leaf, minlength=len(tree.points))
    far = np.zeros(len(tree.points))
    np.maximum.at(far, leaf, away)
    groups = Groups.make(tree, count, far, 100)
    scores = rows @ rows.T
    kth = np.sort(scores, axis=1)[:, -6]
    worst = np.full(len(groups.point), np.inf)
    np.minimum.at(worst, groups.of[leaf], kth)
    pairs = set(kept_pairs(groups, worst, groups))
    assert len(pairs) < 0.5 * len(groups.point) ** 2
    for q in range(len(rows)):
        for d in np.flatnonzero(scores[q] >= kth[q]):
            assert (groups.of[leaf[q]], groups.of[leaf[d]]) in pairs


def test_tree_covers_and_bounds_hold():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(500, 5)) * rng.choice([1, 100, 1e6], size=(500, 1))
    rows[100:200] = rows[0]
    tree = CoverTree.build(rows, np.arange(500))
    assert {tuple(p) for p in tree.points} == {tuple(r) for r in rows} and len(tree.points) == 400
    one, two = rows[:50], rows[50:100]
    far_one, far_two = rng.random(50) * 10, rng.random(50) * 1e5
    step = rng.normal(size=(50, 5))
    step /= np.sqrt((step**2).sum(axis=1))[:, None]
    moved = (one + step * far_one[:, None]) @ (two + step * far_two[:, None]).T
    assert (moved <= reach(one, far_one, two, far_two)).all()


def test_groups_are_skipped_in_tasks(monkeypatch):
    rows = np.stack([v for _, v, _ in gathered(4, 3000, size=16)]) * 256 // 1
    tree = CoverTree.build(rows[:200], np.arange(200))
    leaf = np.sort(tree.hang(rows)[0])
    rows = rows[np.argsort(tree.hang(rows)[0], kind="stable")]
    block = Block(np.arange(3000), np.arange(3000), np.ones(3000, bool), leaf, np.full(3000, -LONG - 1), rows)
    scored = []
    monkeypatch.setattr(cover_tree, "SCORED", 64)
    partition = np.partition
    monkeypatch.setattr(np, "partition", lambda a, *x, **y: (scored.append(a.size), partition(a, *x, **y))[1])
    got = {}
    for at, row, score in best_of(block, block, 3):
        for a, r, s in zip(at, row, score, strict=True):
            got.setdefault(int(a), []).append((int(s), int(r)))
    full = rows @ rows.T
    np.fill_diagonal(full, -np.inf)
    for q in range(0, 3000, 7):
        assert got[q] == sorted(((int(s), d) for d, s in enumerate(full[q]) if np.isfinite(s)), key=lambda x: (-x[0], x[1]))[:3]
    assert sum(scored) < 0.5 * 3000 * 3000


def test_whole_vectors():
    column = pa.array([[0.5, -0.001], None, [None, 1.0], [], [float("nan")], [1e308], [3.0]], pa.list_(pa.float64()))
    fits, made = whole_vectors(column)
    assert fits.tolist() == [True, False, False, True, False, False, True] and made.tolist() == [[128, -1], [0, 0], [768, 0]]
    fits, made = whole_vectors(column.slice(4), 1)
    assert fits.tolist() == [False, False, True] and made.tolist() == [[768]]
    assert whole_vectors(pa.array([], pa.list_(pa.float32())), 3)[1].shape == (0, 3)


def slow_clusters(rows, k, rounds, size):
    kept = [(i, w) for i, w in ((i, whole(v)) for i, v, *_ in rows) if w is not None and len(w) == size]
    name = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centroids = [w for _, w in sorted(kept, key=lambda r: (r[0] is None, name(r[0]), r[1]))[:k]]
    near = lambda w: min((sum((a - b) ** 2 for a, b in zip(w, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        mine = [near(w)[1] for _, w in kept]
        for c in set(mine):
            own = [w for (_, w), m in zip(kept, mine, strict=True) if m == c]
            centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [near(w) for _, w in kept]
    clip = lambda x: min(x, LONG)
    within = {c: clip(sum(clip(d) for d, m in last if m == c)) for _, c in last}
    total = clip(sum(clip(d) for d, _ in last))
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, clip(d), within[c], total, shas[c]) for (i, _), (d, c) in zip(kept, last, strict=True)), key=str)


def found_clusters(spark, rows, k, rounds, size):
    got = clusters(spark.createDataFrame(rows, SCHEMA).repartition(3), k=k, rounds=rounds, size=size).collect()
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[n] for n in names) for r in got), key=str)


@pytest.mark.parametrize("kind", ["gathered", "ties", "odd", "large", "few", "none"])
def test_clusters_against_brute_force(spark, kind):
    rows, k, rounds = gathered(5, 300, size=12, noise=1.0), 9, 3
    if kind == "ties":
        rng = np.random.default_rng(6)
        rows = [(i, [float(x) for x in rng.integers(-1, 2, 12) / 256], "t") for i in range(200)] + [(500 + i, [0.0] * 12, "t") for i in range(150)]
    elif kind == "odd":
        rows = rows[:60] + [(None, [1.0] * 12, "n"), (700, None, "a"), (701, [1.0], "b"), (702, [None] * 12, "c"), (703, [float("inf")] * 12, "d"), rows[3], rows[3]]
    elif kind == "large":
        rows = [(i, [x * 10.0 ** (4 * (i % 9)) for x in v], "l") for i, v, _ in rows[:60]] + [(999, [-3e38] * 12, "m")]
    elif kind == "few":
        rows = rows[:5]
    elif kind == "none":
        rows = [(1, None, "x")]
    assert found_clusters(spark, rows, k, rounds, 12) == slow_clusters(rows, k, rounds, 12)


def test_walk_stops_early(monkeypatch):
    """Far centroids aren't measured, and no centroid is measured twice for a row."""
    rows = np.floor(np.stack([v for _, v, _ in gathered(7, 400, centres=20)]) * 256)
    tree = Orchard([[int(x) for x in r] for r in rows[:20]])
    measured = []
    take = np.ndarray.sum
    at, near = tree.nearest(rows)
    assert at.tolist() == [n % 20 for n in range(400)]
    exact = ((rows[:, None] - rows[None, :20]) ** 2).sum(axis=2)
    assert near.tolist() == exact.min(axis=1).tolist()

    class Counted(np.ndarray):
        def sum(self, *a, **b):
            measured.append(len(self))
            return take(np.asarray(self), *a, **b)

    tree._walk(rows.view(Counted), tree.exact.astype(float), tree.apart.astype(float))
    assert 400 < sum(measured) < 0.9 * 400 * 20


def test_assign_keeps_other_columns(spark):
    rows = gathered(8, 20, size=3)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"Cluster": F.lit("old"), "c": F.lit(1), "i": F.lit(2)})
    centroids = fit_centroids(df, k=4, rounds=2, size=3)
    out = assign(df, centroids)
    assert out.columns == ["vec_id", "embedding", "label", "c", "i", "cluster", "distance"] and out.count() == 20
    assert assign(df, []).count() == 0
