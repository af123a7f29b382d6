"""Exact search for the largest inner products, by a dual tree.

Queries and data hang under the leaves of one cover tree, each row under the nearest, and every leaf knows how far its
rows of either kind lie from it. Neighbouring leaves make groups. A pair of a query group and a data group is pruned if no
two of their rows, given the covering radii, can reach the worst k-th score of the group's queries. Pairs that
remain meet in tasks, where smaller groups of the same leaves are taken in the order of their bounds, and
pruned against k-th scores that rise as rows are scored. What a query has so far at least comes from scoring it
against the tree's own points when it is hung up.

The tree is built from a bounded sample, but all radii are of all rows, so results are exact whatever the sample. Groups are
split into blocks of bounded size by a hash, so equal vectors may be any share of the rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import ship_package, written
from strataflow.llm.vectors import LONG, integers, largest, whole_vectors

#: Rows of the sample that the tree is made of, and about how many groups of leaves each kind of row has; never more than leaves.
SAMPLE, GROUPS = 512, 256
#: Rows of a block, which is what a task holds of a group at once.
QUERY_BLOCK, DATA_BLOCK = 4096, 4096
#: Rows of a small group in a task, and data rows that are scored before k-th scores are looked at again.
QUERY_FEW, DATA_FEW, SCORED = 64, 256, 1024
ROWS = 4096


@dataclass
class CoverTree:
    """Leaves' points, in an order that keeps the leaves of a node together, and the nodes' leaves."""

    points: np.ndarray
    ids: np.ndarray  # of the rows that the points come from
    root: list  # a node is the list of its children, a leaf is its place in points

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray) -> CoverTree:
        """Every node covers its points; its children are points that cover them within half its radius and are further apart."""
        order: list[int] = []

        def node(mine: np.ndarray) -> list | int:
            left = np.sqrt(((points[mine] - points[mine[0]]) ** 2).sum(axis=1))
            half = left.max() / 2
            if not half:  # one point, or equal ones
                order.append(int(mine[0]))
                return len(order) - 1
            near, heads = np.zeros(len(mine), dtype=np.int64), 1  # the point itself, then always the one furthest from all
            while left.max() > half:
                off = np.sqrt(((points[mine] - points[mine[left.argmax()]]) ** 2).sum(axis=1))
                near = np.where(off < left, heads, near)
                left = np.minimum(off, left)
                heads += 1
            return [node(mine[near == h]) for h in range(heads)]

        root = [node(np.arange(len(points)))] if len(points) else []
        return cls(points[order], ids[order], root)

    def groups(self, counts: np.ndarray, least: int) -> np.ndarray:
        """The group of each leaf: nodes of fewer than ``least`` rows, those of one parent together until they have so many."""
        of, n = np.zeros(len(self.points), dtype=np.int64), 0

        def leaves(node: list | int) -> list[int]:
            return [node] if isinstance(node, int) else [x for child in node for x in leaves(child)]

        def close(some: list[int]) -> list[int]:
            nonlocal n
            if some:
                of[some] = n
                n += 1
            return []

        def cut(node: list) -> None:
            gathered: list[int] = []
            for child in node:
                mine = leaves(child)
                if counts[mine].sum() >= least and not isinstance(child, int):
                    gathered = close(gathered)
                    cut(child)
                    continue
                if gathered and counts[gathered].sum() + counts[mine].sum() > least:
                    gathered = close(gathered)
                gathered = gathered + mine
            close(gathered)

        cut(self.root)
        return of

    def hang(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each row, and a bound of its distance."""
        wide = max(self.points.shape[1], rows.shape[1])
        points, rows = padded(self.points, wide), padded(rows, wide)
        leaf = ((points * points).sum(axis=1) - 2 * rows @ points.T).argmin(axis=1)
        return leaf, upper(np.sqrt(((rows - points[leaf]) ** 2).sum(axis=1)))


def padded(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] == width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def upper(x: np.ndarray) -> np.ndarray:
    """No less than what ``x`` would be without rounding."""
    return x + np.abs(x) * 1e-9 + 1e-6


def reach(one: np.ndarray, one_far: np.ndarray, two: np.ndarray, two_far: np.ndarray) -> np.ndarray:
    """A bound of the inner product of any row within ``one_far`` of a point of ``one`` and any within ``two_far`` of ``two``."""
    width = max(one.shape[1], two.shape[1])
    one, two = padded(one, width), padded(two, width)
    long, wide = np.sqrt((one * one).sum(axis=1)), np.sqrt((two * two).sum(axis=1))
    size = np.outer(long + one_far, wide + two_far)
    return one @ two.T + np.outer(one_far, wide) + np.outer(long, two_far) + np.outer(one_far, two_far) + size * 1e-9 + 1e-6


def consecutive(counts: np.ndarray, least: int) -> np.ndarray:
    """Leaves that follow each other, until they have ``least`` rows, have one number."""
    before = np.cumsum(counts) - counts
    group, start, out = 0, 0, []
    for b, c in zip(before.tolist(), counts.tolist(), strict=True):
        if b - start and b - start + c > least:
            group, start = group + 1, b
        out.append(group)
    return np.array(out, dtype=np.int64)


@dataclass
class Groups:
    """Groups of neighbouring leaves: of each leaf its group, of each group a point, a covering radius and its blocks."""

    of: np.ndarray
    point: np.ndarray
    far: np.ndarray
    blocks: np.ndarray

    @classmethod
    def make(cls, tree: CoverTree, counts: np.ndarray, far: np.ndarray, block: int) -> Groups:
        of = tree.groups(counts, max(block, -(-2 * int(counts.sum()) // GROUPS)))
        point = np.stack([tree.points[of == g].mean(axis=0) for g in range(of.max() + 1)])
        off = upper(np.sqrt(((tree.points - point[of]) ** 2).sum(axis=1))) + far
        reached = np.full(len(point), -np.inf)
        np.maximum.at(reached, of, np.where(counts > 0, off, -np.inf))
        return cls(of, point, np.where(np.isfinite(reached), reached, 0), np.maximum(1, -(-np.bincount(of, counts).astype(np.int64) // block)))


def kept_pairs(queries: Groups, worst: np.ndarray, data: Groups) -> list[tuple[int, int]]:
    """Pairs of a query group and a data group that can hold one of the k best; ``worst`` is by query group."""
    bound = reach(queries.point, queries.far, data.point, data.far)
    return [(int(q), int(d)) for q, d in np.argwhere(bound >= worst[:, None])]


@dataclass
class Block:
    """Rows of one block, sorted by leaf."""

    row: np.ndarray
    vec_id: np.ndarray  # null ids are told apart by ``named``
    named: np.ndarray
    leaf: np.ndarray
    least: np.ndarray
    vectors: np.ndarray

    @classmethod
    def read(cls, table: pa.Table) -> Block:
        table = table.sort_by("leaf").combine_chunks()
        _, vectors = whole_vectors(table.column("embedding").combine_chunks())
        ids = table.column("vec_id")
        get = lambda c: table.column(c).to_numpy()
        return cls(get("row"), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(), get("leaf"), get("least"), vectors)

    def few(self, size: int) -> list[np.ndarray]:
        """Small groups: rows of neighbouring leaves."""
        starts = np.flatnonzero(np.append(True, self.leaf[1:] != self.leaf[:-1])[: len(self.leaf)])
        counts = np.diff(np.append(starts, len(self.leaf)))
        group = np.repeat(consecutive(counts, size), counts)
        return np.split(np.arange(len(group)), np.flatnonzero(np.diff(group)) + 1)


def ball(rows: np.ndarray) -> tuple[np.ndarray, float]:
    middle = rows.mean(axis=0)
    return middle, float(upper(np.sqrt(((rows - middle) ** 2).sum(axis=1))).max())


def best_of(q: Block, d: Block, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, data row, score) of the k best rows of ``d`` for each query of ``q``, by place in the block.

    Rows under the query's own bound ``least`` may be missing, as k others are better.
    """
    width = max(q.vectors.shape[1], d.vectors.shape[1])
    mine, theirs = padded(q.vectors, width), padded(d.vectors, width)
    if width * max(1.0, largest(mine)) * max(1.0, largest(theirs)) >= 2**53:
        yield from _best_of_large(q, d, integers(mine), integers(theirs), k)
        return
    groups = d.few(DATA_FEW)
    balls = [ball(theirs[g]) for g in groups]
    points, far = np.stack([b[0] for b in balls]), np.array([b[1] for b in balls])
    for some in q.few(QUERY_FEW):
        point, own_far = ball(mine[some])
        bound = reach(point[None], np.array([own_far]), points, far)[0]
        kth = q.least[some].astype(np.float64)
        at = score = row = np.zeros(0)
        waiting: list[np.ndarray] = []
        falling = np.argsort(-bound)
        for n, g in enumerate(falling.tolist()):
            if bound[g] < kth.min():
                break  # no group from here on can hold better ones
            waiting.append(groups[g])
            if sum(map(len, waiting)) < SCORED and n + 1 < len(falling) and bound[falling[n + 1]] >= kth.min():
                continue
            rows = np.concatenate(waiting)
            waiting = []
            found = mine[some] @ theirs[rows].T
            found[q.row[some][:, None] == d.row[rows][None, :]] = -np.inf
            limit = np.maximum(kth, np.partition(found, -k, axis=1)[:, -k]) if found.shape[1] >= k else kth
            a, b = np.nonzero((found >= limit[:, None]) & np.isfinite(found))
            at, row, score = (np.concatenate(x).astype(np.int64) for x in ((at, a), (row, rows[b]), (score, found[a, b])))
            order = np.lexsort((d.vec_id[row], ~d.named[row], -score, at))
            at, row, score = at[order], row[order], score[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at, side="left")
            full = rank == k - 1
            kth[at[full]] = np.maximum(kth[at[full]], score[full])
            at, row, score = at[rank < k], row[rank < k], score[rank < k]
        yield some[at.astype(np.int64)], row.astype(np.int64), score.astype(np.int64)


def _best_of_large(q: Block, d: Block, mine: np.ndarray, theirs: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for numbers whose products a double can't hold."""
    clip = lambda x: max(-LONG - 1, min(LONG, x))
    for a in range(len(mine)):
        scores = [clip(x) for x in theirs @ mine[a]]
        rows = (b for b in range(len(theirs)) if d.row[b] != q.row[a])
        best = heapq.nsmallest(k, rows, key=lambda b: (-scores[b], not d.named[b], d.vec_id[b]))
        yield np.full(len(best), a), np.array(best, dtype=np.int64), np.array([scores[b] for b in best], dtype=np.int64)


def indexed(vectors: DataFrame, is_query: Column, k: int) -> tuple[CoverTree, DataFrame]:
    """The tree, and all usable rows (row, vec_id, embedding, is_query, leaf, away, least), written to the shared folder.

    ``least`` is a score that k rows beside the query's own reach, as far as the tree's points tell; for other
    rows, and where they tell nothing, it is the least long.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    some = source.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id", "embedding").limit(SAMPLE).toArrow().combine_chunks()
    fits, points = whole_vectors(some.column("embedding").combine_chunks()) if some.num_rows else (np.zeros(0, bool), np.zeros((0, 0)))
    ids = some.column("vec_id").to_pandas().to_numpy()[fits]
    tree = CoverTree.build(points, ids) if len(points) else CoverTree(np.zeros((1, 0)), np.array([None]), [0])
    # a row's number: it stays once written
    rows = source.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "embedding", "is_query")
    added = [T.StructField("leaf", T.IntegerType()), T.StructField("away", T.DoubleType()), T.StructField("least", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                fits, found = whole_vectors(batch.column(2))
                batch = batch.filter(pa.array(fits))
                leaf, away = tree.hang(found)
                least = np.full(len(found), -LONG - 1)
                asks = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
                width = max(found.shape[1], points.shape[1])
                if len(asks) and len(points) > k and width * max(1.0, largest(found)) * max(1.0, largest(points)) < 2**53:
                    score = padded(found[asks], width) @ padded(points, width).T
                    own = batch.column(1).to_pandas().to_numpy()[asks]
                    score[own[:, None] == ids[None, :]] = -np.inf
                    kth = np.partition(score, -k, axis=1)[:, -k]
                    least[asks[np.isfinite(kth)]] = kth[np.isfinite(kth)]
                made = (pa.array(leaf.astype(np.int32)), pa.array(away), pa.array(least))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    ship_package(vectors.sparkSession)
    return tree, written(rows.mapInArrow(run, schema), "cover-tree")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` rows of largest inner product, from rank 1.

    Needs ``vec_id`` and ``embedding``; other columns aren't read. ``is_query`` is a condition on them (null: no). Every
    row but the query's own is a candidate, so rows that repeat a query's id are, and a repeated query gets its rows
    each time. Components are scaled and rounded down as in ``vectors.py``; vectors that are null or hold null or a
    non-finite component take no part, shorter ones count as ending in zeros. Ties go to the smaller id, null last.
    Scores beyond a long's range count as the range's end. Fewer candidates: all of them; no rows or queries: none.
    """
    spark = vectors.sparkSession
    tree, rows = indexed(vectors, is_query, k)
    far = F.max("away")
    facts = rows.groupBy("leaf", "is_query").agg(F.count(F.lit(1)).alias("n"), far.alias("far"), F.min("least").alias("least")).collect()
    leaves = len(tree.points)
    count, radius, least = np.zeros((2, leaves), dtype=np.int64), np.zeros((2, leaves)), np.full(leaves, np.inf)
    for r in facts:  # at most two rows for each leaf
        kind = int(r["is_query"])
        count[kind, r["leaf"]], radius[kind, r["leaf"]] = r["n"], r["far"]
        if kind:
            least[r["leaf"]] = r["least"]
    # queries are data too
    data = Groups.make(tree, count.sum(axis=0), radius.max(axis=0), DATA_BLOCK)
    asking = Groups.make(tree, count[1], radius[1], QUERY_BLOCK)
    worst = np.full(len(asking.point), np.inf)
    np.minimum.at(worst, asking.of, least)
    pairs = kept_pairs(asking, worst, data)

    def meeting(kind: str, own: Groups, other: Groups, met: list[tuple[int, int]]) -> DataFrame:
        """The rows of one kind, once for each block of the other kind that they meet; a row for each group is broadcast."""
        partners: dict[int, list[int]] = {}
        for a, b in met:
            partners.setdefault(a, []).append(b)
        table = [(a, int(own.blocks[a]), [(b, int(other.blocks[b])) for b in some]) for a, some in partners.items()]
        known = spark.createDataFrame(table, "mine int, parts int, met array<struct<other: int, blocks: int>>")
        group = F.get(F.lit(own.of.tolist()), F.col("leaf"))
        part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        some = rows.where("is_query") if kind == "query" else rows
        joined = some.withColumn("mine", group).join(F.broadcast(known), "mine").withColumn("part", part)
        each = joined.select("row", "vec_id", "embedding", "leaf", "least", "mine", "part", F.explode("met").alias("m"))
        each = each.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("m.blocks") - 1)))
        mine, theirs = [F.col("mine"), F.col("part")], [F.col("m.other"), F.col("other_part")]
        keys = [*mine, *theirs] if kind == "query" else [*theirs, *mine]
        kept = (F.col(c).alias(c) for c in ("row", "vec_id", "embedding", "leaf", "least"))  # aliases tell both kinds apart
        return each.select(*(c.alias(n) for c, n in zip(keys, "abcd", strict=True)), *kept)

    queries = meeting("query", asking, data, pairs)
    others = meeting("data", data, asking, [(d, q) for q, d in pairs])
    schema = "row long, query_id long, vec_id long, score long"

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["row", "query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        q, d = Block.read(left), Block.read(right)
        at, row, value = (np.concatenate(x) for x in zip(*best_of(q, d, k), strict=True))
        ids = lambda b, at: pa.array(b.vec_id[at], mask=~b.named[at])
        return pa.table([pa.array(q.row[at]), ids(q, at), ids(d, row), pa.array(value)], names=names)

    met = queries.groupBy("a", "b", "c", "d").cogroup(others.groupBy("a", "b", "c", "d")).applyInArrow(score, schema)
    first = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = met.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
