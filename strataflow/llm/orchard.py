"""Clustering around centroids, with Orchard's search for the nearest one.

Each centroid has a list of all others by their distance from it. A vector walks along the list of the closest centroid so
far; whenever it meets a closer one it goes on with that one's list, without measuring any centroid twice, and it stops
where the list is strictly beyond twice the distance: what follows can't even be as near. All arithmetic is on whole
numbers and exact, so the result doesn't depend on how rows are dealt.

A round is one pass: each task sends a sum per centroid, whatever its rows, and Spark adds them up. Only centroids
reach the driver and the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strataflow.llm.common import hidden, ship_package, without, written
from strataflow.llm.vectors import LONG, integers, largest, whole_vectors

Centroids = Sequence[Sequence[int]]
#: Rows that a task works on at a time.
ROWS = 4096
#: Sums travel as multiples of this and a rest, as one decimal can't hold the largest.
LIMB = 10**18


class Orchard:
    """The nearest of some centroids, the smaller number among equals."""

    def __init__(self, centroids: Centroids):
        self.exact = integers(np.array(centroids, dtype=object))
        k = len(centroids)
        apart = np.array([[int(((a - b) ** 2).sum()) for b in self.exact] for a in self.exact], dtype=object).reshape(k, k)
        self.order = np.array([sorted(range(k), key=lambda t, c=c: (apart[c, t], t)) for c in range(k)])
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.large = max((abs(x) for c in centroids for x in c), default=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) for each row; doubles while they are exact, Python integers beyond."""
        if vectors.shape[1] * (largest(vectors) + float(self.large)) ** 2 < 2**51:
            return self._walk(vectors, self.exact.astype(np.float64), self.apart.astype(np.float64))
        return self._walk(integers(vectors), self.exact, self.apart)

    def _walk(self, vectors: np.ndarray, centroids: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(vectors), len(centroids)

        def measure(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            off = vectors[rows] - centroids[at]
            return (off * off).sum(axis=1)

        row, at = np.arange(n), np.zeros(n, dtype=np.int64)
        near, place = measure(row, at), np.zeros(n, dtype=np.int64)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        while len(row):
            c = at[row]
            row = row[~(apart[c, place[row]] > 4 * near[row]).astype(bool)]
            other = self.order[at[row], place[row]]
            place[row] += 1
            fresh = ~seen[row, other]
            some, other = row[fresh], other[fresh]
            seen[some, other] = True
            found = measure(some, other)
            closer = ((found < near[some]) | ((found == near[some]) & (other < at[some]))).astype(bool)
            some = some[closer]
            at[some], near[some], place[some] = other[closer], found[closer], 0
            row = row[place[row] < k]
        return at, near


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def first_centroids(vectors: DataFrame, k: int, size: int, salt: str) -> list[list[int]]:
    """The usable vectors whose ``<salt><vec_id>`` has the smallest SHA-256; rows without an id come last, ties by vector."""
    ship_package(vectors.sparkSession)
    source = vectors.select("vec_id", "embedding")

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            yield batch.filter(pa.array(whole_vectors(batch.column(1), size)[0]))

    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    kept = source.mapInArrow(usable, source.schema)
    rows = kept.orderBy(key.asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "embedding").limit(k).toArrow()
    column = rows.column("embedding").combine_chunks()
    return integers(whole_vectors(column, size)[1]).tolist() if rows.num_rows else []


def next_centroids(vectors: DataFrame, centroids: Centroids) -> list[list[int]]:
    """Each centroid's vectors' mean, rounded down by component; a centroid without vectors stays."""
    size, tree = len(centroids[0]), Orchard(centroids)
    schema = T.StructType(
        [T.StructField("c", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField(s, T.ArrayType(T.DecimalType(38, 0))) for s in ("high", "low")]
    )
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), size), dtype=object), np.zeros(len(centroids), dtype=np.int64)
        for batch in _batches(batches):
            rows = whole_vectors(batch.column(0), size)[1]
            at, _ = tree.nearest(rows)
            counts += np.bincount(at, minlength=len(centroids))
            if largest(rows) < 2**40:
                part = np.zeros((len(centroids), size))
                np.add.at(part, at, rows)  # under 2**53 for so many rows
                sums += integers(part)
            else:
                np.add.at(sums, at, integers(rows))
        filled = np.flatnonzero(counts)
        if len(filled):
            split = [[[Decimal(f(int(x), LIMB)) for x in sums[c]] for c in filled] for f in (int.__floordiv__, int.__mod__)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((filled, counts[filled], *split), shape.types, strict=True)], schema=shape)

    parts = vectors.select("embedding").mapInArrow(run, schema)
    cells = parts.select("c", "n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "s"))
    added = cells.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("s.high").alias("high"), F.sum("s.low").alias("low"))
    new = [list(c) for c in centroids]
    for r in added.collect():  # a row for each component of each centroid
        new[r["c"]][r["i"]] = (int(r["high"]) * LIMB + int(r["low"])) // r["n"]
    return new


def fit_centroids(vectors: DataFrame, *, k: int = 40, rounds: int = 5, size: int = 64, salt: str = "2:") -> list[list[int]]:
    """The centroids after so many rounds; fewer than ``k`` if there are fewer usable vectors."""
    centroids = first_centroids(vectors, k, size, salt)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(vectors, centroids)
    return centroids


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """The usable rows of ``vectors`` with ``cluster`` and ``distance`` (squared; beyond a long's range, the range's end).

    Needs the column ``embedding``; all others are kept, but for those of the new names. Rows whose vector is null,
    of another length than the centroids, or holds null or a non-finite component are left out. Repeated rows all stay;
    without centroids or rows there are none.
    """
    ship_package(vectors.sparkSession)
    kept = without(vectors, ("cluster", "distance"))
    schema = T.StructType([*kept.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not centroids:
        return kept.limit(0).withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")})
    at_column, size, tree = kept.columns.index("embedding"), len(centroids[0]), Orchard(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            fits, rows = whole_vectors(batch.column(at_column), size)
            at, near = tree.nearest(rows)
            near = near.astype(np.int64) if near.dtype != object else np.array([min(x, LONG) for x in near], dtype=np.int64)
            left = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays([*left.columns, pa.array(at.astype(np.int32)), pa.array(near)], names=schema.names)

    return kept.mapInArrow(run, schema)


def clusters(vectors: DataFrame, *, k: int = 40, rounds: int = 5, size: int = 64, salt: str = "2:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each usable vector.

    Needs ``vec_id`` and ``embedding``; other columns aren't read. See :func:`first_centroids`, :func:`next_centroids`
    and :func:`assign` for nulls, ties and repeats. Sums beyond a long's range are the range's end.
    """
    centroids = fit_centroids(vectors, k=k, rounds=rounds, size=size, salt=salt)
    rows = written(assign(vectors.select("vec_id", "embedding"), centroids).drop("embedding"), "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(total.alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = hidden("of")
    facts = [(c, min(s, LONG), min(sum(sums.values()), LONG), hashes[c]) for c, s in sums.items()]
    known = rows.sparkSession.createDataFrame(facts, f"{of} int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), F.col("cluster") == F.col(of)).drop(of)  # a row for each centroid
