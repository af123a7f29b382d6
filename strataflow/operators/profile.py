"""Table profiles: row counts, null counts, duplicate rows, previews."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.union import union_labelled


_HASH = "__hash"


def profile_counts(frames: Mapping[str, DataFrame], name: str = "tbl") -> DataFrame:
    """Rows per frame; reads no column."""
    counts = {label: df.agg(F.count(F.lit(1)).alias("n")) for label, df in frames.items()}
    return union_labelled(counts, name).select(name, "n")


def profile_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column as rows ``col, n_null``, all columns counted in one pass."""
    cols = list(cols or df.columns)
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return totals.unpivot([], cols, "col", "n_null")


def profile_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column combinations that occur more than once, with their count ``n``.

    A hash of the columns is counted first, so what is shuffled of all rows is one number each, summed
    before; only rows whose hash repeats are compared by their values.
    """
    cols = list(cols or df.columns)
    hashed = df.select(*cols, F.xxhash64(*cols).alias(_HASH))
    repeated = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(_HASH)
    rest = hashed.join(repeated, _HASH, "left_semi")
    return rest.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """The ``n`` least rows by ``order``; each task keeps only its own ``n``."""
    return df.orderBy(*order).limit(n)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame that several actions read, and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
