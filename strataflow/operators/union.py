"""Unions by column name."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept.

    Strict by default: column sets must match. ``allow_missing`` fills absent columns
    with null instead.
    """
    if not frames:
        raise ValueError("nothing to unite")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_labelled(sources: Mapping[str, DataFrame], col: str, allow_missing: bool = False) -> DataFrame:
    """Unite the sources and record each row's source label in ``col``.

    The label is a literal per branch, so a filter on it leaves only the matching scan.
    """
    return union_by_name([df.withColumn(col, F.lit(label)) for label, df in sources.items()], allow_missing)
