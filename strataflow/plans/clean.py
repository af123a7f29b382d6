"""Cleaning rules as data, and the plan that applies them."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import AsOf, require_not_null, to_double, trim_columns, with_load_time
from strataflow.operators.counted import StepCounts
from strataflow.operators.dedup import dedup


@dataclass(frozen=True)
class CleanSpec:
    """What makes a row clean, applied in the order of the fields.

    Null checks come before trimming and casting, so blank text survives as ``''`` and a
    malformed number as null. Keys and order refer to the cleaned values.
    """

    not_null: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    to_double: tuple[str, ...] = ()
    dedup_keys: tuple[str, ...] = ()
    dedup_order: tuple[str, ...] = ()
    keep: str = "first"
    processed_col: str = "processed_at"


def clean(df: DataFrame, spec: CleanSpec, as_of: AsOf = None, counts: StepCounts | None = None) -> DataFrame:
    """Apply the rules: one filter and one projection on the scan, then one shuffle.

    ``counts`` counts the rows read, those with all required values (and among these the ones with a malformed number), and
    those that are left, while the result is written; all rows are read then, none is skipped by the file's statistics.
    """
    if counts and counts.active:
        df = counts.at("rows_in", df)
    rows = require_not_null(df, spec.not_null)
    if counts and counts.active:
        bad = [F.col(c).isNotNull() & F.col(c).try_cast("double").isNull() for c in spec.to_double]
        rows = counts.at("valued", rows, malformed=functools.reduce(operator.or_, bad, F.lit(False)))
    rows = to_double(trim_columns(rows, spec.trim), spec.to_double)
    if spec.dedup_keys:
        rows = dedup(rows, spec.dedup_keys, spec.dedup_order, spec.keep)
    return with_load_time(rows, spec.processed_col, as_of)
