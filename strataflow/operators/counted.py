"""Rows counted at steps of a plan while it runs, without another pass."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class StepCounts:
    """Counts of the rows that pass the marked steps of one or several writes.

    Spark adds them up in the tasks that write; a step that no write has run yet counts nothing. A stage that runs twice
    because an executor was lost may count rows twice: the figures are for reports, not for decisions. Counting ends
    generated code at each step, so it is off unless asked for; then frames stay as they are.
    """

    def __init__(self, active: bool = True) -> None:
        self.active = active
        self._seen: list[tuple[str, Observation]] = []

    def at(self, step: str, df: DataFrame, **more: Column) -> DataFrame:
        """``df``, with its rows counted as ``step`` and those that meet a condition of ``more`` under its name."""
        if not self.active:
            return df
        seen = Observation(f"{step}-{uuid.uuid4().hex}")
        self._seen.append((step, seen))
        conditions = (F.count_if(condition).alias(name) for name, condition in more.items())
        return df.observe(seen, F.count(F.lit(1)).alias(step), *conditions)

    def get(self) -> dict[str, int]:
        """The counts by name. Waits until everything that was marked has run, so only mark what will be."""
        out: dict[str, int] = {}
        for _, seen in self._seen:
            for name, n in seen.get.items():
                out[name] = out.get(name, 0) + n
        return out
