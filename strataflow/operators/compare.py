"""Comparison of run ledgers across configurations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.columns import category_rank, nan_to_null
from strataflow.operators.stages import STAGES

# The ledger columns that a comparison averages.
COMPARED_METRICS = (
    "total_time", "t_ingest", "t_bronze", "t_silver", "t_gold",
    "cpu_bronze", "cpu_silver", "cpu_gold",
    "mem_bronze", "mem_silver", "mem_gold",
    "throughput_bronze", "throughput_silver", "throughput_gold",
    "write_bronze", "write_silver", "write_gold",
)
COMPARED_STAGES = STAGES[1:]


def mean_by(df: DataFrame, by: str | Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per group; null and NaN cells are skipped."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.avg(nan_to_null(F.col(m).cast("double"))).alias(m) for m in metrics])


def stage_share(df: DataFrame, stages: Sequence[str], total: str = "total", suffix: str = "_share") -> DataFrame:
    """Add the row total over the stage columns and each stage's share of it.

    A missing stage counts as 0 in the total; shares of a zero total are null.
    """

    def filled(stage: str) -> Column:
        return F.coalesce(F.col(stage).cast("double"), F.lit(0.0))

    summed = df.withColumn(total, sum((filled(s) for s in stages[1:]), filled(stages[0])))
    return summed.withColumns({s + suffix: F.try_divide(filled(s), F.col(total)) for s in stages})


def compare_configs(
    ledger: DataFrame,
    baseline: str,
    order: Sequence[str],
    config: str = "config",
    metrics: Sequence[str] = COMPARED_METRICS,
    stages: Sequence[str] = COMPARED_STAGES,
    total_time: str = "total_time",
) -> DataFrame:
    """One row per configuration: category rank, metric means, stage shares, speed-up.

    ``speedup`` is the baseline's mean total time over the configuration's own, taken from the
    means, a row for each configuration; the ledger is read once.
    """
    means = mean_by(ledger, config, dict.fromkeys([*metrics, total_time]))
    base = F.max(F.when(F.col(config) == baseline, F.col(total_time))).over(Window.partitionBy(F.lit(0)))
    shared = stage_share(means, [f"t_{s}" for s in stages], total="t_stages")
    return shared.withColumn("speedup", F.try_divide(base, F.col(total_time))).withColumn(
        "cat_rank", category_rank(F.col(config), order)
    )
