"""Run metrics: per-stage summaries of samples, long and wide ledgers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import clock_micros, nan_to_null
from strataflow.operators.counters import Start, counter_delta

# The stages of a run, the six figures kept for each, and so the 26
# columns of a wide ledger row (run, total_time, then stage by stage).
STAGES = ("ingest", "bronze", "silver", "gold")
STAGE_FIGURES = ("t", "cpu", "mem", "read", "write", "throughput")
LEDGER_COLUMNS = ("run", "total_time", *[f"{figure}_{stage}" for stage in STAGES for figure in STAGE_FIGURES])

MB = 1024.0 * 1024.0


def per_second(amount: Column, micros: Column) -> Column:
    """Rate per second; null where no time has passed."""
    return F.try_divide(amount, micros / F.lit(1e6))


def stage_metrics(
    samples: DataFrame,
    by: Sequence[str] = ("run", "stage"),
    ts: str = "ts",
    sums: Mapping[str, Column] | None = None,
    means: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per run and stage: sample count, elapsed time, sums, means, throughput.

    ``throughput`` is the total of ``sums`` per elapsed second. A sum over nothing is
    0, a mean over nothing (or only NaN) is null.
    """
    sums, means = dict(sums or {}), dict(means or {})
    clock = clock_micros(samples, ts)
    grouped = samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        (F.max(clock) - F.min(clock)).alias("elapsed_us"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()],
        *[F.avg(nan_to_null(c.cast("double"))).alias(name) for name, c in means.items()],
    )
    if not sums:
        return grouped
    moved = sum((F.col(name).cast("double") for name in sums), F.lit(0.0))
    return grouped.withColumn("throughput", per_second(moved, F.col("elapsed_us")))


def stage_columns(
    df: DataFrame,
    by: Sequence[str],
    stage: str,
    stages: Sequence[str],
    figures: Mapping[str, tuple[Callable[[Column], Column], str | Column]],
    name: Callable[[str, str], str] = lambda figure, stage: f"{figure}_{stage}",
) -> DataFrame:
    """Long to wide: one row per ``by`` with every figure of every stage as a column.

    ``figures`` maps a figure to an aggregate function and its column. The stages are
    given, so this is one conditional aggregation: a single shuffle on ``by`` with
    map-side partials, where a pivot of several aggregates would need two.
    """
    cells = []
    for s in stages:
        here = F.col(stage) == s
        for figure, (fn, col) in figures.items():
            value = F.col(col) if isinstance(col, str) else col
            cells.append(fn(F.when(here, value)).alias(name(figure, s)))
    return df.groupBy(*by).agg(*cells)


def ledger_long(
    wide: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Wide to long: one row per ``ids`` and metric, values as double."""
    return wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(ids), list(metrics), name, value
    )


def ledger_wide(
    long: DataFrame, ids: Sequence[str], metrics: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Long to wide, the inverse of :func:`ledger_long`; expects one row per ids and metric."""
    return long.groupBy(*ids).agg(*[F.max(F.when(F.col(name) == m, F.col(value))).alias(m) for m in metrics])


def with_total_time(wide: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Add the sum of the stage times; a stage without time counts as 0."""
    times = (F.coalesce(F.col(f"t_{s}"), F.lit(0.0)) for s in stages)
    return wide.withColumn("total_time", sum(times, F.lit(0.0)))


def run_ledger(
    samples: DataFrame,
    run: str = "run",
    stages: Sequence[str] = STAGES,
    start: Start = 0,
) -> DataFrame:
    """Counter samples to the wide ledger, one row per run.

    ``samples`` has ``run, stage, sample, ts, cpu_pct, mem_pct, read_bytes,
    write_bytes`` with cumulative byte counters; ``start`` is what they showed when a
    stage began, see :func:`counter_delta`. Times are seconds, volumes MB, and the total
    is the sum of the stage times.
    """
    moved = counter_delta(samples, [run, "stage"], ["sample"], ["read_bytes", "write_bytes"], start)
    summary = stage_metrics(
        moved,
        [run, "stage"],
        sums={"read_b": F.col("read_bytes_delta"), "write_b": F.col("write_bytes_delta")},
        means={"cpu": F.col("cpu_pct"), "mem": F.col("mem_pct")},
    )
    wide = stage_columns(
        summary,
        [run],
        "stage",
        stages,
        {
            "t": (F.max, F.col("elapsed_us") / F.lit(1e6)),
            "cpu": (F.max, "cpu"),
            "mem": (F.max, "mem"),
            "read": (F.max, F.col("read_b") / F.lit(MB)),
            "write": (F.max, F.col("write_b") / F.lit(MB)),
            "throughput": (F.max, F.col("throughput") / F.lit(MB)),
        },
    )
    figures = [f"{figure}_{s}" for s in stages for figure in STAGE_FIGURES]
    return with_total_time(wide, stages).select(run, "total_time", *figures)
