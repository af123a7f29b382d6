"""The whole run: landing files to bronze, silver and gold."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strataflow.functions.columns import AsOf
from strataflow.plans.clean import CleanSpec
from strataflow.plans.layers import (
    LayerError,
    LayerReport,
    Rejects,
    build_bronze,
    build_bronze_from,
    build_gold,
    build_silver,
    layer_counts,
    rejects,
)
from strataflow.plans.presets import (
    TELEMETRY_COLUMNS,
    TELEMETRY_GOLD,
    TELEMETRY_LABEL,
    TELEMETRY_LINEAGE,
    TELEMETRY_SOURCES,
    TELEMETRY_SPEC,
)
from strataflow.sources.landing import TABLE_SUFFIX, Paths, landing_columns
from strataflow.streaming.ingest import INGEST_STAGE, ingest_once


@dataclass(frozen=True)
class PipelineConfig:
    """Landing folders by label, and what to make of them.

    Tables are named ``<label>_bz`` unless ``tables`` names them. ``mode`` is that of bronze and silver; gold is
    added to with ``"once"`` and replaced otherwise. ``run`` names the run in the
    event log; a number there makes it a row of the run ledger.

    ``ingest`` names a folder: then a run first loads each landing file into it exactly once, as a stage of its own, and
    bronze is made from there. It needs a ``checkpoint``, and is for the modes that make bronze anew. A run that meets files
    with other columns loads the rest and fails before bronze; the next run goes on without those files.
    """

    landing: Mapping[str, Paths]
    spec: CleanSpec
    gold_table: str
    gold_label: str
    columns: tuple[str, ...] | None = None
    lineage: str = "source_id"
    tables: Mapping[str, str] | None = None
    prefix: str = ""
    mode: str = "replace"
    checkpoint: str | None = None
    headers: str = "auto"
    gold_by_label: bool = False
    as_of: AsOf = None
    run: str = "1"
    ingest: str | None = None

    def table(self, label: str) -> str:
        return self.tables[label] if self.tables else label + TABLE_SUFFIX


def telemetry_config(root: str, **overrides) -> PipelineConfig:
    """The battery cycler set-up over a landing tree with one folder per source."""
    settings = {
        "landing": {label: f"{root.rstrip('/')}/{folder}" for folder, label in TELEMETRY_SOURCES.items()},
        "tables": {label: folder + TABLE_SUFFIX for folder, label in TELEMETRY_SOURCES.items()},
        "spec": TELEMETRY_SPEC,
        "columns": TELEMETRY_COLUMNS,
        "gold_table": TELEMETRY_GOLD,
        "gold_label": TELEMETRY_LABEL,
        "lineage": TELEMETRY_LINEAGE,
    }
    return PipelineConfig(**{**settings, **overrides})


@contextmanager
def stage(spark: SparkSession, run: str, name: str, clock: Callable[[str, float], None] | None) -> Iterator[None]:
    """Put the jobs of a stage into the job group ``<run>/<stage>``, under which the event
    log sums their metrics, and report the elapsed seconds."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.jobGroup.id")
    context.setLocalProperty("spark.jobGroup.id", f"{run}/{name}")
    started = time.monotonic()
    try:
        yield
    finally:
        context.setLocalProperty("spark.jobGroup.id", before)
        if clock:
            clock(name, time.monotonic() - started)


def _ingest(spark: SparkSession, config: PipelineConfig, table: str, paths: Paths, problems: list[Rejects]) -> DataFrame:
    """All rows of a source that were ever ingested, new files included; new files with other columns become problems."""
    columns = list(config.columns or landing_columns(spark, paths))
    place, seen = f"{config.ingest.rstrip('/')}/{table}", f"{config.checkpoint.rstrip('/')}/{INGEST_STAGE}/{table}"

    def report(bad: DataFrame) -> None:
        problems.extend(rejects(spark, INGEST_STAGE, table, bad))

    rows = ingest_once(
        spark, paths, place, seen, columns, config.lineage, run=config.run,
        headers="same" if config.headers == "same" else "by_file", on_rejects=report,
    )
    return rows.select(*columns, config.lineage)


def run_pipeline(
    spark: SparkSession,
    config: PipelineConfig,
    clock: Callable[[str, float], None] | None = None,
    reports: list[LayerReport] | None = None,
) -> DataFrame:
    """Build all three layers and return the rows per table as ``layer, source, n``.

    A re-run in ``replace`` mode gives the same tables at the same cost. ``reports`` takes the report of each layer, with
    the rows that were read, left out and written.
    """
    count_rows = reports is not None
    reports = reports if count_rows else []
    tables = {label: config.table(label) for label in config.landing}
    if config.ingest and (config.mode != "replace" or not config.checkpoint):
        raise ValueError("ingest needs a checkpoint folder and mode='replace'")
    if config.ingest:
        problems: list[Rejects] = []
        with stage(spark, config.run, INGEST_STAGE, clock):
            arrived = {tables[label]: _ingest(spark, config, tables[label], paths, problems) for label, paths in config.landing.items()}
        if problems:
            raise LayerError(problems)
    with stage(spark, config.run, "bronze", clock):
        if config.ingest:
            reports.append(build_bronze_from(spark, arrived, config.as_of, config.prefix, count_rows=count_rows))
        else:
            bronze = build_bronze(
                spark,
                {tables[label]: paths for label, paths in config.landing.items()},
                config.columns,
                config.as_of,
                config.mode,
                config.prefix,
                config.headers,
                config.lineage,
                checkpoint=config.checkpoint,
                count_rows=count_rows,
            )
            reports.append(bronze)
    with stage(spark, config.run, "silver", clock):
        silver = build_silver(spark, list(tables.values()), config.spec, config.as_of, config.mode, config.prefix, count_rows=count_rows)
        reports.append(silver)
    with stage(spark, config.run, "gold", clock):
        gold_mode = "once" if config.mode == "once" else "replace"
        gold = build_gold(
            spark, tables, config.gold_table, config.gold_label, config.prefix, config.gold_by_label, mode=gold_mode, count_rows=count_rows
        )
        reports.append(gold)
    layers = {"bronze": tables, "silver": tables, "gold": {"all": config.gold_table}}
    return layer_counts(spark, layers, config.prefix)
