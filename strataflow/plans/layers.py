"""Building the bronze, silver and gold layers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import AsOf, with_load_time
from strataflow.operators.counted import StepCounts
from strataflow.operators.union import union_by_name, union_labelled
from strataflow.plans.clean import CleanSpec, clean
from strataflow.session import scratch_path
from strataflow.sources.landing import (
    LANDING_FILES,
    Paths,
    file_headers,
    header_summary,
    landing_columns,
    read_by_header,
    read_landing,
    rejected_files,
)
from strataflow.sources.loaded import LOAD_BATCH, add_new_batches, append_as_batch, is_batched, load_new_files, note_all
from strataflow.sources.tables import ensure_layers, read_layer, table_name, write_layer

ROWS_SCHEMA = "layer string, source string, rows_in long, no_value long, malformed long, repeated long, written long"
REPORT_SCHEMA = "layer string, source string, file string, problem string"
FILES_IN_MESSAGE = 5


@dataclass(frozen=True)
class Rejects:
    """Files of one table that were left out, as a table at ``path``; ``some`` of them for a message."""

    layer: str
    source: str
    path: str
    n: int
    some: tuple[tuple[str, str], ...]

    def __str__(self) -> str:
        shown = ", ".join(f"{file}: {reason}" for file, reason in self.some)
        return f"{self.layer}.{self.source}: {self.n} files rejected, all listed in {self.path}, among them {shown}"


class LayerError(RuntimeError):
    """Some sources of a layer failed; ``problems`` has (layer, source, file, problem) rows and :class:`Rejects`."""

    def __init__(self, problems: Sequence[tuple | Rejects]):
        self.problems = list(problems)
        super().__init__("; ".join(str(p) if isinstance(p, Rejects) else f"{p[0]}.{p[1]}: {p[3]}" for p in problems))


@dataclass
class LayerReport:
    """Problems met while building a layer; empty means everything was loaded."""

    spark: SparkSession
    problems: list[tuple | Rejects] = field(default_factory=list)
    rows: list[tuple] = field(default_factory=list)

    def rows_df(self) -> DataFrame:
        """A row for each table, if the layer was built with ``count_rows``: rows read, left out for a missing value, with a
        malformed number, left out as repeated, and written; counted while they were written."""
        return self.spark.createDataFrame(self.rows, ROWS_SCHEMA)

    def to_df(self) -> DataFrame:
        """A row for each problem; every rejected file is one."""
        out = self.spark.createDataFrame([p for p in self.problems if not isinstance(p, Rejects)], REPORT_SCHEMA)
        for p in self.problems:
            if isinstance(p, Rejects):
                out = out.union(self.spark.read.schema(REPORT_SCHEMA).parquet(p.path))
        return out


def rejects(spark: SparkSession, layer: str, source: str, bad: DataFrame) -> list[Rejects]:
    """Writes the rejected files to the shared folder; none if there are none."""
    path = scratch_path(spark, "rejected")
    bad.select(
        F.lit(layer).alias("layer"), F.lit(source).alias("source"), F.col("file_path").alias("file"), F.col("reason").alias("problem")
    ).write.parquet(path)
    kept = spark.read.schema(REPORT_SCHEMA).parquet(path)
    n = kept.count()
    some = kept.orderBy("file").limit(FILES_IN_MESSAGE).collect()
    return [Rejects(layer, source, path, n, tuple((r["file"], r["problem"]) for r in some))] if n else []


def _reason(error: Exception) -> str:
    """The first line that says what went wrong: for a failed job that of its root cause."""
    cause = getattr(error, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
    text = str(error) if cause is None else str(cause.getMessage() or cause.toString())
    return " ".join(text.split("\n")[:3])


def _each_table(
    spark: SparkSession,
    layer: str,
    tables: Iterable[str],
    build: Callable[[str, StepCounts], list[tuple | Rejects]],
    on_error: str,
    at_once: int = 4,
    count_rows: bool = False,
) -> LayerReport:
    """Run one independent write job per table, ``at_once`` at a time, and gather what failed and how many rows passed."""
    if on_error not in ("raise", "report"):
        raise ValueError(f"on_error must be 'raise' or 'report', not {on_error!r}")

    counted: list[tuple] = []

    def attempt(table: str) -> list[tuple | Rejects]:
        counts = StepCounts(count_rows)
        try:
            problems = build(table, counts)
            if count_rows:
                counted.append(_row_counts(layer, table, counts.get()))
            return problems
        except Exception as error:  # noqa: BLE001 - one table's failure must not hide the others'
            return [(layer, table, None, _reason(error))]

    tables = list(tables)
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(tables)))) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(attempt), table) for table in tables]
        problems = [problem for job in jobs for problem in job.result()]
    if problems and on_error == "raise":
        raise LayerError(problems)
    return LayerReport(spark, problems, sorted(counted))


def _row_counts(layer: str, table: str, seen: dict[str, int]) -> tuple:
    rows, written = seen.get("rows_in", 0), seen.get("written", 0)
    valued = seen.get("valued", rows)
    return layer, table, rows, rows - valued, seen.get("malformed", 0), valued - written, written


def build_bronze(
    spark: SparkSession,
    sources: Mapping[str, Paths],
    columns: Sequence[str] | None = None,
    as_of: AsOf = None,
    mode: str = "replace",
    prefix: str = "",
    headers: str = "auto",
    lineage: str = "source_id",
    suffix: str = ".csv",
    every_suffix: bool = False,
    loaded_col: str = "created_at",
    checkpoint: str | None = None,
    on_error: str = "raise",
    files: str = LANDING_FILES,
    at_once: int = 4,
    count_rows: bool = False,
) -> LayerReport:
    """One bronze table per source from its landing files, all columns text.

    ``sources`` maps table names to folders or files. A source is loaded by a single
    job, however many files it has. ``columns`` defaults to the header of one file, which
    also tells in what order the files have them.

    ``headers="auto"`` or ``"by_file"`` reads the first line of every file before anything is written; files
    with the same columns in another order are loaded by name, and files with other columns are
    reported as problems while the rest is loaded. ``"same"`` reads no header beforehand and fails
    on the first file that differs.

    ``mode="replace"`` makes a re-run give the same tables, ``"append"`` loads all files
    again, and ``"once"`` adds only files that the table doesn't have yet, as noted below
    the ``checkpoint`` folder (one folder per source); its tables have the extra column ``load_batch``.
    Modes may change between runs: ``once`` after ``replace`` starts the table anew from the files there are;
    ``append`` to a ``once`` table notes all files as loaded if it is given the checkpoint.
    All modes load the same files: those named like ``files`` directly in a source's folders.
    """
    if headers not in ("auto", "same", "by_file"):
        raise ValueError(f"headers must be 'auto', 'same' or 'by_file', not {headers!r}")
    ensure_layers(spark, prefix)
    if mode == "once" and not checkpoint:
        raise ValueError("mode='once' needs a checkpoint folder")

    def load(table: str, counts: StepCounts) -> list[tuple | Rejects]:
        paths = sources[table]
        in_file = landing_columns(spark, paths, files)
        names = list(columns or in_file)
        if sorted(in_file) != sorted(names):
            in_file = names
        target = table_name("bronze", table, prefix)
        seen = f"{checkpoint.rstrip('/')}/{table}" if checkpoint else None
        problems: list[tuple | Rejects] = []

        def rows_of(some: Paths) -> DataFrame:
            if headers == "same":
                rows = read_landing(spark, some, in_file, "same", lineage, suffix, every_suffix, files)
            else:
                found = file_headers(spark, some, files)
                summary = header_summary(spark, found, names)
                if summary.n_rejected:
                    problems.extend(rejects(spark, "bronze", table, rejected_files(spark, some, names, found)))
                rows = read_by_header(spark, some, names, found, lineage, suffix, every_suffix, files, summary=summary)
            return with_load_time(rows.select(*names, lineage), loaded_col, as_of)

        counted = lambda rows: counts.at("written", counts.at("rows_in", rows))
        if mode == "once":
            load_new_files(spark, paths, target, seen, rows_of, files, done=counted)
        elif mode == "append" and is_batched(spark, target):
            append_as_batch(counted(rows_of(paths)), target)
            if seen:
                note_all(spark, paths, target, seen, files)
        else:
            write_layer(counted(rows_of(paths)), target, mode)
        return problems

    return _each_table(spark, "bronze", sources, load, on_error, at_once, count_rows)


def build_bronze_from(
    spark: SparkSession,
    rows: Mapping[str, DataFrame],
    as_of: AsOf = None,
    prefix: str = "",
    loaded_col: str = "created_at",
    on_error: str = "raise",
    at_once: int = 4,
    count_rows: bool = False,
) -> LayerReport:
    """One bronze table per source from text rows that were ingested before, replacing it."""
    ensure_layers(spark, prefix)

    def load(table: str, counts: StepCounts) -> list[tuple]:
        counted = counts.at("written", counts.at("rows_in", rows[table]))
        write_layer(with_load_time(counted, loaded_col, as_of), table_name("bronze", table, prefix))
        return []

    return _each_table(spark, "bronze", rows, load, on_error, at_once, count_rows)


def build_silver(
    spark: SparkSession,
    tables: Sequence[str],
    spec: CleanSpec,
    as_of: AsOf = None,
    mode: str = "replace",
    prefix: str = "",
    on_error: str = "raise",
    count_rows: bool = False,
) -> LayerReport:
    """Clean each bronze table into the silver table of the same name.

    De-duplication works within one table and one run. ``mode="append"`` adds the
    result to what silver has; ``"replace"`` makes a re-run give the same table. ``"once"`` cleans only the
    batches that bronze has loaded since and adds the rows whose keys silver doesn't have: of rows with
    equal keys the one that came with the earlier load stays, within a load the least.
    """
    ensure_layers(spark, prefix)

    def refine(table: str, counts: StepCounts) -> list[tuple]:
        bronze, silver = (table_name(layer, table, prefix) for layer in ("bronze", "silver"))
        if mode == "once":
            make = lambda rows: clean(rows, spec, as_of, counts)
            add_new_batches(spark, {None: bronze}, silver, make, keys=spec.dedup_keys, done=lambda rows: counts.at("written", rows))
            return []
        cleaned = clean(read_layer(spark, "bronze", table, prefix).drop(LOAD_BATCH), spec, as_of, counts)
        write_layer(counts.at("written", cleaned), silver, mode)
        return []

    return _each_table(spark, "silver", tables, refine, on_error, count_rows=count_rows)


def build_gold(
    spark: SparkSession,
    sources: Mapping[str, str],
    target: str,
    label: str,
    prefix: str = "",
    by_label: bool = False,
    on_error: str = "raise",
    mode: str = "replace",
    count_rows: bool = False,
) -> LayerReport:
    """Merge silver tables (label -> table) into one gold table, replacing it.

    ``mode="once"`` adds only the batches of silver that gold doesn't have yet.

    Rows are labelled with their source and kept as they are, duplicates included.
    ``by_label`` stores one folder per label, so a label filter skips the others.
    """
    ensure_layers(spark, prefix)

    def merge(table: str, counts: StepCounts) -> list[tuple]:
        counted = lambda rows: counts.at("written", counts.at("rows_in", rows))
        if mode == "once":
            silver_tables = {name: table_name("silver", source, prefix) for name, source in sources.items()}
            add_new_batches(spark, silver_tables, table_name("gold", table, prefix), lambda rows: rows, label, done=counted)
            return []
        silver = {name: read_layer(spark, "silver", source, prefix).drop(LOAD_BATCH) for name, source in sources.items()}
        partition_by = [label] if by_label else []
        write_layer(counted(union_labelled(silver, label)), table_name("gold", table, prefix), "replace", partition_by)
        return []

    return _each_table(spark, "gold", [target], merge, on_error, count_rows=count_rows)


def layer_counts(spark: SparkSession, tables: Mapping[str, Mapping[str, str]], prefix: str = "") -> DataFrame:
    """Rows per stored table as ``layer, source, n``; ``tables`` is layer -> label -> table.

    Counts come from the Parquet footers, no column is read.
    """
    counts = [
        read_layer(spark, layer, table, prefix)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("source"), "n")
        for layer, its_tables in tables.items()
        for name, table in its_tables.items()
    ]
    return union_by_name(counts)
