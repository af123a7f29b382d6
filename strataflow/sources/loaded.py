"""Loading each landing file into a table exactly once."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path
from strataflow.sources.keyindex import KeyIndex
from strataflow.sources.landing import LANDING_FILES, Paths, landing_files, pending_files
from strataflow.sources.tables import drop_versions, quoted

LOAD_BATCH = "load_batch"
FILES_PER_BATCH = 10_000
_GENERATION = "strataflow.generation"
_SEEN = "path string, batch bigint"


def _generation(spark: SparkSession, table: str) -> str | None:
    """Which list of loaded files belongs to a table; null if it wasn't made by :func:`load_new_files`."""
    if not spark.catalog.tableExists(table):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(_GENERATION)
    return found if found and LOAD_BATCH in spark.table(table).columns else None


def loaded_files(spark: SparkSession, seen: str) -> DataFrame:
    """The files noted below ``seen``: ``path, batch``. The first call makes the list, empty."""
    note_files(spark, [], seen, 0)
    return spark.read.schema(_SEEN).parquet(seen)


def load_new_files(
    spark: SparkSession,
    src: Paths,
    table: str,
    seen: str,
    read: Callable[[list[str]], DataFrame],
    files: str = LANDING_FILES,
    files_per_batch: int = FILES_PER_BATCH,
    done: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Adds the rows that ``read`` makes of the files of ``src`` that ``table`` doesn't have yet; returns how many files.

    Which files the table has is noted below the folder ``seen``, by path, in a list of the table's own: a table
    that was dropped, or replaced by other means, starts anew with all files there are. Age and order of the files
    don't matter. The files of a batch become one partition of the column ``load_batch``, and are noted
    after it is written. If a run dies in between, the next one writes the same partition again, so
    nothing is doubled or left out. At most ``files_per_batch`` paths are on the driver at a time. The folders are listed and
    compared with the list of loaded files once for a call; files that arrive later are the next call's. ``done``
    sees what is written, to count it.
    """
    generation = _generation(spark, table)
    fresh = generation is None
    if fresh:
        generation = uuid.uuid4().hex
    seen = f"{seen.rstrip('/')}/{generation}"
    known = loaded_files(spark, seen)
    batch = known.agg(F.max("batch")).first()[0] or 0
    path = scratch_path(spark, "pending")
    pending_files(landing_files(spark, src, files).select("path"), known).sort("path").write.parquet(path)
    pending = spark.read.schema("path string").parquet(path)
    n, last = 0, ""
    while True:
        batch += 1  # in order of path; what lies before the last path is skipped by the files' least and greatest ones
        paths = [r["path"] for r in pending.where(F.col("path") > last).orderBy("path").limit(files_per_batch).collect()]
        if not paths and not (fresh and n == 0):
            return n
        rows = read([escaped(p) for p in paths or _first(src)]).withColumn(LOAD_BATCH, F.lit(batch).cast("bigint"))
        if fresh and n == 0:
            _create(spark, rows, table, generation)
        if not paths:
            return n
        _write_batch(done(rows), table, batch)
        note_files(spark, paths, seen, batch)
        n, last = n + len(paths), paths[-1]


def _write_batch(rows: DataFrame, table: str, batch: int, label: tuple[str, str] | None = None) -> None:
    """Writes one partition of the table, or writes it again."""
    spark, view = rows.sparkSession, f"batch_{uuid.uuid4().hex}"
    fixed = {LOAD_BATCH: str(batch)} if label is None else {label[0]: _text(label[1]), LOAD_BATCH: str(batch)}
    columns = ", ".join(quoted(c) for c in spark.table(table).columns if c not in fixed)
    partition = ", ".join(f"{quoted(c)} = {v}" for c, v in fixed.items())
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _batches(spark: SparkSession, table: str, label: tuple[str, str] | None = None) -> list[int]:
    """The batches that a table has partitions of, empty ones too; a row for each load, whatever its size."""
    of_label = f" PARTITION ({quoted(label[0])} = {_text(label[1])})" if label else ""
    shown = spark.sql(f"SHOW PARTITIONS {table}{of_label}").collect()
    return sorted(int(r[0].rpartition(f"{LOAD_BATCH}=")[2]) for r in shown)


def add_new_batches(
    spark: SparkSession,
    sources: Mapping[str | None, str],
    target: str,
    make: Callable[[DataFrame], DataFrame],
    label: str | None = None,
    keys: Sequence[str] = (),
    done: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Brings a table up to date with the batches of load-once tables, reading and writing only new ones.

    ``sources`` names a table for each value of the column ``label``, or for None alone. ``make`` gets the rows of a
    batch and returns what to add; with ``keys`` only rows stay whose keys no other batch has, by an index of those. Each batch
    becomes a partition of its own number, so a run that died is simply repeated; batches that
    aren't in the index are indexed first. If a source was started anew, so is the target. ``done`` sees what is written,
    to count it.
    """
    generations = [_generation(spark, t) for t in sources.values()]
    if None in generations:
        raise ValueError("only tables that are loaded once have batches")
    generation = ",".join(generations)
    fresh = _generation(spark, target) != generation
    index = KeyIndex(target, keys, LOAD_BATCH) if keys else None
    if index and fresh:
        index.drop(spark)
    elif index:
        for batch in sorted(set(_batches(spark, target)) - index.batches(spark)):
            index.add(spark, batch)
    for value, table in sources.items():
        part = None if label is None else (label, value)
        there = [] if fresh else _batches(spark, target, part)
        for batch in sorted(set(_batches(spark, table)) - set(there)):
            added = make(spark.table(table).where(F.col(LOAD_BATCH) == batch).drop(LOAD_BATCH))
            if fresh:
                shape = added.withColumn(label, F.lit("")) if label else added
                _create(spark, shape.withColumn(LOAD_BATCH, F.lit(0).cast("bigint")), target, generation, label)
                fresh = False
            if index:
                path = scratch_path(spark, "batch")
                added.write.parquet(path)  # read for its keys, then for its rows
                added = index.without_known(spark.read.schema(added.schema).parquet(path), batch)
            _write_batch(done(added), target, batch, part)
            if index:
                index.add(spark, batch)


def note_files(spark: SparkSession, paths: list[str], seen: str, batch: int) -> None:
    spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1).write.mode("overwrite").parquet(f"{seen}/batch={batch}")


def _first(src: Paths) -> list[str]:
    return [src] if isinstance(src, str) else list(src)


def _create(spark: SparkSession, rows: DataFrame, table: str, generation: str, label: str | None = None) -> None:
    """An empty table of this shape, in place of any other; only now is a table that was made by other means given up."""
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields)
    partitions = ", ".join(quoted(c) for c in [*([label] if label else []), LOAD_BATCH])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    drop_versions(spark, table)
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet PARTITIONED BY ({partitions}) TBLPROPERTIES ('{_GENERATION}' = '{generation}')")


def append_as_batch(rows: DataFrame, table: str) -> None:
    """Appends to a table of :func:`load_new_files`, as a batch that no run overwrites."""
    _write_batch(rows, table, -time.time_ns())


def note_all(spark: SparkSession, src: Paths, table: str, seen: str, files: str = LANDING_FILES) -> None:
    """Notes every file there is now as loaded, after they were appended by other means."""
    generation = _generation(spark, table)
    if generation is not None:
        folder = f"{seen.rstrip('/')}/{generation}"
        known = loaded_files(spark, folder)
        batch = (known.agg(F.max("batch")).first()[0] or 0) + 1
        pending_files(landing_files(spark, src, files).select("path"), known).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def is_batched(spark: SparkSession, table: str) -> bool:
    return _generation(spark, table) is not None


def escaped(path: str) -> str:
    """A path whose own characters aren't read as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
