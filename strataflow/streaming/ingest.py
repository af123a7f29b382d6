"""Load every landing file exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from strataflow.functions.columns import AsOf, decoded, parent_folder, source_name, with_load_time
from strataflow.sources.eventlog import OUTPUT_TAG
from strataflow.sources.landing import (
    LANDING_FILES,
    Paths,
    file_headers,
    header_summary,
    read_by_header,
    read_landing,
    rejected_files,
    text_schema,
)
from strataflow.sources.loaded import FILES_PER_BATCH, LOAD_BATCH, escaped, load_new_files

#: A file may be this much older than the newest one seen and is still loaded.
MAX_FILE_AGE = "36500d"
INGEST_STAGE = "ingest"
_BY_HEADER = "by_header"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_REJECTED = f"file_path string, header string, reason string, {LOAD_BATCH} bigint"


def landing_stream(
    spark: SparkSession,
    src: Paths,
    columns: Sequence[str],
    files: str = LANDING_FILES,
    files_per_batch: int = FILES_PER_BATCH,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """The files below ``src`` as a stream of text rows; offers ``_metadata``.

    Spark leaves out files that are older than the newest by more than ``max_file_age``, and forgets
    such ones; the default keeps every file, at the price of a list of all of them on the driver.
    """
    return (
        spark.readStream.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
        .option("maxFileAge", max_file_age)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(_watched(src))
    )


def file_stream(
    spark: SparkSession,
    src: Paths,
    files: str = LANDING_FILES,
    files_per_batch: int = FILES_PER_BATCH,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """The paths of the files below ``src`` as a stream; no file is opened. Age is as in :func:`landing_stream`."""
    stream = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
    stream = stream.option("pathGlobFilter", files).option("maxFileAge", max_file_age)
    return stream.option("maxFilesPerTrigger", files_per_batch).load(_watched(src)).select("path")


def _watched(src: Paths) -> str:
    if isinstance(src, str):
        return src
    if len(src) != 1:
        raise ValueError("a file stream watches one folder (or one glob), not several")
    return src[0]


def ingest_once(
    spark: SparkSession,
    src: Paths,
    dst: str,
    checkpoint: str,
    columns: Sequence[str],
    lineage: str = "source_id",
    folder: str = "folder",
    suffix: str = ".csv",
    files: str = LANDING_FILES,
    files_per_batch: int = FILES_PER_BATCH,
    max_file_age: str = MAX_FILE_AGE,
    run: str | None = None,
    headers: str = "same",
    on_rejects: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Load the files below ``src`` that ``checkpoint`` has not seen yet into ``dst``.

    The file stream notes every file in the checkpoint before a batch runs, and each batch is committed
    once, so neither a re-run nor a restart after a lost executor or driver loads a file twice or skips one.
    Runs until no new file is left. Data are stored by source folder; returns all rows loaded so far. ``run`` names
    the query ``<run>/ingest``, under which the event log gives it as the ingest stage of a run; one query of a name runs at a time.

    ``headers="same"``: a file whose header isn't ``columns`` in this order fails the run, until it is mended.
    ``"by_file"``: each file's own header places its columns. A file with other columns is left out for good and noted
    beside the rows, see :func:`ingest_rejects`; ``on_rejects`` gets those that this call met, if there are any.
    Mended, it needs a new name. The two ways keep rows and checkpoints apart: changing from one to the other loads all files anew.

    ``src``, ``dst`` and ``checkpoint`` must be on storage shared by all executors.
    """
    if headers == "by_file":
        stream = file_stream(spark, src, files, files_per_batch, max_file_age)
        place = _Placed(spark, f"{dst.rstrip('/')}/{_BY_HEADER}", columns, lineage, folder, suffix, files)
        _run(stream.writeStream.foreachBatch(place.add), f"{checkpoint.rstrip('/')}/{_BY_HEADER}", run)
        if on_rejects and place.rejected:
            on_rejects(ingest_rejects(spark, dst).where(F.col(LOAD_BATCH).isin(place.rejected)))
        return place.rows()
    if headers != "same":
        raise ValueError(f"headers must be 'same' or 'by_file', not {headers!r}")
    name = decoded(F.col("_metadata.file_name"))
    parent = parent_folder(decoded(F.col("_metadata.file_path")))
    rows = landing_stream(spark, src, columns, files, files_per_batch, max_file_age).select(
        *columns, source_name(name, suffix).alias(lineage), parent.alias(folder)
    )
    _run(rows.writeStream.format("parquet").partitionBy(folder).option("path", dst), checkpoint, run)
    return spark.read.schema(_ingested(columns, lineage, folder)).parquet(dst)


def ingest_rejects(spark: SparkSession, dst: str) -> DataFrame:
    """The files that ``ingest_once(..., headers="by_file")`` left out of ``dst``: ``file_path, header, reason, load_batch``."""
    path = f"{dst.rstrip('/')}/{_BY_HEADER}/rejected"
    _make_empty(spark, _REJECTED, path, LOAD_BATCH)
    return spark.read.schema(_REJECTED).parquet(path)


def _run(writer: DataStreamWriter, checkpoint: str, run: str | None) -> None:
    writer = writer.queryName(f"{run}/{INGEST_STAGE}") if run else writer
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _ingested(columns: Sequence[str], lineage: str, folder: str) -> T.StructType:
    return T.StructType([*text_schema([*columns, lineage]).fields, T.StructField(folder, T.StringType())])


def _make_empty(spark: SparkSession, schema: T.StructType | str, path: str, *partitions: str) -> None:
    """The folder, if it isn't there, with no rows; one that is there stays as it is."""
    spark.createDataFrame([], schema).write.partitionBy(*partitions).mode("ignore").parquet(path)


class _Placed:
    """The sink of a stream of files: a folder of rows and one of rejects, in each a partition for each batch.

    A batch that is run again, after a driver was lost before its commit, replaces its own partitions.
    """

    def __init__(
        self, spark: SparkSession, base: str, columns: Sequence[str], lineage: str, folder: str, suffix: str, files: str
    ):
        self.spark, self.base, self.columns, self.files = spark, base, list(columns), files
        self.lineage, self.folder, self.suffix = lineage, folder, suffix
        self.rejected: list[int] = []

    def add(self, batch: DataFrame, number: int) -> None:
        paths = [escaped(r["path"]) for r in batch.collect()]  # files_per_batch at most
        if not paths:
            return
        found = file_headers(self.spark, paths, self.files)
        summary = header_summary(self.spark, found, self.columns)
        bad = rejected_files(self.spark, paths, self.columns, found, self.files)
        bad.write.mode("overwrite").parquet(f"{self.base}/rejected/{LOAD_BATCH}={number}")
        if summary.n_rejected:
            self.rejected.append(number)
        rows = read_by_header(
            self.spark, paths, self.columns, found, self.lineage, self.suffix, files=self.files, summary=summary, folder=self.folder
        )
        with _output(self.spark):
            rows.write.mode("overwrite").partitionBy(self.folder).parquet(f"{self.base}/rows/{LOAD_BATCH}={number}")

    def rows(self) -> DataFrame:
        stored = _ingested(self.columns, self.lineage, self.folder).add(LOAD_BATCH, T.LongType())
        _make_empty(self.spark, stored, f"{self.base}/rows", LOAD_BATCH, self.folder)
        return self.spark.read.schema(stored).parquet(f"{self.base}/rows").drop(LOAD_BATCH)


@contextmanager
def _output(spark: SparkSession) -> Iterator[None]:
    """Tags the writes within as the output of their stage, for the event log."""
    spark.sparkContext.addJobTag(OUTPUT_TAG)
    try:
        yield
    finally:
        spark.sparkContext.removeJobTag(OUTPUT_TAG)


def load_table_once(
    spark: SparkSession,
    src: Paths,
    table: str,
    checkpoint: str,
    columns: Sequence[str],
    lineage: str = "source_id",
    loaded_col: str = "created_at",
    as_of: AsOf = None,
    suffix: str = ".csv",
    every_suffix: bool = False,
    headers: str = "same",
    files: str = LANDING_FILES,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """New files into a managed table with the load time of each batch; see :func:`load_new_files`."""

    def read(paths: list[str]) -> DataFrame:
        rows = read_landing(spark, paths, columns, headers, lineage, suffix, every_suffix, files)
        return with_load_time(rows, loaded_col, as_of)

    load_new_files(spark, src, table, checkpoint, read, files, files_per_batch)
    return spark.table(table)
