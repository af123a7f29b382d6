"""Landing files: headered CSV folders read as text columns, their manifest and headers."""

from __future__ import annotations

import csv
import functools
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.columns import decoded, parent_folder, source_name, with_file_lineage
from strataflow.session import scratch_path

Paths = str | Sequence[str]

# Folders that are roots of a landing tree, not sources.
ROOT_FOLDERS = ("landing", "data")
TABLE_SUFFIX = "_bz"
MAX_BROADCAST_BYTES = 64 << 20
LANDING_FILES = "*.csv*"  # plain and compressed; the same files for every way of loading
_ONE_FILE_A_TASK = str(1 << 40)
#: Files up to this size cost about as much to open as to read; more than a hundred of them share a task of the header pass.
SMALL_FILE_BYTES = 1 << 20
_PACK_BYTES = str(128 * SMALL_FILE_BYTES)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, files: str = LANDING_FILES) -> DataFrameReader:
    """Reads the files of that name pattern directly in a folder; hidden ones are never read."""
    return spark.read.option("pathGlobFilter", files)


def landing_files(spark: SparkSession, paths: Paths, files: str = LANDING_FILES) -> DataFrame:
    """``path, length, modificationTime`` of the files that :func:`read_landing` reads; none is opened."""
    return _reader(spark, files).format("binaryFile").load(_paths(paths)).select("path", "length", "modificationTime")


def landing_columns(spark: SparkSession, paths: Paths, files: str = LANDING_FILES) -> list[str]:
    """Column names from the header of one file; reads a single line."""
    return _reader(spark, files).option("header", True).csv(_paths(paths)).columns


def read_landing(
    spark: SparkSession,
    paths: Paths,
    columns: Sequence[str],
    headers: str = "same",
    lineage: str | None = None,
    suffix: str = ".csv",
    every: bool = False,
    files: str = LANDING_FILES,
    multi_line: bool = False,
) -> DataFrame:
    """Read headered CSV files as text: an empty cell is null, spaces are kept.

    ``headers="same"``: every file must have exactly ``columns`` in this order; Spark
    checks each header while reading, and a different one fails the job instead of
    silently swapping columns. ``headers="by_file"``: each file's own header decides
    where its columns are, at the price of reading the first line of each file before;
    files without exactly this set of columns are left out, and
    :func:`rejected_files` lists them.

    ``lineage`` names a column for the file name without its suffix. ``files`` says which names are
    read. ``multi_line`` allows line breaks within quoted cells; a file is then one task's work.
    """
    if headers == "by_file":
        found = file_headers(spark, paths, files)
        return read_by_header(spark, paths, columns, found, lineage, suffix, every, files, multi_line)
    if headers != "same":
        raise ValueError(f"headers must be 'same' or 'by_file', not {headers!r}")
    reader = _reader(spark, files).schema(text_schema(columns)).option("header", True).option("enforceSchema", False)
    rows = reader.option("multiLine", multi_line).csv(_paths(paths))
    return with_file_lineage(rows, lineage, suffix, every) if lineage else rows


def landing_headers(spark: SparkSession, paths: Paths, files: str = LANDING_FILES) -> DataFrame:
    """Header of each file: ``file_path`` (as in ``_metadata``), the line ``header``, and its ``names``.

    The header is the first line that isn't blank; files without any such line have no row. Nothing is sorted or
    shuffled. Of a file over ``SMALL_FILE_BYTES`` only the beginning is read, by a task that has this file alone. Smaller
    ones are read whole, a hundred or more to a task, so a million small files are some ten thousand tasks; only
    their first lines leave the scan. Which file is which is decided by the listing: each is opened once.
    """
    size = F.col("_metadata.file_size")
    small = _reader(_lister(spark, _PACK_BYTES, str(SMALL_FILE_BYTES)), files).text(_paths(paths), wholetext=True)
    first = F.regexp_extract(F.ltrim("value", F.lit("\ufeff")), r"(?:^|[\r\n])( *+[^ \r\n][^\r\n]*+)", 1)
    small = small.where(size <= SMALL_FILE_BYTES).select("_metadata.file_path", first.alias("header")).where("header != ''")
    large = _reader(_lister(spark, _ONE_FILE_A_TASK, _ONE_FILE_A_TASK), files).text(_paths(paths))
    large = large.where(size > SMALL_FILE_BYTES).select("_metadata.file_path", "value", "_metadata.file_block_start")
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    schema = "file_path string, header string, names array<string>"
    kinds = pa.schema([("file_path", pa.string()), ("header", pa.string()), ("names", pa.list_(pa.string()))])

    def named(rows: list[dict]) -> pa.RecordBatch:
        for row in rows:
            names = next(csv.reader([row["header"].rstrip("\r")]))
            row["names"] = names if sensitive else [name.lower() for name in names]
        return pa.RecordBatch.from_pylist(rows, kinds)

    def all_named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield named(batch.to_pylist())

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["file_block_start"] > 0:
                    return
                if row["value"].strip(" "):
                    yield named([{"file_path": row["file_path"], "header": row["value"]}])
                    return

    return large.mapInArrow(first_line, schema).unionByName(small.mapInArrow(all_named, schema))


def _lister(spark: SparkSession, pack_bytes: str, open_bytes: str) -> SparkSession:
    """A session whose scans put that many bytes into a task, each file counted as ``open_bytes`` more."""
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", pack_bytes)
    lister.conf.set("spark.sql.files.openCostInBytes", open_bytes)
    lister.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return lister


def file_headers(spark: SparkSession, paths: Paths, files: str = LANDING_FILES) -> DataFrame:
    """:func:`landing_headers`, found once and kept as a small table in the shared folder."""
    path = scratch_path(spark, "headers")
    landing_headers(spark, paths, files).write.parquet(path)
    return spark.read.parquet(path)


def _folded(spark: SparkSession, names: Sequence[str]) -> list[str]:
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    return list(names) if sensitive else [name.lower() for name in names]


def _fits(wanted: Sequence[str]):
    return F.sort_array("names") == F.lit(sorted(wanted))


@dataclass(frozen=True)
class HeaderSummary:
    """The commonest order of columns, as the place of each column in the file; the size of the table of files that have
    another one or other columns; and how many have other columns."""

    usual: list[int]
    odd_bytes: int
    n_rejected: int


def _placed(spark: SparkSession, headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    wanted = _folded(spark, columns)
    at = F.transform(F.lit(wanted), lambda w: F.array_position("names", w).cast("int"))
    return headers.select("file_path", F.when(_fits(wanted), at).alias("places"))


def header_summary(spark: SparkSession, headers: DataFrame, columns: Sequence[str]) -> HeaderSummary:
    """From one job over the table of headers; what reaches the driver is one row."""
    size = F.sum(F.octet_length("file_path") + 4 * len(columns) + 32).alias("bytes")
    orders = _placed(spark, headers, columns).groupBy("places").agg(F.count(F.lit(1)).alias("n"), size)
    fits = F.col("places").isNotNull()
    # ties go to the least order
    best = F.max(F.when(fits, F.struct("n", F.transform("places", lambda p: -p).alias("falling"), "bytes"))).alias("best")
    found = orders.agg(best, F.sum("bytes").alias("bytes"), F.sum(F.when(~fits, F.col("n"))).alias("rejected")).first()
    if not found["best"]:
        return HeaderSummary(list(range(1, len(columns) + 1)), found["bytes"] or 0, found["rejected"] or 0)
    return HeaderSummary([-p for p in found["best"]["falling"]], found["bytes"] - found["best"]["bytes"], found["rejected"] or 0)


def read_by_header(
    spark: SparkSession,
    paths: Paths,
    columns: Sequence[str],
    headers: DataFrame,
    lineage: str | None = None,
    suffix: str = ".csv",
    every: bool = False,
    files: str = LANDING_FILES,
    multi_line: bool = False,
    summary: HeaderSummary | None = None,
    folder: str | None = None,
) -> DataFrame:
    """One scan of all files whose columns are placed by each file's own header. ``folder`` names a column for the
    name of the folder that a file is in.

    The scan reads by position. The commonest order of columns needs no join; files that have another
    one, or other columns, are a table of exceptions. It is broadcast if its measured size
    allows; otherwise adaptive execution joins by shuffle and splits the rows of a large file.
    """
    summary = summary or header_summary(spark, headers, columns)
    usual, size = summary.usual, summary.odd_bytes
    placed = _placed(spark, headers, columns)
    odd = placed.where(F.col("places").isNull() | (F.col("places") != F.lit(usual)))

    cells = [f"_c{i}" for i in range(len(columns))]
    # positional names differ from the header's, so Spark's own header check is off here
    scan = _reader(spark, files).schema(text_schema(cells)).option("header", True).option("enforceSchema", True)
    scan = scan.option("multiLine", multi_line)
    rows = scan.csv(_paths(paths)).select(*cells, "_metadata.file_path", "_metadata.file_name")
    out = [F.col(cells[place - 1]).alias(c) for c, place in zip(columns, usual, strict=True)]
    if size:
        odd = odd.withColumn("odd", F.lit(True))
        rows = rows.join(F.broadcast(odd) if size <= MAX_BROADCAST_BYTES else odd, "file_path", "left")
        rows = rows.where(F.col("odd").isNull() | F.col("places").isNotNull())
        places = F.coalesce("places", F.lit(usual))
        out = [F.get(F.array(*cells), F.get(places, i) - 1).alias(c) for i, c in enumerate(columns)]
    if lineage:
        out.append(source_name(decoded(F.col("file_name")), suffix, every).alias(lineage))
    if folder:
        out.append(parent_folder(decoded(F.col("file_path"))).alias(folder))
    return rows.select(*out)


def rejected_files(
    spark: SparkSession,
    paths: Paths,
    columns: Sequence[str],
    headers: DataFrame | None = None,
    files: str = LANDING_FILES,
) -> DataFrame:
    """Files whose header is not exactly this set of columns: ``file_path, header, reason``."""
    headers = file_headers(spark, paths, files) if headers is None else headers
    wanted = F.lit(_folded(spark, columns))
    missing, extra = F.array_except(wanted, "names"), F.array_except("names", wanted)
    parts = [
        F.when(F.size(names) > 0, F.concat(F.lit(f"{kind} "), F.array_join(names, ", ")))
        for kind, names in (("missing", missing), ("unexpected", extra))
    ]
    reason = F.coalesce(F.nullif(F.concat_ws("; ", *parts), F.lit("")), F.lit("repeated column"))
    bad = headers.where(~_fits(_folded(spark, columns)))
    return bad.select(decoded(F.col("file_path")).alias("file_path"), "header", reason.alias("reason"))


def landing_manifest(
    spark: SparkSession, root: Paths, glob: str = LANDING_FILES, suffix: str = ".csv", skip: Sequence[str] = ROOT_FOLDERS
) -> DataFrame:
    """One row per file below ``root``: path, folder, table name, source name, size, time.

    Lists files without opening them: the content column is pruned from the scan.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(_paths(root))
    )
    folder, name = parent_folder(F.col("path")), F.substring_index("path", "/", -1)
    manifest = files.select(
        "path",
        folder.alias("folder"),
        F.concat(folder, F.lit(TABLE_SUFFIX)).alias("table_name"),
        name.alias("file_name"),
        source_name(name, suffix).alias("source_id"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )
    return manifest.where(~F.col("folder").isin(*skip)) if skip else manifest


def landing_sources(manifest: DataFrame) -> dict[str, list[str]]:
    """Table name -> folders, for every folder of a manifest that has files.

    One entry per folder with files, so the result is as small as the list of sources.
    """
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder_path")
    found: dict[str, list[str]] = {}
    for row in manifest.select("table_name", folder).distinct().orderBy("table_name", "folder_path").collect():
        found.setdefault(row["table_name"], []).append(row["folder_path"])
    return found


def pending_files(manifest: DataFrame, loaded: DataFrame, on: Sequence[str] = ("path",)) -> DataFrame:
    """Manifest rows that are not among the loaded ones."""
    same = functools.reduce(operator.and_, [manifest[c].eqNullSafe(loaded[c]) for c in on])
    return manifest.join(loaded, same, "left_anti")


def write_landing(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    multi_line: bool = False,
) -> None:
    """Write headered CSV that :func:`read_landing` reads back cell for cell.

    Values are written as text, outer spaces are kept, quotes follow the reader's own escape
    rule, and a null cell is written as a quoted empty one, so that a row of one null is still a row.
    Null and empty text are one on read. A cell with a line break fails the job, as the rows could
    not be told apart, unless ``multi_line`` says that they will be read with it too.
    """
    cells = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns if c not in partition_by}
    if not multi_line:
        broken = F.raise_error(F.lit("a cell has a line break; write and read with multi_line"))
        cells = {c: F.when(v.rlike("[\n\r]"), broken.cast("string")).otherwise(v) for c, v in cells.items()}
    writer = (
        df.select(*[cells[c].alias(c) if c in cells else F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        .write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
