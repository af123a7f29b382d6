"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.session import scratch_path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for each application, as ``--py-files`` would.

    So the functions that run in tasks are importable there, wherever the driver was started.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp(prefix="strataflow-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))  # Spark serves it from the driver
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and lost
    executors cost nothing that came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hidden(name: str) -> str:
    """A column name that no input table has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without its own columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


#: What functions in tasks remember of earlier batches; a Python worker outlives its tasks, so only the latest step's is held.
memories: dict[str, Any] = {}
_step: list[str] = []


def begin_step(name: str) -> None:
    """Forgets what other steps remembered in this worker."""
    if _step != [name]:
        _step[:] = [name]
        memories.clear()


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[tuple[str, T.DataType]],
    compute: Callable[..., Sequence[Sequence]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with ``fields`` that ``compute`` makes of the lists in ``inputs``, batch by batch.

    All other columns, or those in ``keep``, pass through as Arrow data, unread. A column of ``df`` that has the
    name of a new field is replaced by it.
    """
    ship_package(df.sparkSession)
    inputs, step = list(inputs), uuid.uuid4().hex
    fresh = {n.lower() for n, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in fresh]
    taken = [*kept, *(c for c in inputs if c not in kept)]
    source = df.select([F.col(f"`{c}`") for c in taken])
    schema = T.StructType([*(f for f in source.schema.fields if f.name in kept), *(T.StructField(n, t) for n, t in fields)])
    types = [to_arrow_type(t) for _, t in fields]
    at, n_kept = [taken.index(c) for c in inputs], len(kept)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_step(step)
        for batch in batches:
            if batch.num_rows:
                made = compute(*(batch.column(i).to_pylist() for i in at))
                arrays = [pa.array(m, t) for m, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *arrays], names=names)

    return source.mapInArrow(run, schema)


def crc_mod(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int
) -> DataFrame:
    """(doc_id, text, y) of at most ``max_rows`` labelled documents, the same on every run.

    ``usable`` says which labels may be learned from. The sample is the documents with the least
    hashes of the id, so it is bounded whatever the input, and the broadcast of its ids too.
    Several labels of one document count as their majority; of several rows of one document the one with the
    least text hash counts.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
        .groupBy("doc_id")
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(max_rows)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "y")
