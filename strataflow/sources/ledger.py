"""Run ledgers as headered CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.stages import LEDGER_COLUMNS
from strataflow.operators.union import union_labelled
from strataflow.sources.landing import write_landing

LEDGER_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "run" else T.DoubleType()) for c in LEDGER_COLUMNS]
)


def write_ledger(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write a ledger as a folder of headered CSV files; null cells are blank, cells with line breaks are refused.

    ``partition_by`` writes one folder per value, such as the configuration.
    """
    write_landing(df, path, partition_by, mode)


def read_ledger(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: T.StructType | Mapping[str, T.StructType] | None = LEDGER_SCHEMA,
    label: str = "config",
    skip_missing: bool = True,
) -> DataFrame:
    """Unite result files, each labelled with its configuration; blank cells are null.

    ``schema`` may differ per label, or be null to infer each file's types; columns a
    file lacks become null. A path that does not exist is skipped unless
    ``skip_missing`` is off.
    """
    frames: dict[str, DataFrame] = {}
    for name, path in paths.items():
        reader = spark.read.option("header", True).option("enforceSchema", False)
        if schema is None:
            reader = reader.option("inferSchema", True)
        else:
            reader = reader.schema(schema if isinstance(schema, T.StructType) else schema[name])
        try:
            frames[name] = reader.csv(path)
        except AnalysisException as error:
            if not (skip_missing and error.getCondition() == "PATH_NOT_FOUND"):
                raise
    if not frames:
        if isinstance(schema, T.StructType):
            return spark.createDataFrame([], schema).withColumn(label, F.lit(None).cast("string"))
        raise ValueError("none of the result files exists")
    return union_labelled(frames, label, allow_missing=True)
