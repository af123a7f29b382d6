"""Registry of the catalogue: each query with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path
from strataflow.sources.tables import ensure_layers

QueryFn = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-01 00:00:00"


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def scratch_layers(spark: SparkSession, name: str) -> str:
    """Fresh, empty layer databases in the shared folder; returns their name prefix."""
    prefix = f"{name}_{uuid.uuid4().hex[:12]}_"
    ensure_layers(spark, prefix, scratch_path(spark, name))
    return prefix
