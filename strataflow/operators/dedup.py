"""De-duplication on a subset of the columns with a repeatable survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__key_hash"
_RANK = "__rank"


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _zero_signs(cols: Sequence[str]) -> list[Column]:
    """Bit masks that tell -0.0 from 0.0, which compare as equal: one bit per column."""
    masks = []
    for start in range(0, len(cols), 62):
        mask = F.lit(0).cast("bigint")
        for bit, c in enumerate(cols[start : start + 62]):
            negative = (F.col(c) == 0) & F.col(c).cast("string").startswith("-")
            mask = mask + F.when(negative, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        masks.append(mask)
    return masks


def _fixed_width(kind: T.DataType) -> bool:
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(kind, plain)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first") -> DataFrame:
    """Keep one row per distinct ``keys`` (null, NaN and both zeros each equal themselves).

    ``keep="first"`` keeps the least row by ``order``; ties go to the least of the
    remaining columns, so the survivor is a function of the data alone.
    ``keep="any"`` leaves the choice to Spark.

    The rank filter reduces every key to one row per task before the shuffle, so a key
    that holds a third of all rows sends one row per map task. The leading key hash
    lets both sorts compare one long instead of the whole key.
    """
    keys = list(keys)
    rest = [f for f in df.schema.fields if f.name not in keys]
    if keep == "any":
        if all(_fixed_width(f.dataType) for f in rest):
            return df.dropDuplicates(keys)  # a hash aggregation; with text it would sort by all keys
        rank_by = [F.lit(1)]
    elif keep == "first":
        floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
        ties = [f.name for f in rest if f.name not in order and _orderable(f.dataType)]
        rank_by = [*[F.col(c).asc_nulls_first() for c in [*order, *ties]], *_zero_signs(floats)] or [F.lit(1)]
    else:
        raise ValueError(f"keep must be 'first' or 'any', not {keep!r}")
    window = Window.partitionBy(_BUCKET, *keys).orderBy(*rank_by)
    return (
        df.withColumn(_BUCKET, F.xxhash64(*keys))
        .withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_BUCKET, _RANK)
    )
