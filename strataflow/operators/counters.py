"""Deltas of cumulative counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import scratch_path

_RANGE = "__range"
_CARRY = "__carry"
_BEFORE = "__before"

Start = float | None | Mapping[str, float | Column | None]


def _in_ranges(df: DataFrame, keys: Sequence[str], ranges: int | None) -> DataFrame:
    """The rows by ranges of ``keys``, written, with the number of their range.

    Spark draws the borders from a sample of the keys, so a group of any size is cut along its
    own order, whatever the types. The ranges are written once, because the rows and the
    last rows of all ranges must come from the same cut even if an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "counter-ranges")
    cut = df.repartitionByRange(*([ranges] if ranges else []), *keys)
    cut.withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def counter_delta(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    start: Start = 0,
    suffix: str = "_delta",
    ranges: int | None = None,
) -> DataFrame:
    """Add ``<col>_delta``: each counter minus its previous reading within ``by``.

    The first reading of a group is taken against ``start``: one value for all (null
    gives a null delta), or per counter a value or column of that reading's row.
    ``order`` must identify a reading within its group; its columns may have any type that
    can be sorted.

    No group is sorted in one task: the rows are cut into ``ranges`` (default: the session's
    shuffle partitions) by ``by`` and ``order`` together, every range receives the last reading
    of each group from before it as an extra row, and the differences run per range. The same is
    done whatever the size. The call reads the input for the borders and writes it once.
    """
    cols, by, order = list(cols), list(by), list(order)
    rows = _in_ranges(df, [*by, *order], ranges)
    # a group's last row in a range; a null order sorts first, as in the window below
    last = F.max_by(F.struct(*cols), F.struct(*[F.struct(F.col(o).isNotNull(), F.col(o)) for o in order]))
    tails = rows.groupBy(_RANGE, *by).agg(last.alias(_BEFORE))
    previous = F.lag(_BEFORE).over(Window.partitionBy(*by).orderBy(_RANGE))  # a row for each range of a group
    carried = (
        tails.withColumn(_BEFORE, previous)
        .where(F.col(_BEFORE).isNotNull())
        .select(*by, _RANGE, *[F.col(_BEFORE)[c].alias(c) for c in cols], F.lit(True).alias(_CARRY))
    )
    both = rows.withColumn(_CARRY, F.lit(False)).unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(_RANGE, *by).orderBy(F.col(_CARRY).desc(), *order)
    # a struct tells a null reading before from no reading before
    first = F.col(_BEFORE).isNull()
    starts = {c: start[c] if isinstance(start, Mapping) else start for c in cols}
    out = both.withColumn(_BEFORE, F.lag(F.struct(*cols)).over(window)).withColumns(
        {c + suffix: F.col(c) - F.when(first, F.lit(starts[c])).otherwise(F.col(_BEFORE)[c]) for c in cols}
    )
    return out.where(~F.col(_CARRY)).select(*df.columns, *[c + suffix for c in cols])
