"""Column operators: lineage, load time, trimming, tolerant casts, null rules, category ranks."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = Column | datetime | str | None

# Suffixes of compressed files that Spark reads.
CODECS = "gz|gzip|bz2|zst|lz4|snappy|deflate"


def decoded(path: Column) -> Column:
    """Undo the URI escapes in a ``_metadata`` path or file name (``+`` is literal there)."""
    escaped = path.contains("%")
    return F.when(escaped, F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def parent_folder(path: Column) -> Column:
    """Name of the folder a file is in."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def source_name(file_name: Column, suffix: str = ".csv", every: bool = False) -> Column:
    """File name without its suffix, and that of its compression; ``every`` removes each occurrence, not only the last."""
    file_name = F.regexp_replace(file_name, rf"({re.escape(suffix)})\.({CODECS})$", "$1")
    if every:
        return F.replace(file_name, F.lit(suffix), F.lit(""))
    stem = F.substring(file_name, F.lit(1), F.length(file_name) - len(suffix))
    return F.when(file_name.endswith(suffix), stem).otherwise(file_name)


def with_file_lineage(df: DataFrame, col: str = "source_id", suffix: str = ".csv", every: bool = False) -> DataFrame:
    """Add the source name of each row's file. ``df`` must come straight from a file scan."""
    return df.withColumn(col, source_name(decoded(F.col("_metadata.file_name")), suffix, every))


def with_load_time(df: DataFrame, col: str, as_of: AsOf = None) -> DataFrame:
    """Add one time value for the whole query: the current time unless ``as_of`` is given."""
    if as_of is None:
        stamp = F.current_timestamp()
    elif isinstance(as_of, Column):
        stamp = as_of
    else:
        stamp = F.lit(as_of).cast("timestamp")
    return df.withColumn(col, stamp)


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strip spaces (only spaces: tabs and no-break spaces stay) from both ends."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def to_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; text that is no number becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows in which every column is non-null. NaN and blank text are values and stay."""
    if not cols:
        return df
    return df.where(functools.reduce(operator.and_, [F.col(c).isNotNull() for c in cols]))


def clock_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970 of a time column.

    A timestamp without time zone is read off its own clock, so the result grows with it
    whatever the session's zone; that of a date is its midnight.
    """
    time, kind = F.col(col), df.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(time)
    days = F.unix_date(time.cast("date")).cast("bigint") * 86400
    if isinstance(kind, T.DateType):
        return days * 1_000_000
    if not isinstance(kind, T.TimestampNTZType):
        raise TypeError(f"{col} must be a timestamp or date, not {kind.simpleString()}")
    seconds = days + F.hour(time) * 3600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("bigint")


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def category_rank(col: Column, order: Sequence[str]) -> Column:
    """1-based place of a value in ``order``; null for a value that is not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), col), F.lit(0).cast("bigint"))


def with_category_rank(df: DataFrame, col: str, order: Sequence[str], rank: str = "cat_rank") -> DataFrame:
    return df.withColumn(rank, category_rank(F.col(col), order))


def sort_by_category(df: DataFrame, col: str, order: Sequence[str], rank: str = "cat_rank") -> DataFrame:
    """Rows in category order, values outside ``order`` last.

    The order within a category is by row hash, so that the range sort can cut a large
    category into several tasks.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ranked = with_category_rank(df, col, order, rank)
    return ranked.orderBy(F.col(rank).asc_nulls_last(), F.col(col), F.xxhash64(*hashed))
