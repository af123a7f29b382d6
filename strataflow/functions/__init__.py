from strataflow.functions.columns import (
    category_rank,
    clock_micros,
    nan_to_null,
    require_not_null,
    sort_by_category,
    source_name,
    to_double,
    trim_columns,
    with_category_rank,
    with_file_lineage,
    with_load_time,
)

__all__ = [
    "category_rank",
    "clock_micros",
    "nan_to_null",
    "require_not_null",
    "sort_by_category",
    "source_name",
    "to_double",
    "trim_columns",
    "with_category_rank",
    "with_file_lineage",
    "with_load_time",
]
