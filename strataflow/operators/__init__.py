from strataflow.operators.compare import compare_configs, mean_by, stage_share
from strataflow.operators.counted import StepCounts
from strataflow.operators.counters import counter_delta
from strataflow.operators.dedup import dedup
from strataflow.operators.profile import persisted, preview, profile_counts, profile_duplicates, profile_nulls
from strataflow.operators.stages import ledger_long, ledger_wide, run_ledger, stage_columns, stage_metrics
from strataflow.operators.union import union_by_name, union_labelled

__all__ = [
    "StepCounts",
    "compare_configs",
    "counter_delta",
    "dedup",
    "ledger_long",
    "ledger_wide",
    "mean_by",
    "persisted",
    "preview",
    "profile_counts",
    "profile_duplicates",
    "profile_nulls",
    "run_ledger",
    "stage_columns",
    "stage_metrics",
    "stage_share",
    "union_by_name",
    "union_labelled",
]
