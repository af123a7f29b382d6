from strataflow.sources.eventlog import (
    digest_event_log,
    event_log_ledger,
    event_log_metrics,
    execution_targets,
    executor_capacity,
    read_event_log,
    run_wall_clock,
    stage_memory,
    stage_totals,
)
from strataflow.sources.landing import (
    landing_columns,
    landing_headers,
    landing_manifest,
    landing_sources,
    pending_files,
    read_by_header,
    read_landing,
    rejected_files,
    write_landing,
)
from strataflow.sources.ledger import LEDGER_SCHEMA, read_ledger, write_ledger
from strataflow.sources.tables import (
    LAYERS,
    ensure_layers,
    list_tables,
    read_layer,
    reset_layers,
    table_name,
    write_layer,
)

__all__ = [
    "LAYERS",
    "LEDGER_SCHEMA",
    "digest_event_log",
    "ensure_layers",
    "event_log_ledger",
    "event_log_metrics",
    "landing_columns",
    "landing_headers",
    "landing_manifest",
    "landing_sources",
    "list_tables",
    "pending_files",
    "read_by_header",
    "execution_targets",
    "executor_capacity",
    "read_event_log",
    "run_wall_clock",
    "stage_memory",
    "read_landing",
    "read_layer",
    "read_ledger",
    "rejected_files",
    "reset_layers",
    "stage_totals",
    "table_name",
    "write_landing",
    "write_layer",
    "write_ledger",
]
