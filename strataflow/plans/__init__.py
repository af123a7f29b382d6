from strataflow.plans.clean import CleanSpec, clean
from strataflow.plans.layers import LayerError, LayerReport, build_bronze, build_gold, build_silver, layer_counts
from strataflow.plans.pipeline import PipelineConfig, run_pipeline, telemetry_config
from strataflow.plans.presets import TELEMETRY_COLUMNS, TELEMETRY_SOURCES, TELEMETRY_SPEC

__all__ = [
    "TELEMETRY_COLUMNS",
    "TELEMETRY_SOURCES",
    "TELEMETRY_SPEC",
    "CleanSpec",
    "LayerError",
    "LayerReport",
    "PipelineConfig",
    "build_bronze",
    "build_gold",
    "build_silver",
    "clean",
    "layer_counts",
    "run_pipeline",
    "telemetry_config",
]
