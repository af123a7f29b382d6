from strataflow.catalogue import cleaning, landing, layers, logs, runs
from strataflow.catalogue.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "cleaning", "landing", "layers", "logs", "runs"]
