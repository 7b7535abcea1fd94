"""Platform observability on Spark: storage, job, drift, naming, freshness and lineage checks."""

from tablewarden.config import WatchConfig

__all__ = ["WatchConfig"]
