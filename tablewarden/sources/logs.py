"""Write history, access-lineage log, audit log and workspace listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tablewarden.config import WatchConfig
from tablewarden.operators.joins import keep_keys
from tablewarden.operators.topk import latest_per_key
from tablewarden.sources.catalog import TABLE_KEY

LINEAGE_ENTITIES = ("NOTEBOOK", "JOB")


def recent_history(history: DataFrame, depth: int = 30) -> DataFrame:
    """Newest ``depth`` log entries of every table, whatever their operation."""
    return latest_per_key(history, TABLE_KEY, [F.col("version").desc()], depth)


def access_lineage(edges: DataFrame, changed: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Who read the changed tables in the last days: one row per (table, entity) with its read count.

    ``changed`` holds each table once, stored. Reads of other tables are dropped before anything is exchanged, and the rest is
    counted down per map task, so neither a table nor an entity that fills the log is shuffled row by row.
    """
    recent = edges.filter(
        (F.col("event_date") >= F.lit(cfg.days_before(cfg.lineage_days)))
        & F.col("entity_type").isin(*LINEAGE_ENTITIES)
    ).select(F.col("source_table_full_name").alias("fqn"), "entity_type", "entity_id")
    kept = keep_keys(recent, changed.select("fqn"), "fqn")
    return kept.groupBy("fqn", "entity_type", "entity_id").agg(F.count(F.lit(1)).alias("n_reads"))


def audit_notebook_opens(audit: DataFrame) -> DataFrame:
    """Notebook-open events with the notebook id and path taken from the request parameters."""
    params = F.col("request_params")
    if isinstance(audit.schema["request_params"].dataType, T.StringType):
        params = F.from_json(params, T.MapType(T.StringType(), T.StringType()))
    return audit.filter(F.col("action_name") == "getNotebook").select(
        "event_time",
        F.try_element_at(params, F.lit("notebookId")).alias("notebook_id"),
        F.try_element_at(params, F.lit("path")).alias("notebook_path"),
    )


def workspace_paths(listing: DataFrame) -> DataFrame:
    """Object id to path for every listed object; of an object listed twice, the first path by name."""
    return listing.groupBy("object_id").agg(F.min("path").alias("path"))
