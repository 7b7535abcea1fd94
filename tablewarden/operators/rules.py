"""Naming and governance rules. Listing limits belong to the report sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.functions.labels import breaks_governance, raw_name_issue, transform_name_issue
from tablewarden.sources.catalog import view_definitions


def raw_table_violations(tables: DataFrame, cfg: WatchConfig) -> DataFrame:
    return (
        tables.filter(F.col("table_schema") == cfg.raw_schema)
        .select("table_schema", "table_name", raw_name_issue(F.col("table_name")).alias("issue"))
        .filter(F.col("issue").isNotNull())
    )


def raw_column_violations(columns: DataFrame, cfg: WatchConfig) -> DataFrame:
    return (
        columns.filter(F.col("table_schema") == cfg.raw_schema)
        .select("table_schema", "table_name", "column_name", raw_name_issue(F.col("column_name")).alias("issue"))
        .filter(F.col("issue").isNotNull())
    )


def transform_name_violations(tables: DataFrame, cfg: WatchConfig) -> DataFrame:
    return (
        tables.filter(F.col("table_schema") == cfg.transform_schema)
        .select("table_schema", "table_name", "table_type", transform_name_issue(F.col("table_name")).alias("issue"))
        .filter(F.col("issue").isNotNull())
    )


def view_governance_violations(views: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Views whose whole definition mentions neither ``publish_`` nor the raw schema."""
    return (
        view_definitions(views, cfg.transform_schema)
        .filter(breaks_governance(F.col("view_definition"), cfg.raw_schema))
        .select("table_schema", "table_name", "definition_preview")
    )
