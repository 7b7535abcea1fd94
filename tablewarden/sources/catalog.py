"""Catalogue relations: table, view and column inventories, snapshots and view definitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablewarden.config import RESERVED_PREFIXES, TABLE_KINDS, VIEW_KINDS, WatchConfig
from tablewarden.functions.times import local_wall_clock
from tablewarden.operators.topk import latest_per_key

TABLE_KEY = ["table_schema", "table_name"]
COLUMN_KEY = [*TABLE_KEY, "column_name"]


def _inventory(tables: DataFrame, schemas: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    kept = tables.filter(F.col("table_schema").isin(*schemas) & F.col("table_type").isin(*kinds))
    for prefix in RESERVED_PREFIXES:
        kept = kept.filter(~F.col("table_name").startswith(prefix))
    return kept.select(*TABLE_KEY, "table_type", "created", "last_altered")


def table_inventory(tables: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """Base tables of the monitored schemas without the reserved prefixes."""
    return _inventory(tables, schemas, TABLE_KINDS)


def view_inventory(tables: DataFrame, schemas: Sequence[str]) -> DataFrame:
    """Views of the monitored schemas without the reserved prefixes."""
    return _inventory(tables, schemas, VIEW_KINDS)


def current_table_snapshot(tables: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Every relation of the monitored schemas, of any kind, one row per name, stamped with the run date.

    Times are stored as local wall clock, so they do not depend on the session zone.
    """
    values = ["table_type", "data_source_format", "created", "last_altered"]
    scoped = tables.filter(F.col("table_schema").isin(*cfg.schemas)).select(
        F.lit(cfg.run_date).alias("snapshot_date"),
        *TABLE_KEY, "table_type", "data_source_format",
        *[local_wall_clock(tables, name, cfg).alias(name) for name in values[2:]],
    )
    # A landed catalogue may repeat a table; the latest altered entry counts, ties go by the other values.
    newest = [F.col("last_altered").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in values[:3]]]
    return latest_per_key(scoped, TABLE_KEY, newest, 1)


def current_column_snapshot(columns: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Every column of the monitored schemas, one row per name, stamped with the run date."""
    scoped = columns.filter(F.col("table_schema").isin(*cfg.schemas)).select(
        F.lit(cfg.run_date).alias("snapshot_date"),
        *COLUMN_KEY, "full_data_type", "ordinal_position", "is_nullable", F.col("comment").alias("col_comment"),
    )
    # A catalogue holds a column once; a landed copy may repeat it, and a repeat would multiply in the diff.
    order = [F.col(c).asc() for c in ("ordinal_position", "full_data_type", "is_nullable", "col_comment")]
    return latest_per_key(scoped, COLUMN_KEY, order, 1)


def base_tables(tables: DataFrame) -> DataFrame:
    """Relations that store data, i.e. all kinds but views."""
    return tables.filter(~F.col("table_type").isin(*VIEW_KINDS)).select(*TABLE_KEY)


def view_definitions(views: DataFrame, schema: str) -> DataFrame:
    return views.filter(F.col("table_schema") == schema).select(
        *TABLE_KEY, "view_definition", F.substring("view_definition", 1, 200).alias("definition_preview")
    )
