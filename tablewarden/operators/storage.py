"""Small files, missing clustering and stale assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewarden.config import WatchConfig
from tablewarden.functions.storage import (
    cluster_cmd,
    fqn,
    has_no_clustering,
    is_date_like,
    is_id_like,
    is_small_file_table,
    optimize_cmd,
    scan_gain,
    severity_rank,
    small_file_severity,
)
from tablewarden.functions.times import local_wall_clock
from tablewarden.operators.joins import spread_join
from tablewarden.operators.topk import latest_per_key
from tablewarden.sources.catalog import TABLE_KEY

MAX_KEYS = 3


def table_detail(inventory: DataFrame, storage: DataFrame) -> DataFrame:
    """Inventory with its storage; a table without detail stays, marked by ``has_detail``."""
    marked = storage.withColumn("has_detail", F.lit(True))
    return inventory.join(marked, TABLE_KEY, "left").withColumn("has_detail", F.coalesce("has_detail", F.lit(False)))


def _fqn(cfg: WatchConfig) -> Column:
    return fqn(cfg.catalog, F.col("table_schema"), F.col("table_name"))


def small_file_rule() -> Column:
    return is_small_file_table(F.col("files"), F.col("avg_file_mb"))


def unclustered_rule(detail: DataFrame, cfg: WatchConfig) -> Column:
    textual = isinstance(detail.schema["clustering_columns"].dataType, T.StringType)
    return has_no_clustering(F.col("clustering_columns"), textual=textual) & (F.col("size_mb") > cfg.unclustered_min_mb)


def stale_rule(relation: DataFrame, cfg: WatchConfig) -> Column:
    """Altered on a local date before the cut-off date; an unknown date is never stale."""
    altered_on = F.to_date(local_wall_clock(relation, "last_altered", cfg))
    return altered_on < F.lit(cfg.days_before(cfg.stale_asset_days))


def small_files(detail: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Tables made of too many or too small files."""
    files, avg_mb, name = F.col("files"), F.col("avg_file_mb"), _fqn(cfg)
    return detail.filter(small_file_rule()).select(
        *TABLE_KEY, "size_mb", "files", "avg_file_mb",
        name.alias("fqn"),
        small_file_severity(files, avg_mb).alias("severity"),
        scan_gain(avg_mb).alias("gain_pct"),
        optimize_cmd(name).alias("cmd"),
    )


def small_file_order() -> list[Column]:
    """Worst first: by severity, then by number of files."""
    return [severity_rank(F.col("severity")).desc(), F.col("files").desc(), F.col("fqn")]


def unclustered(detail: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Large tables without clustering keys."""
    return detail.filter(unclustered_rule(detail, cfg)).select(
        *TABLE_KEY, "size_mb", "files", "partition_columns", _fqn(cfg).alias("fqn")
    )


def clustering_keys(columns: DataFrame) -> DataFrame:
    """Recommended keys of every table that has any: first date-like, then id-like columns, at most three.

    Only the first three candidates of each class reach the grouping, so a very wide table costs no more
    than a narrow one there.
    """
    name = F.lower("column_name")
    candidates = columns.select(
        *TABLE_KEY, "ordinal_position", name.alias("key"), is_date_like(name).alias("is_date")
    ).filter(F.col("is_date") | is_id_like(F.col("key")))
    leading = latest_per_key(
        candidates, [*TABLE_KEY, "is_date"], [F.col("ordinal_position").asc(), F.col("key").asc()], MAX_KEYS
    )
    ranked = F.array_sort(F.collect_list(F.struct("ordinal_position", "key", "is_date")))
    per_table = leading.groupBy(*TABLE_KEY).agg(ranked.alias("ranked"))

    def names(is_date: bool) -> Column:
        of_class = F.filter("ranked", lambda c: c["is_date"] if is_date else ~c["is_date"])
        return F.transform(of_class, lambda c: c["key"])

    keys = F.slice(F.concat(F.slice(names(True), 1, 1), names(False)), 1, MAX_KEYS)
    return per_table.select(*TABLE_KEY, keys.alias("rec_cols"))


def recommend_clustering(detail: DataFrame, columns: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Unclustered large tables with their recommended keys and commands."""
    large = unclustered(detail, cfg)
    keys = F.coalesce("rec_cols", F.array().cast("array<string>"))
    # Only the columns of these tables are ranked.
    own = spread_join(columns, large.select(*TABLE_KEY), TABLE_KEY, ["column_name"], "left_semi")
    return (
        large.join(clustering_keys(own), TABLE_KEY, "left")
        .withColumn("rec_cols", keys)
        .withColumn("alter_cmd", cluster_cmd(F.col("fqn"), F.col("rec_cols")))
        .withColumn("opt_cmd", optimize_cmd(F.col("fqn")))
    )


def unclustered_order() -> list[Column]:
    """Largest first."""
    return [F.col("size_mb").desc(), F.col("fqn")]


def stale_tables(detail: DataFrame, cfg: WatchConfig) -> DataFrame:
    return detail.filter(stale_rule(detail, cfg))


def stale_views(views: DataFrame, cfg: WatchConfig) -> DataFrame:
    return views.filter(stale_rule(views, cfg))
