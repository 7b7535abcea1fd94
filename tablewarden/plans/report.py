"""Section tables of the two reports: ordered, cut to their listing limits, and ranked where cut."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.operators.freshness import freshness_order
from tablewarden.operators.storage import small_file_order, unclustered_order
from tablewarden.operators.topk import latest_per_key, ranked_top_n, top_n
from tablewarden.plans.metadata import MetadataAnalysis
from tablewarden.plans.optimization import OptimizationAnalysis

# Listing limits of the report sections.
SMALL_FILE_ROWS, SMALL_FILE_COMMANDS = 15, 10
UNCLUSTERED_ROWS, UNCLUSTERED_COMMANDS = 15, 8
FAILURE_ROWS, FAILURE_MESSAGE_CHARS = 20, 300
STALE_ASSET_ROWS = 15
STALE_DATA_ROWS = 50
RAW_COLUMN_ROWS = 50
TRANSFORM_NAME_ROWS = 50
GOVERNANCE_ROWS, GOVERNANCE_PREVIEW_CHARS = 30, 120
ASSETS_PER_KIND = 15

_TABLE = ["table_schema", "table_name"]
_COLUMN = [*_TABLE, "column_name"]


def _by(*names: str) -> list[Column]:
    return [F.col(name) for name in names]


def _failures(result: OptimizationAnalysis) -> DataFrame:
    newest = [F.col("start_time").desc(), F.col("run_id").desc()]
    message = F.substring("error", 1, FAILURE_MESSAGE_CHARS).alias("error")
    return ranked_top_n(result.period_failures, newest, FAILURE_ROWS).select(
        "rank", "job_name", "date", "duration", "run_id", "url", message
    )


def _unclustered(result: OptimizationAnalysis) -> DataFrame:
    return ranked_top_n(result.unclustered, unclustered_order(), UNCLUSTERED_ROWS).select(
        "rank", *_TABLE, "size_mb", "files", F.array_join("rec_cols", ", ").alias("rec_cols"), "partition_columns"
    )


def _cluster_commands(result: OptimizationAnalysis) -> DataFrame:
    # The limit counts tables, also those without a recommendation, which have no command to show.
    largest = ranked_top_n(result.unclustered, unclustered_order(), UNCLUSTERED_COMMANDS)
    return largest.filter(F.col("alter_cmd") != "").select(
        "rank", "fqn", F.concat_ws("\n", "alter_cmd", "opt_cmd").alias("cmd")
    )


def _oldest(assets: DataFrame) -> DataFrame:
    return ranked_top_n(assets, _by("last_altered", *_TABLE), STALE_ASSET_ROWS)


OPTIMIZATION_SECTIONS: dict[str, Callable[[OptimizationAnalysis], DataFrame]] = {
    "dashboard": lambda r: r.dashboard,
    "small_files": lambda r: ranked_top_n(r.small_files, small_file_order(), SMALL_FILE_ROWS).select(
        "rank", *_TABLE, "size_mb", "files", "avg_file_mb", "severity", "gain_pct"
    ),
    "optimize_commands": lambda r: ranked_top_n(r.small_files, small_file_order(), SMALL_FILE_COMMANDS).select(
        "rank", "fqn", "cmd"
    ),
    "unclustered": _unclustered,
    "cluster_commands": _cluster_commands,
    "cost": lambda r: r.cost,
    "long_running": lambda r: r.long_running.select(
        "job_id", "job_name", "avg_min", "max_min", "schedule_label", "fail_rate"
    ),
    "failing": lambda r: r.failing.select(
        "job_id", "job_name", "fail_rate", "failed_of_total", "avg_min", "schedule_label", "last_run"
    ),
    "period_failures": _failures,
    "stale_tables": lambda r: _oldest(r.stale_tables).select("rank", *_TABLE, "size_mb", "last_altered"),
    "stale_views": lambda r: _oldest(r.stale_views).select("rank", *_TABLE, "last_altered"),
    "stale_jobs": lambda r: ranked_top_n(r.stale_jobs, _by("last_ts", "job_id"), STALE_ASSET_ROWS).select(
        "rank", "job_id", "job_name", "schedule_label", "last_run"
    ),
    "totals": lambda r: r.totals,
}


def _governance(result: MetadataAnalysis) -> DataFrame:
    preview = F.substring("definition_preview", 1, GOVERNANCE_PREVIEW_CHARS).alias("definition_preview")
    return ranked_top_n(result.governance, _by("table_name"), GOVERNANCE_ROWS).select("rank", "table_name", preview)


def _stale_data(result: MetadataAnalysis) -> DataFrame:
    return ranked_top_n(result.stale_data, freshness_order(), STALE_DATA_ROWS).select(
        "rank", *_TABLE, "fmt", "last_write", "last_op", "rows_written", "days_since", "severity"
    )


def _changes(kind: str, keys: list[str], *values: str) -> Callable[[MetadataAnalysis], DataFrame]:
    return lambda r: top_n(r.of_kind(kind), _by(*keys)).select(*keys, *values)


METADATA_SECTIONS: dict[str, Callable[[MetadataAnalysis], DataFrame]] = {
    "dashboard": lambda r: r.dashboard,
    "new_tables": _changes("NEW TABLE", _TABLE, "table_type", "data_source_format"),
    "removed_tables": _changes("REMOVED", _TABLE, "table_type", "data_source_format"),
    "added_columns": _changes("COL ADDED", _COLUMN, "new_type", "new_nullable"),
    "removed_columns": _changes("COL REMOVED", _COLUMN, "old_type", "old_nullable"),
    "changed_columns": _changes("TYPE CHANGE", _COLUMN, "old_type", "new_type", "old_nullable", "new_nullable"),
    "impact": lambda r: top_n(r.impact, _by("fqn")).select(
        "fqn", "change_summary", "n_downstream", "n_notebooks", "n_jobs", "n_rejected", "risk"
    ),
    "change_items": lambda r: top_n(r.changes, _by("fqn", "change_type", "col")),
    "lineage_items": lambda r: top_n(
        latest_per_key(r.lineage, ["fqn", "asset_kind"], _by("asset"), ASSETS_PER_KIND), _by("fqn", "asset_kind", "asset")
    ),
    "affected_distinct": lambda r: r.affected_distinct,
    "stale_data": _stale_data,
    "raw_tables": lambda r: top_n(r.raw_tables, _by("table_name")).select("table_name", "issue"),
    "raw_columns": lambda r: ranked_top_n(r.raw_columns, _by("table_name", "column_name"), RAW_COLUMN_ROWS).select(
        "rank", "table_name", "column_name", "issue"
    ),
    "transform_names": lambda r: ranked_top_n(r.transform_names, _by("table_name"), TRANSFORM_NAME_ROWS).select(
        "rank", "table_name", "table_type", "issue"
    ),
    "governance": _governance,
    "totals": lambda r: r.totals,
}


def optimization_sections(
    result: OptimizationAnalysis, names: Iterable[str] = OPTIMIZATION_SECTIONS
) -> dict[str, DataFrame]:
    return {name: OPTIMIZATION_SECTIONS[name](result) for name in names}


def metadata_sections(result: MetadataAnalysis, names: Iterable[str] = METADATA_SECTIONS) -> dict[str, DataFrame]:
    return {name: METADATA_SECTIONS[name](result) for name in names}


def report_sections(
    sections: Mapping[str, DataFrame], items: Mapping[str, Column], notes: Mapping[str, Column]
) -> DataFrame:
    """The ranked sections named in ``items`` stacked into (section, rank, item, note)."""
    stacked = [
        sections[name].select(
            F.lit(name).alias("section"),
            "rank",
            item.cast("string").alias("item"),
            notes[name].cast("string").alias("note"),
        )
        for name, item in items.items()
    ]
    return reduce(DataFrame.unionByName, stacked)
