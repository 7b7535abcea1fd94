"""Severity, risk, naming and detail labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NO_VALUE = "—"

# Change kinds, in alphabetical order (the order of a joined summary).
CHANGE_KINDS = ("COL ADDED", "COL REMOVED", "GOVERNANCE", "NAMING", "NEW TABLE", "REMOVED", "TYPE CHANGE")
BREAKING_KINDS = ("COL REMOVED", "TYPE CHANGE")

GOVERNANCE_DETAIL = "View does not reference publish_ or raw_schema"


def freshness_severity(days: Column) -> Column:
    return F.when(days > 90, "CRITICAL").when(days > 30, "HIGH").when(days > 14, "MEDIUM").otherwise("LOW")


def risk_level(breaking: Column, n_downstream: Column) -> Column:
    return (
        F.when(breaking & (n_downstream >= 3), "CRITICAL")
        .when(breaking & (n_downstream >= 1), "HIGH")
        .when(n_downstream >= 1, "MEDIUM")
        .otherwise("LOW")
    )


def rows_written(metrics: Column) -> Column:
    """First non-empty row count of a write's metrics map; null when there is none."""
    keys = ("numOutputRows", "numTargetRowsInserted")
    return F.coalesce(*[F.nullif(F.try_element_at(metrics, F.lit(key)), F.lit("")) for key in keys])


def last_segment(path: Column) -> Column:
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)


def notebook_label(notebook_id: Column, path: Column) -> Column:
    named = F.when(F.length(path) > 0, last_segment(path))
    return F.coalesce(named, F.concat(F.lit("Notebook #"), notebook_id))


def has_uppercase(name: Column) -> Column:
    return name != F.lower(name)


def raw_name_issue(name: Column) -> Column:
    """Null when the name obeys the raw-zone rule."""
    return F.when(has_uppercase(name), "uppercase letters").when(name.contains(" "), "contains spaces")


def transform_name_issue(name: Column) -> Column:
    """Null when the name obeys the transform-zone rule."""
    return F.when(has_uppercase(name), "uppercase letters").when(~name.endswith("_view"), "missing _view suffix")


def breaks_governance(definition: Column, raw_schema: str) -> Column:
    # ``contains`` is a literal test, so the underscores need no escaping; null stays null (not flagged).
    return ~definition.contains("publish_") & ~definition.contains(raw_schema)


def _shown(value: Column) -> Column:
    return F.coalesce(value, F.lit(NO_VALUE))


def change_detail(diff: dict[str, Column]) -> Column:
    """Text of a schema change; ``diff`` maps the column names of a schema diff to columns."""
    kind = diff["change_type"]
    table_text = F.concat_ws(" | ", _shown(diff["table_type"]), _shown(diff["data_source_format"]))
    added_text = F.concat(_shown(diff["new_type"]), F.lit(" | nullable="), _shown(diff["new_nullable"]))
    changed_text = F.concat(
        _shown(diff["old_type"]), F.lit(" → "), _shown(diff["new_type"]),
        F.lit(" | nullable: "), _shown(diff["old_nullable"]), F.lit(" → "), _shown(diff["new_nullable"]),
    )
    return (
        F.when(kind == "COL ADDED", added_text)
        .when(kind == "COL REMOVED", _shown(diff["old_type"]))
        .when(kind == "TYPE CHANGE", changed_text)
        .otherwise(table_text)
    )
