"""Differences between two dated snapshots and the change log built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.functions.labels import BREAKING_KINDS, CHANGE_KINDS, GOVERNANCE_DETAIL, change_detail
from tablewarden.functions.storage import fqn
from tablewarden.operators.joins import spread_join
from tablewarden.sources.catalog import COLUMN_KEY, TABLE_KEY

_TABLE_VALUES = ["table_type", "data_source_format"]
_COLUMN_VALUES = ["full_data_type", "is_nullable"]
DIFF_COLUMNS = [
    "change_type", *COLUMN_KEY, *_TABLE_VALUES, "old_type", "new_type", "old_nullable", "new_nullable",
]


def new_tables(curr: DataFrame, prev: DataFrame) -> DataFrame:
    return curr.join(prev, TABLE_KEY, "left_anti").select(*TABLE_KEY, *_TABLE_VALUES)


def removed_tables(curr: DataFrame, prev: DataFrame) -> DataFrame:
    return new_tables(prev, curr)


def common_tables(curr: DataFrame, prev: DataFrame) -> DataFrame:
    return curr.select(*TABLE_KEY).join(prev, TABLE_KEY, "left_semi")


def _within(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Column rows of the common tables; one table may own a large share of them.

    Joined on the key as one struct, which is never null, so nothing is filtered below ``common``: an aggregate that is read
    elsewhere too is made once.
    """
    named = rows.filter(F.col("table_schema").isNotNull() & F.col("table_name").isNotNull()).withColumn("_table", F.struct(*TABLE_KEY))
    return spread_join(named, common.select(F.struct(*TABLE_KEY).alias("_table")), ["_table"], ["column_name"], "left_semi").drop("_table")


def added_columns(curr: DataFrame, prev: DataFrame, common: DataFrame) -> DataFrame:
    """Columns only in ``curr``, of tables in both snapshots."""
    fresh = curr.join(prev, COLUMN_KEY, "left_anti").select(*COLUMN_KEY, *_COLUMN_VALUES)
    return _within(fresh, common)


def removed_columns(curr: DataFrame, prev: DataFrame, common: DataFrame) -> DataFrame:
    return added_columns(prev, curr, common)


def _changed(old: str, new: str) -> Column:
    # A null on either side is not a change.
    return F.coalesce(F.col(old) != F.col(new), F.lit(False))


def changed_columns(curr: DataFrame, prev: DataFrame, common: DataFrame) -> DataFrame:
    """Columns of both snapshots whose type or nullability differs."""
    new = curr.select(*COLUMN_KEY, F.col("full_data_type").alias("new_type"), F.col("is_nullable").alias("new_nullable"))
    old = prev.select(*COLUMN_KEY, F.col("full_data_type").alias("old_type"), F.col("is_nullable").alias("old_nullable"))
    differing = old.join(new, COLUMN_KEY).filter(
        _changed("old_type", "new_type") | _changed("old_nullable", "new_nullable")
    )
    return _within(differing, common).select(
        *COLUMN_KEY, "old_type", "new_type", "old_nullable", "new_nullable"
    )


def _presence(curr: DataFrame, prev: DataFrame) -> DataFrame:
    """Every table of either snapshot with its values in each, null where it is absent; one exchange for both."""
    sides = [
        snapshot.select(*TABLE_KEY, F.lit(label).alias("side"), F.struct(*_TABLE_VALUES).alias("values"))
        for snapshot, label in ((curr, "curr"), (prev, "prev"))
    ]
    held = [F.max(F.when(F.col("side") == label, F.col("values"))).alias(label) for label in ("curr", "prev")]
    return sides[0].unionByName(sides[1]).groupBy(*TABLE_KEY).agg(*held)


def _table_changes(presence: DataFrame) -> DataFrame:
    # The structs tell presence, never a null value inside.
    created = F.col("prev").isNull()
    return presence.filter(created | F.col("curr").isNull()).select(
        F.when(created, "NEW TABLE").otherwise("REMOVED").alias("change_type"),
        *TABLE_KEY,
        F.lit(None).cast("string").alias("column_name"),
        *[F.coalesce("curr", "prev")[c].alias(c) for c in _TABLE_VALUES],
        *[F.lit(None).cast("string").alias(c) for c in ("old_type", "new_type", "old_nullable", "new_nullable")],
    )


def _column_changes(curr: DataFrame, prev: DataFrame, common: DataFrame) -> DataFrame:
    def side(snapshot: DataFrame, age: str) -> DataFrame:
        return snapshot.select(
            *COLUMN_KEY,
            F.col("full_data_type").alias(f"{age}_type"),
            F.col("is_nullable").alias(f"{age}_nullable"),
            F.lit(True).alias(f"has_{age}"),
        )

    both = side(curr, "new").join(side(prev, "old"), COLUMN_KEY, "full_outer")
    differs = _changed("old_type", "new_type") | _changed("old_nullable", "new_nullable")
    kind = (
        F.when(F.col("has_old").isNull(), "COL ADDED")
        .when(F.col("has_new").isNull(), "COL REMOVED")
        .when(differs, "TYPE CHANGE")
    )
    # Unchanged columns go before the table restriction: what is joined again is the diff, not the snapshot.
    changed = both.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
    return _within(changed, common).select(
        "change_type",
        *COLUMN_KEY,
        *[F.lit(None).cast("string").alias(c) for c in _TABLE_VALUES],
        "old_type", "new_type", "old_nullable", "new_nullable",
    )


def schema_diff(curr_t: DataFrame, prev_t: DataFrame, curr_c: DataFrame, prev_c: DataFrame) -> DataFrame:
    """All five kinds of schema change in one relation.

    The inputs hold one row per (schema, table) and per (schema, table, column). Both uses of the table snapshots read
    the same columns of one aggregate, so its exchange is made once.
    """
    presence = _presence(curr_t, prev_t)
    common = presence.filter(F.col("curr").isNotNull() & F.col("prev").isNotNull()).select(*TABLE_KEY)
    columns = _column_changes(curr_c, prev_c, common)
    return _table_changes(presence).select(*DIFF_COLUMNS).unionByName(columns.select(*DIFF_COLUMNS))


def change_log(
    diff: DataFrame, raw_names: DataFrame, transform_names: DataFrame, governance: DataFrame, cfg: WatchConfig
) -> DataFrame:
    """Schema, naming and governance changes keyed by the full table name: (fqn, change_type, col, detail)."""
    name = fqn(cfg.catalog, F.col("table_schema"), F.col("table_name"))

    def entries(rows: DataFrame, kind: str, detail: Column) -> DataFrame:
        return rows.select(
            name.alias("fqn"), F.lit(kind).alias("change_type"), F.lit("").alias("col"), detail.alias("detail")
        )

    drift = diff.select(
        name.alias("fqn"),
        "change_type",
        F.coalesce("column_name", F.lit("")).alias("col"),
        change_detail({c: F.col(c) for c in DIFF_COLUMNS}).alias("detail"),
    )
    return (
        drift.unionByName(entries(raw_names, "NAMING", F.col("issue")))
        .unionByName(entries(transform_names, "NAMING", F.col("issue")))
        .unionByName(entries(governance, "GOVERNANCE", F.lit(GOVERNANCE_DETAIL)))
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """Per table: its distinct change kinds joined in alphabetical order, and whether any is breaking."""
    present = [F.max(F.when(F.col("change_type") == k, 1).otherwise(0)).alias(k) for k in CHANGE_KINDS]
    flags = changes.groupBy("fqn").agg(*present, F.count(F.lit(1)).alias("n_changes"))
    kinds = F.concat_ws(", ", *[F.when(F.col(k) == 1, F.lit(k)) for k in CHANGE_KINDS])
    breaking = F.greatest(*[F.col(k) for k in BREAKING_KINDS]) == 1
    return flags.select("fqn", kinds.alias("change_summary"), "n_changes", breaking.alias("breaking"))
