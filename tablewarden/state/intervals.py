"""Snapshots kept as validity intervals: a row is stored once for as long as it stays the same.

A night writes the buckets of tables that changed. Digests of all buckets tell which those are, so that a night without
changes reads and writes digests only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.operators import drift
from tablewarden.schemas import DIGEST_DDL
from tablewarden.sources.catalog import COLUMN_KEY, TABLE_KEY
from tablewarden.state.store import WatchStore, cut_lineage

BUCKETS = 64
# Rows that are still valid close on this day.
OPEN = date(9999, 12, 31)

COLUMN_VALUES = {"full_data_type": "STRING", "ordinal_position": "INT", "is_nullable": "STRING", "col_comment": "STRING"}
TABLE_VALUES = {"table_type": "STRING", "data_source_format": "STRING", "created": "TIMESTAMP_NTZ", "last_altered": "TIMESTAMP_NTZ"}


class Intervals:
    """One relation over time: ``key`` columns, which begin with the table's, ``values``, valid_from, closed_on and bucket.

    A row is valid from the night it was first seen until, exclusively, the night it was gone or different. Nights are merged
    in order; the last one may be merged again, with the same or other rows.
    """

    def __init__(self, store: WatchStore, name: str, key: Sequence[str], values: dict[str, str]):
        self.store, self.key, self.values = store, list(key), values
        self.history, self.digest = f"{name}_intervals", f"{name}_digests"

    @classmethod
    def of_columns(cls, store: WatchStore) -> Intervals:
        return cls(store, "metadata_column", COLUMN_KEY, COLUMN_VALUES)

    @classmethod
    def of_tables(cls, store: WatchStore) -> Intervals:
        return cls(store, "metadata_table", TABLE_KEY, TABLE_VALUES)

    def ensure(self) -> None:
        columns = ", ".join([*(f"{k} STRING" for k in self.key), *(f"{n} {t}" for n, t in self.values.items())])
        self.store.ensure(self.history, f"{columns}, valid_from DATE, closed_on DATE, bucket INT", "closed_on, bucket")
        self.store.ensure(self.digest, DIGEST_DDL, "night")

    # --- reading ---

    def nights(self) -> list[date]:
        """Merged nights, from the catalogue: one entry per night."""
        return sorted(date.fromisoformat(p["night"]) for p in self.store.partitions(self.digest))

    def at(self, day: date) -> DataFrame:
        """The rows valid on ``day``; what was closed by then is not read."""
        valid = (F.col("closed_on") > F.lit(day)) & (F.col("valid_from") <= F.lit(day))
        return self.store.fresh(self.history).filter(valid).select(*self.key, *self.values)

    def valid_before(self, day: date, buckets: Sequence[int]) -> DataFrame:
        """The open rows as they were before the night of ``day``, whether or not that night was merged, or partly."""
        stored = self.store.fresh(self.history).filter(F.col("closed_on").isin(OPEN, day) & F.col("bucket").isin(*buckets) & (F.col("valid_from") < F.lit(day)))
        # A night that failed between two writes may have left a row both open and closed.
        kept = F.max_by(F.struct(*self.values, "valid_from"), "valid_from").alias("row")
        return stored.groupBy(*self.key, "bucket").agg(kept).select(*self.key, "bucket", "row.*")

    # --- digests ---

    def bucketed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*TABLE_KEY), F.lit(BUCKETS)).cast("int")
        cast = [F.col(n).cast(t).alias(n) for n, t in self.values.items()]
        return rows.select(*self.key, *cast, bucket.alias("bucket"))

    def digests(self, bucketed: DataFrame) -> DataFrame:
        """Rows and 128 bits of digest per bucket, whatever the order of the rows; one partial aggregate."""
        whole = [*self.key, *self.values]
        return bucketed.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.bit_xor(F.xxhash64(*whole)).alias("digest"),
            F.bit_xor(F.xxhash64(F.lit("second"), *whole)).alias("digest_2"),
        )

    def differing(self, digests: DataFrame, day: date) -> list[int]:
        """Buckets that differ from the last night before ``day``: at most ``BUCKETS`` numbers. A merged night is compared anew in all."""
        nights = self.nights()
        if day < max(nights, default=day):
            raise ValueError(f"{day} lies before the last merged night")
        if day in nights:
            return list(range(BUCKETS))
        last = max(nights, default=None)
        before = self.store.fresh(self.digest).filter(F.col("night") == F.lit(last)).drop("night")
        same = digests.join(before, digests.columns, "left_semi").select("bucket")
        either = digests.select("bucket").unionByName(before.select("bucket")).distinct()
        return sorted(r.bucket for r in either.join(same, "bucket", "left_anti").collect())

    # --- writing ---

    def merge(self, rows: DataFrame, day: date) -> list[int]:
        """Take over the snapshot of one night, a row per key; the buckets that were written."""
        staged = cut_lineage(self.bucketed(rows))
        digests = cut_lineage(self.digests(staged))
        touched = self.differing(digests, day)
        if touched:
            merged = cut_lineage(self._merged(self.valid_before(day, touched), staged.filter(F.col("bucket").isin(*touched)), day))
            held = {(r.closed_on, r.bucket) for r in merged.select("closed_on", "bucket").distinct().collect()}
            self.store.overwrite(merged.hint("rebalance", "closed_on", "bucket"), self.history)
            # A night that is merged again may no longer close or hold anything in a bucket.
            known = [(date.fromisoformat(p["closed_on"]), int(p["bucket"])) for p in self.store.partitions(self.history)]
            self._drop([p for p in known if p[0] in (OPEN, day) and p[1] in set(touched) and p not in held])
        self.store.save_snapshot(digests.withColumn("night", F.lit(day)), self.digest, day, "night")
        return touched

    def _merged(self, before: DataFrame, staged: DataFrame, day: date) -> DataFrame:
        old = before.select(*self.key, "bucket", F.struct(*self.values).alias("_old"), "valid_from")
        new = staged.select(*self.key, "bucket", F.struct(*self.values).alias("_new"))
        same = F.col("_old").eqNullSafe(F.col("_new"))

        def row(values: str, valid_from: Column, closed_on: Column) -> Column:
            return F.struct(F.col(values).alias("values"), valid_from.alias("valid_from"), closed_on.alias("closed_on"))

        ends = F.when(same, F.lit(OPEN)).otherwise(F.lit(day))
        kept = F.when(F.col("_old").isNotNull(), row("_old", F.col("valid_from"), ends))
        begun = F.when(F.col("_new").isNotNull() & ~same, row("_new", F.lit(day), F.lit(OPEN)))
        rows = old.join(new, [*self.key, "bucket"], "full_outer").select(*self.key, "bucket", F.explode(F.array_compact(F.array(kept, begun))).alias("_row"))
        return rows.select(*self.key, *[F.col(f"_row.values.{n}").alias(n) for n in self.values], F.col("_row.valid_from"), F.col("_row.closed_on"), "bucket")

    def apply_retention(self, as_of: date, days: int = 90) -> None:
        """Drop what was closed by ``as_of - days`` and the digests before it; a metadata operation."""
        cutoff = as_of - timedelta(days=days)
        self._drop([(closed, int(p["bucket"])) for p in self.store.partitions(self.history) for closed in [date.fromisoformat(p["closed_on"])] if closed <= cutoff])
        self.store.drop_partitions(self.digest, [f"night = DATE '{n}'" for n in self.nights() if n < cutoff])

    def _drop(self, parts: list[tuple[date, int]]) -> None:
        self.store.drop_partitions(self.history, [f"closed_on = DATE '{d}', bucket = {b}" for d, b in parts])


def digest_diff(tables: Intervals, columns: Intervals, curr_tables: DataFrame, curr_columns: DataFrame, day: date) -> DataFrame:
    """``drift.schema_diff`` of tonight's catalogue with the last merged night, over the buckets whose digests differ.

    Both relations are bucketed by table, so a table's rows are in one bucket and what equal buckets hold cannot differ.
    """
    staged_t, staged_c = cut_lineage(tables.bucketed(curr_tables)), cut_lineage(columns.bucketed(curr_columns))
    touched = sorted({*tables.differing(tables.digests(staged_t), day), *columns.differing(columns.digests(staged_c), day)})
    here = F.col("bucket").isin(*touched) if touched else F.lit(False)
    return drift.schema_diff(staged_t.filter(here), tables.valid_before(day, touched or [-1]), staged_c.filter(here), columns.valid_before(day, touched or [-1]))
