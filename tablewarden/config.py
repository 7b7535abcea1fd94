"""Run configuration. Every date rule is relative to one explicit ``as_of``; nothing reads a clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone as _utc
from zoneinfo import ZoneInfo

# Table kinds of the catalogue.
TABLE_KINDS = ("MANAGED", "EXTERNAL")
VIEW_KINDS = ("VIEW", "MATERIALIZED_VIEW")

# Reserved name prefixes of the catalogue.
RESERVED_PREFIXES = ("__materialization", "event_log")

# History operations that write data.
WRITE_OPERATIONS = (
    "WRITE",
    "MERGE",
    "DELETE",
    "UPDATE",
    "STREAMING UPDATE",
    "COPY INTO",
    "CREATE TABLE AS SELECT",
    "REPLACE TABLE AS SELECT",
    "CREATE OR REPLACE TABLE AS SELECT",
)

# Column-name fragments that mark a date-like column.
DATE_FRAGMENTS = (
    "summary_date",
    "history_date",
    "calendar_date",
    "created_date",
    "conversation_start",
    "_date",
    "_time",
    "_tmst",
    "created",
    "_day",
)

# Column-name fragments that mark an identifier-like column.
ID_FRAGMENTS = (
    "customer_number",
    "client_iid",
    "client_id",
    "cust_",
    "plan_number",
    "rs_plan_number",
    "_id",
    "_key",
    "_number",
    "_iid",
    "account",
)


@dataclass(frozen=True)
class WatchConfig:
    """Thresholds and scope of one run. ``as_of`` is the wall clock in ``timezone``."""

    as_of: datetime
    catalog: str = "source_catalog"
    raw_schema: str = "raw_schema"
    transform_schema: str = "transform_schema"
    schemas: tuple[str, ...] = ("raw_schema", "transform_schema")
    excluded_jobs: tuple[str, ...] = ("exclude_jobs_list",)
    timezone: str = "America/New_York"
    zone_label: str = "ET"
    stale_asset_days: int = 60
    stale_data_days: int = 7
    lineage_days: int = 30
    retention_days: int = 90
    runs_per_job: int = 25
    history_depth: int = 30
    unclustered_min_mb: float = 100.0
    long_running_min: float = 10.0
    failing_rate: float = 20.0
    price_per_hour: float = 0.07
    days_per_month: int = 30
    savings_share: float = 0.3

    @property
    def run_date(self) -> date:
        return self.as_of.date()

    def days_before(self, days: int) -> date:
        return self.run_date - timedelta(days=days)

    @property
    def as_of_ms(self) -> int:
        return self._epoch_ms(self.as_of)

    def midnight_ms(self, day: date) -> int:
        """Epoch milliseconds of local midnight of ``day``."""
        return self._epoch_ms(datetime(day.year, day.month, day.day))

    def _epoch_ms(self, wall_clock: datetime) -> int:
        aware = wall_clock.replace(tzinfo=ZoneInfo(self.timezone))
        delta = aware.astimezone(_utc.utc) - datetime(1970, 1, 1, tzinfo=_utc.utc)
        return delta // timedelta(milliseconds=1)
