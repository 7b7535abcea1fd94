"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewarden.config import WatchConfig

_EPOCH = "1970-01-01 00:00:00"


def _epoch_ntz() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def local_from_ms(epoch_ms: Column, zone: str) -> Column:
    """Epoch milliseconds as zone-free local wall clock."""
    utc = _epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), epoch_ms / F.lit(1000).cast("decimal(4,0)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def minute_label(local: Column, cfg: WatchConfig) -> Column:
    """``yyyy-MM-dd HH:mm ET`` of a zone-free local timestamp."""
    return F.concat(F.substring(local.cast("string"), 1, 16), F.lit(f" {cfg.zone_label}"))


def et_label(epoch_ms: Column, cfg: WatchConfig) -> Column:
    return minute_label(local_from_ms(epoch_ms, cfg.timezone), cfg)


def is_instant(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampType)


def local_wall_clock(df: DataFrame, name: str, cfg: WatchConfig) -> Column:
    """Zone-free columns already hold local time; instants are converted."""
    if is_instant(df, name):
        utc = _epoch_ntz() + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.unix_micros(F.col(name)) / F.lit(1000000).cast("decimal(7,0)")
        )
        return F.convert_timezone(F.lit("UTC"), F.lit(cfg.timezone), utc)
    return F.col(name)


def as_of_literal(cfg: WatchConfig) -> Column:
    return F.lit(cfg.as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def age_days(df: DataFrame, name: str, cfg: WatchConfig) -> Column:
    """Whole days, floored, from the timestamp column to ``as_of``."""
    if is_instant(df, name):
        micros = F.lit(cfg.as_of_ms * 1000) - F.unix_micros(F.col(name))
    else:
        micros = F.timestamp_diff("MICROSECOND", F.col(name), as_of_literal(cfg))
    # Exact on integers: a floating quotient could round up to the next whole day.
    return ((micros - F.pmod(micros, F.lit(86_400_000_000))) / F.lit(86_400_000_000)).cast("bigint")


def run_ms(start: Column, end: Column) -> Column:
    """Duration of a run; an open run (no end, or end 0) counts as one millisecond."""
    begun = F.coalesce(start, F.lit(0))
    ended = F.coalesce(F.when(end != 0, end), begun + 1)
    return ended - begun


def run_minutes(start: Column, end: Column) -> Column:
    return run_ms(start, end) / F.lit(60000.0)
