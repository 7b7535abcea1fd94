"""Column expressions of the storage checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablewarden.config import DATE_FRAGMENTS, ID_FRAGMENTS

BYTES_PER_MB = 1024.0 * 1024.0
TARGET_FILE_MB = 128.0
MAX_GAIN_PCT = 80


def fqn(catalog: str | None, schema: Column, table: Column) -> Column:
    parts = [schema, table] if catalog is None else [F.lit(catalog), schema, table]
    return F.concat_ws(".", *parts)


def size_mb(size_bytes: Column) -> Column:
    return F.bround(F.coalesce(size_bytes, F.lit(0)) / F.lit(BYTES_PER_MB), 2)


def avg_file_mb(size_bytes: Column, files: Column) -> Column:
    # The mean is taken over unrounded megabytes.
    mean = F.coalesce(size_bytes, F.lit(0)) / F.lit(BYTES_PER_MB) / files
    return F.when(files > 0, F.bround(mean, 3)).otherwise(F.lit(0.0))


def is_small_file_table(files: Column, avg_mb: Column) -> Column:
    return ((files > 50) & (avg_mb < 32)) | (files > 200)


def small_file_severity(files: Column, avg_mb: Column) -> Column:
    return (
        F.when((files > 1000) | (avg_mb < 1), "CRITICAL")
        .when(files > 200, "HIGH")
        .otherwise("MEDIUM")
    )


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 3).when(severity == "HIGH", 2).otherwise(1)


def scan_gain(avg_mb: Column) -> Column:
    """Expected scan improvement in whole percent, if files grew to the target size."""
    missing = F.lit(1.0) - F.least(avg_mb, F.lit(TARGET_FILE_MB)) / F.lit(TARGET_FILE_MB)
    return F.least(F.bround(missing * 100, 0), F.lit(float(MAX_GAIN_PCT))).cast("bigint")


def has_no_clustering(clustering: Column, *, textual: bool = False) -> Column:
    """True for a missing or empty key list; ``textual`` accepts the list rendered as a string."""
    if textual:
        return F.coalesce(F.trim(clustering), F.lit("")).isin("", "[]", "None")
    return F.coalesce(F.size(clustering), F.lit(0)) <= 0


def _contains_any(name: Column, fragments: tuple[str, ...]) -> Column:
    # Fragments are letters and underscores only, so they need no regex escaping.
    return name.rlike("|".join(fragments))


def is_date_like(lower_name: Column) -> Column:
    return _contains_any(lower_name, DATE_FRAGMENTS)


def is_id_like(lower_name: Column) -> Column:
    return _contains_any(lower_name, ID_FRAGMENTS) & ~is_date_like(lower_name)


def optimize_cmd(name: Column) -> Column:
    return F.concat(F.lit("OPTIMIZE "), name, F.lit(";"))


def cluster_cmd(name: Column, keys: Column) -> Column:
    return F.when(
        F.size(keys) > 0,
        F.concat(F.lit("ALTER TABLE "), name, F.lit(" CLUSTER BY ("), F.array_join(keys, ", "), F.lit(");")),
    ).otherwise("")
