"""Explicit schemas of the landed JSON documents. Relations handed in as DataFrames carry their own."""

from pyspark.sql import types as T

_string = T.StringType()
_long = T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


JOBS_PAGE = _struct(
    jobs=T.ArrayType(
        _struct(
            job_id=_long,
            settings=_struct(name=_string, schedule=_struct(quartz_cron_expression=_string)),
        )
    ),
    has_more=T.BooleanType(),
)

RUNS_PAGE = _struct(
    runs=T.ArrayType(
        _struct(
            run_id=_long,
            start_time=_long,
            end_time=_long,
            state=_struct(result_state=_string, state_message=_string),
            run_page_url=_string,
        )
    )
)

LINEAGE_PAGE = _struct(
    downstreams=T.ArrayType(_struct(name=_string)),
    upstreams=T.ArrayType(_struct(name=_string)),
    entity_lineage=T.ArrayType(_struct(entity_type=_string, path=_string, name=_string)),
)

RUN_SUMMARY = _struct(
    run_date=_string,
    tables_analyzed=_long,
    views_analyzed=_long,
    jobs_analyzed=_long,
    small_file_tables=_long,
    missing_cluster=_long,
    long_running_jobs=_long,
    failing_jobs=_long,
    period_failures=_long,
    stale_tables=_long,
    stale_views=_long,
    stale_jobs=_long,
    est_monthly_cost=T.DoubleType(),
    est_savings=T.DoubleType(),
)

# Stored tables, in DDL form; the partition column is declared by the store.
COLUMN_SNAPSHOT_DDL = (
    "table_schema STRING, table_name STRING, column_name STRING, full_data_type STRING, "
    "ordinal_position INT, is_nullable STRING, col_comment STRING, snapshot_date DATE"
)
TABLE_SNAPSHOT_DDL = (
    "table_schema STRING, table_name STRING, table_type STRING, data_source_format STRING, "
    "created TIMESTAMP_NTZ, last_altered TIMESTAMP_NTZ, snapshot_date DATE"
)
TRACKER_DDL = "analysis_json STRING, created_at TIMESTAMP, run_date DATE"
RUNS_DDL = (
    "run_id BIGINT, job_id BIGINT, start_time BIGINT, end_time BIGINT, result_state STRING, state_message STRING, "
    "run_page_url STRING, run_day DATE"
)
LAST_WRITES_DDL = "table_schema STRING, table_name STRING, version BIGINT, timestamp {instant}, last_op STRING, rows_written STRING, bucket INT"
DIGEST_DDL = "bucket INT, n_rows BIGINT, digest BIGINT, digest_2 BIGINT, night DATE"
