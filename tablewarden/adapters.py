"""The given test tables read as the input relations of the checks.

The tables hold no catalogue metadata, so every relation is derived from whole tables by plain column
expressions. The SQL twins are in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.config import WatchConfig

AS_OF = datetime(2024, 1, 31)
SINCE = date(2024, 1, 30)
PREVIOUS_DATE, NEXT_DATE = date(2024, 1, 30), date(2024, 2, 1)
CONFIG = WatchConfig(as_of=AS_OF, excluded_jobs=("Customer#000000007",))
DRIFT_CONFIG = WatchConfig(as_of=AS_OF, schemas=("raw_schema", "transform_schema", "r0", "r1"))

# Both snapshots together cover every order.
PREVIOUS = "o_orderdate < TIMESTAMP_NTZ'1998-07-01 00:00:00'"
CURRENT = "o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00'"
STATE_AS_OF = date(1998, 6, 1)
RETENTION_AS_OF = date(2001, 8, 1)
# Nights whose catalogues share eleven months of orders each.
NIGHTS = (date(1998, 3, 1), date(1998, 4, 1), date(1998, 5, 1))
# 2001-08-01, the last order day, falls on the run date.
SHIP_SHIFT_DAYS = 8218
# A landed lineage page spans so many suppliers, so it holds as many assets of a kind at most.
PAYLOAD_PAGE = 50

# Stated schemas: reading a table then needs no job that opens its footers.
GIVEN_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN_SCHEMAS[table]).parquet(f"{sf}/{table}.parquet")


# --- jobs and runs -------------------------------------------------------------------------------

_START = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "events").selectExpr(
        "user_id AS job_id",
        "event_id AS run_id",
        f"{_START} AS start_time",
        f"{_START} + CAST(round(value * 15000) AS BIGINT) AS end_time",
        "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELED' ELSE 'SUCCESS' END AS result_state",
        "props AS state_message",
        "concat('https://workspace/#job/', user_id, '/run/', event_id) AS run_page_url",
    )


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    at = "concat('0 ', c_custkey % 60, ' ', c_custkey % 24)"
    return _read(spark, sf, "customer").selectExpr(
        "c_custkey AS job_id",
        "c_name AS name",
        f"""CASE c_custkey % 6
              WHEN 0 THEN concat({at}, ' * * ?')
              WHEN 1 THEN concat({at}, ' ? * MON-FRI')
              WHEN 2 THEN concat({at}, ' ? * 2,4')
              WHEN 3 THEN concat({at}, ' 15 * ?')
              WHEN 4 THEN ''
              ELSE 'bad cron' END AS schedule""",
    )


def job_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs rendered as landed JSON pages of 25."""
    job = "named_struct('name', name, 'schedule', named_struct('quartz_cron_expression', schedule))"
    pages = jobs(spark, sf).selectExpr("job_id div 25 AS page", f"named_struct('job_id', job_id, 'settings', {job}) AS job")
    listed = pages.groupBy("page").agg(F.collect_list("job").alias("jobs"))
    return listed.selectExpr("to_json(named_struct('jobs', jobs)) AS payload")


def run_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages_of(runs(spark, sf)).drop("page")


def pages_of(given: DataFrame) -> DataFrame:
    """Runs rendered as landed JSON pages; a page spans 100 run ids, so it holds 100 runs at most."""
    run = """named_struct('run_id', run_id, 'start_time', start_time, 'end_time', end_time, 'state',
        named_struct('result_state', result_state, 'state_message', state_message), 'run_page_url', run_page_url)"""
    pages = given.selectExpr("job_id", "run_id div 100 AS page", f"{run} AS run")
    listed = pages.groupBy("job_id", "page").agg(F.collect_list("run").alias("runs"))
    return listed.selectExpr("job_id", "page", "to_json(named_struct('runs', runs)) AS payload")


def run_nights(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two nights of landed run pages. The first ends in a day whose runs are still open; the second brings that day again."""
    given = runs(spark, sf)
    first, last = (F.lit(int(datetime(2024, 1, d, tzinfo=timezone.utc).timestamp() * 1000)) for d in (20, 21))
    is_open = F.col("start_time") >= first
    opened = given.filter(F.col("start_time") < last).select(
        "job_id", "run_id", "start_time", F.when(is_open, F.lit(0)).otherwise(F.col("end_time")).alias("end_time"),
        F.when(~is_open, F.col("result_state")).alias("result_state"), "state_message", "run_page_url",
    )
    return [pages_of(night).drop("page") for night in (opened, given.filter(is_open))]


def damaged_run_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Run pages of which some are cut, empty, missing, of another shape or without their job."""
    return pages_of(runs(spark, sf)).selectExpr(
        "CASE WHEN page % 11 <> 5 THEN job_id END AS job_id",
        """CASE page % 11 WHEN 1 THEN substring(payload, 1, length(payload) div 2) WHEN 2 THEN '' WHEN 3 THEN NULL
             WHEN 4 THEN '{"runs": [7]}' ELSE payload END AS payload""",
    )


# --- storage -------------------------------------------------------------------------------------

# A tenth of all files belongs to one table; every other supplier has four tables of growing size.
_BUCKET = "CASE WHEN l_orderkey % 16 = 0 THEN 0 WHEN l_orderkey % 16 <= 3 THEN 1 WHEN l_orderkey % 16 <= 8 THEN 2 ELSE 3 END"
_HOT = "{s} % 10 = 0"
_STORAGE_SCHEMA = "CASE WHEN {s} % 10 = 0 OR {s} % 2 = 1 THEN 'raw_schema' ELSE 'transform_schema' END AS table_schema"
_STORAGE_TABLE = "CASE WHEN {s} % 10 = 0 THEN 's_hot' ELSE concat('s_', {s}, '_', {b}) END"


def files(spark: SparkSession, sf: str) -> DataFrame:
    table = _STORAGE_TABLE.format(s="l_suppkey", b=_BUCKET)
    mb = "l_quantity * CASE l_suppkey % 5 WHEN 0 THEN 0.03D WHEN 1 THEN 5.0D ELSE 1.0D END"
    return _read(spark, sf, "lineitem").selectExpr(
        _STORAGE_SCHEMA.format(s="l_suppkey"),
        f"{table} AS table_name",
        f"concat({table}, '/part-', l_orderkey, '-', l_linenumber, '.parquet') AS file_path",
        f"floor({mb} * 1048576) AS size_bytes",
        "l_shipdate AS modified",
    )


LAKE = "s3://lake/warehouse"


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Two nightly listings of all files as an object store lands them. The older lacks some files; both hold log files beside the data."""
    given = files(spark, sf).selectExpr("*", "explode(array(DATE'2024-01-30', DATE'2024-01-31')) AS listed_on")
    named = "concat('s3://lake/', CASE WHEN size_bytes % 7 = 0 THEN 'archive' ELSE 'warehouse' END, '/', table_schema, '/'"
    log = "regexp_replace(file_path, '/part-', '/_log/')"
    return given.filter("listed_on = DATE'2024-01-31' OR size_bytes % 3 > 0").selectExpr(
        f"{named}, CASE WHEN size_bytes % 5 = 0 THEN {log} ELSE file_path END) AS path", "size_bytes", "modified", "listed_on"
    )


def _storage_tables(spark: SparkSession, sf: str) -> DataFrame:
    buckets = _read(spark, sf, "supplier").selectExpr("s_suppkey", "explode(array(0, 1, 2, 3)) AS bucket")
    return buckets.selectExpr(
        _STORAGE_SCHEMA.format(s="s_suppkey"),
        _STORAGE_TABLE.format(s="s_suppkey", b="bucket") + " AS table_name",
        f"CASE WHEN NOT {_HOT.format(s='s_suppkey')} THEN s_suppkey END AS supplier",
    ).distinct()


def table_props(spark: SparkSession, sf: str) -> DataFrame:
    none = "CAST(array() AS ARRAY<STRING>)"
    return _storage_tables(spark, sf).selectExpr(
        "table_schema",
        "table_name",
        "'delta' AS format",
        f"CASE WHEN supplier % 4 = 0 THEN array('load_date') ELSE {none} END AS partition_columns",
        f"CASE WHEN supplier % 3 = 0 THEN array('customer_id') ELSE {none} END AS clustering_columns",
    )


def storage_columns(spark: SparkSession, sf: str) -> DataFrame:
    hot = _HOT.format(s="l_suppkey")
    # Grouped on numbers; the names are written once per group.
    numbered = _read(spark, sf, "lineitem").selectExpr(
        f"CASE WHEN {hot} THEN 0 ELSE l_suppkey END AS supplier",
        f"CASE WHEN {hot} THEN 0 ELSE {_BUCKET} END AS bucket",
        "CAST((l_suppkey + l_linenumber * (l_suppkey % 5 + 1)) % 10 + 1 AS INT) AS slot",
        "l_linenumber",
    )
    grouped = numbered.groupBy("supplier", "bucket", "slot").agg(F.min("l_linenumber").alias("ordinal_position"))
    return grouped.selectExpr(
        _STORAGE_SCHEMA.format(s="supplier"),
        _STORAGE_TABLE.format(s="supplier", b="bucket") + " AS table_name",
        """element_at(array('created_date', 'Customer_Id', 'amount', 'account', 'region',
                            'load_tmst', 'status', 'plan_number', 'updated_time', 'notes'), slot) AS column_name""",
        "ordinal_position",
    )


# --- catalogue -----------------------------------------------------------------------------------

_CREATED = "TIMESTAMP_NTZ'2023-01-01 00:00:00' AS created"
_RUN_DAY = "TIMESTAMP_NTZ'2024-01-31 00:00:00'"
_PART_SCHEMA = "CASE WHEN p_size % 2 = 1 THEN 'raw_schema' ELSE 'transform_schema' END AS table_schema"
_PART_TABLE = """concat(
    CASE WHEN p_partkey % 11 = 0 THEN 'event_log_' WHEN p_partkey % 13 = 0 THEN '__materialization_' ELSE '' END,
    CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') ELSE upper(replace(p_name, ' ', '_')) END,
    '_', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '_view' ELSE '' END) AS table_name"""


def part_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "part").selectExpr(
        _PART_SCHEMA,
        _PART_TABLE,
        """CASE p_partkey % 5 WHEN 0 THEN 'MANAGED' WHEN 1 THEN 'EXTERNAL' WHEN 2 THEN 'VIEW'
             WHEN 3 THEN 'MATERIALIZED_VIEW' ELSE 'STREAMING_TABLE' END AS table_type""",
        "CASE WHEN p_partkey % 5 <> 2 THEN 'DELTA' END AS data_source_format",
        f"{_RUN_DAY} - make_dt_interval(p_size * 3 + 30) AS created",
        f"CASE WHEN p_partkey % 50 <> 0 THEN {_RUN_DAY} - make_dt_interval(p_size * 3) END AS last_altered",
    )


def part_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "part").selectExpr(
        _PART_SCHEMA,
        _PART_TABLE,
        """CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN concat('col ', p_size) WHEN 2 THEN lower(p_type)
             ELSE concat('c_', p_size) END AS column_name""",
        "'STRING' AS full_data_type",
        "1 AS ordinal_position",
        "'YES' AS is_nullable",
        "CAST(NULL AS STRING) AS comment",
    )


def storage_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows of the storage tables."""
    return _storage_tables(spark, sf).selectExpr(
        "table_schema",
        "table_name",
        "'MANAGED' AS table_type",
        "'DELTA' AS data_source_format",
        _CREATED,
        f"{_RUN_DAY} - make_dt_interval(CAST(supplier AS INT)) AS last_altered",
    )


def platform_tables(spark: SparkSession, sf: str) -> DataFrame:
    return part_tables(spark, sf).unionByName(storage_catalogue(spark, sf))


def views(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "documents").selectExpr(
        "'transform_schema' AS table_schema",
        "concat('v_', doc_id) AS table_name",
        """concat(CASE doc_id % 4 WHEN 0 THEN 'SELECT * FROM publish_x.' WHEN 1 THEN 'SELECT * FROM publishXx.'
                    WHEN 2 THEN 'SELECT * FROM raw_schema.t ' ELSE '' END, text) AS view_definition""",
    )


# --- snapshots -----------------------------------------------------------------------------------

_ORDER_SCHEMA = "concat('r', o_custkey % 2) AS table_schema"
_MONTH = "trunc(CAST(o_orderdate AS DATE), 'month') AS snapshot_date"


def order_columns(orders: DataFrame, *more: str) -> DataFrame:
    """Columns of the tables in ``orders``, one row per (more, schema, table, column)."""
    # Grouped on numbers; the names are written once per group.
    numbered = orders.selectExpr(*more, "o_custkey", "o_orderkey % 8 AS slot", "o_orderpriority", "o_orderstatus")
    keys = numbered.columns[:-2]
    grouped = numbered.groupBy(*keys).agg(
        F.min("o_orderpriority").alias("full_data_type"), F.max("o_orderstatus").alias("is_nullable")
    )
    return grouped.selectExpr(
        *keys[:-2],
        _ORDER_SCHEMA,
        "concat('tbl_', o_custkey, '_', slot % 2) AS table_name",
        "concat('col_', slot) AS column_name",
        "full_data_type",
        "CAST(slot AS INT) AS ordinal_position",
        "is_nullable",
        "CAST(NULL AS STRING) AS comment",
    )


def order_tables(orders: DataFrame, *more: str) -> DataFrame:
    keys = orders.selectExpr(*more, "o_custkey", "o_orderkey % 2 AS parity").distinct()
    return keys.selectExpr(
        *keys.columns[:-2],
        _ORDER_SCHEMA,
        "concat('tbl_', o_custkey, '_', parity) AS table_name",
        "CASE o_custkey % 3 WHEN 0 THEN 'MANAGED' WHEN 1 THEN 'EXTERNAL' ELSE 'VIEW' END AS table_type",
        "CASE WHEN o_custkey % 3 <> 2 THEN 'DELTA' END AS data_source_format",
        _CREATED,
        f"{_RUN_DAY} AS last_altered",
    )


def orders_before(spark: SparkSession, sf: str, day: date) -> DataFrame:
    """The orders of the year before ``day``: the catalogue of one night."""
    year = F.col("o_orderdate") >= F.lit(datetime(day.year - 1, day.month, day.day)).cast("timestamp_ntz")
    return _read(spark, sf, "orders").filter(year & (F.col("o_orderdate") < F.lit(datetime(day.year, day.month, day.day)).cast("timestamp_ntz")))


def current_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "orders").filter(CURRENT)


def previous_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "orders").filter(PREVIOUS)


def _stamped(rows: DataFrame, day: date) -> DataFrame:
    return rows.withColumnRenamed("comment", "col_comment").withColumn("snapshot_date", F.lit(day))


def monthly_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Column snapshots dated by the first day of the order month."""
    return order_columns(_read(spark, sf, "orders"), _MONTH).withColumnRenamed("comment", "col_comment")


def monthly_tables(spark: SparkSession, sf: str) -> DataFrame:
    return order_tables(_read(spark, sf, "orders"), _MONTH)


# --- history, lineage, audit ---------------------------------------------------------------------

# A third of the whole log belongs to one table.
_HISTORY_SLOT = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 997 END"


def _history_events(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "events").selectExpr("*", f"{_HISTORY_SLOT} AS slot")


def history(spark: SparkSession, sf: str) -> DataFrame:
    rows = "CAST(floor(value) AS STRING)"
    return _history_events(spark, sf).selectExpr(
        "'raw_schema' AS table_schema",
        "concat('t_', slot) AS table_name",
        "event_id AS version",
        "ts - make_dt_interval(CAST(slot % 120 AS INT)) AS timestamp",
        """CASE event_type WHEN 'click' THEN 'WRITE' WHEN 'purchase' THEN 'merge' WHEN 'signup' THEN 'OPTIMIZE'
             WHEN 'view' THEN 'VACUUM END' ELSE 'SET TBLPROPERTIES' END AS operation""",
        f"""CASE event_type WHEN 'click' THEN map('numOutputRows', {rows})
              WHEN 'purchase' THEN map('numTargetRowsInserted', {rows})
              ELSE CAST(map() AS MAP<STRING, STRING>) END AS operation_metrics""",
    )


def history_nights(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three landings of the log. Versions are dealt round, so later landings bring older entries, and the second some again."""
    whole, third = history(spark, sf), F.col("version") % 3
    return [whole.filter(third == 0), whole.filter((third == 1) | (F.col("version") % 6 == 0)), whole.filter(third == 2)]


def history_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows of the tables with a history; every seventh is a view."""
    return _history_events(spark, sf).select("slot").distinct().selectExpr(
        "'raw_schema' AS table_schema",
        "concat('t_', slot) AS table_name",
        "CASE WHEN slot % 7 = 3 THEN 'VIEW' ELSE 'MANAGED' END AS table_type",
        "'DELTA' AS data_source_format",
        _CREATED,
        f"{_RUN_DAY} AS last_altered",
    )


# The source table of a line, as numbers. A third of all lines reads the two tables of one part.
_LINEAGE_KEY = ["CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS part", "l_orderkey % 2 AS parity"]
_LINEAGE_SOURCE = "concat('source_catalog.r', part % 2, '.tbl_', part, '_', parity)"
_EVENT_DATE = f"date_add(CAST(l_shipdate AS DATE), {SHIP_SHIFT_DAYS})"


def access_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "lineitem").selectExpr("*", *_LINEAGE_KEY).selectExpr(
        f"{_LINEAGE_SOURCE} AS source_table_full_name",
        "CASE l_returnflag WHEN 'A' THEN 'NOTEBOOK' WHEN 'R' THEN 'JOB' ELSE 'TABLE' END AS entity_type",
        "CAST(l_suppkey AS STRING) AS entity_id",
        f"{_EVENT_DATE} AS event_date",
    )


def _listed(bits: str, below: str) -> str:
    """The suppliers of a page whose bits are set, in order; ``below`` holds those of negative keys. Null on the page of no key."""

    def suppliers(word: str, sign: str) -> str:
        lowest = f"bit_count(({word} & -{word}) - 1)"
        # The upper end may be one too high, which the test of the bit leaves out.
        places = f"filter(sequence({lowest}, CAST(log2({word}) + 1e-9 AS INT)), i -> shiftright({word}, i) & 1L = 1L)"
        one, many = f"array(page * {PAYLOAD_PAGE} {sign} {lowest})", f"transform({places}, i -> page * {PAYLOAD_PAGE} {sign} i)"
        return f"WHEN {word} & ({word} - 1) = 0 THEN {one} ELSE {many} END"

    above = f"CASE WHEN {bits} = 0 THEN CAST(array() AS ARRAY<BIGINT>) {suppliers(bits, '+')}"
    return f"CASE WHEN {below} = 0 THEN {above} ELSE concat(reverse(CASE {suppliers(below, '-')}), {above}) END"


def lineage_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage rendered as landed JSON pages: every asset of a table once, over as many pages as it takes."""
    # Grouped on numbers by one exchange. The suppliers of a page are bits of one number per kind (of another below zero), buffers
    # of fixed size; the names are written once the documents are made. Kind 3 is listed in both directions.
    lines = _read(spark, sf, "lineitem").selectExpr(
        *_LINEAGE_KEY,
        f"l_suppkey div {PAYLOAD_PAGE} AS page",
        f"CAST(coalesce(l_suppkey % {PAYLOAD_PAGE}, 0) AS INT) AS place",
        """CASE WHEN l_returnflag = 'A' THEN 2 WHEN l_returnflag = 'R' THEN 1 WHEN l_linestatus = 'F' THEN 3 ELSE 4 END AS kind""",
    )
    bits = "bit_or(CASE WHEN kind = {kind} AND {side} THEN shiftleft(1L, abs(place)) ELSE 0L END) AS {name}{kind}"
    sides = {"bits": "place >= 0", "below": "place < 0"}
    words = [bits.format(kind=kind, side=side, name=name) for kind in (1, 2, 3, 4) for name, side in sides.items()]
    documents = lines.groupBy("part", "parity", "page").agg(*[F.expr(word) for word in words])
    jobs, notebooks = (f"transform({_listed(f'bits{kind}', f'below{kind}')}, id -> named_struct('id', id, 'kind', {kind}))" for kind in (1, 2))
    entity = """named_struct('entity_type', if(e.kind = 1, 'JOB', 'NOTEBOOK'), 'path', if(e.kind = 2, concat('/Users/u', e.id, '/nb_u', e.id), NULL),
        'name', if(e.kind = 1, concat('Customer#', lpad(CAST(e.id AS STRING), 9, '0')), NULL))"""
    names = "CASE WHEN {any} = 0 THEN CAST(array() AS ARRAY<STRUCT<name: STRING>>) ELSE transform({ids}, id -> named_struct('name', concat('s_', id))) END"
    both = documents.selectExpr("*", "bits3 | bits4 AS bits5", "below3 | below4 AS below5")
    # In order of the suppliers, and of one supplier the job first.
    return both.selectExpr(
        f"{_LINEAGE_SOURCE} AS table_name",
        f"""to_json(named_struct(
             'downstreams', {names.format(any='bits5 | below5', ids=_listed('bits5', 'below5'))},
             'upstreams', {names.format(any='bits3 | below3', ids=_listed('bits3', 'below3'))},
             'entity_lineage', CASE WHEN bits1 | below1 | bits2 | below2 = 0 THEN CAST(array() AS ARRAY<STRUCT<entity_type: STRING, path: STRING, name: STRING>>)
               ELSE transform(sort_array(concat({jobs}, {notebooks})), e -> {entity}) END)) AS payload""",
    )


def table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage among the tables of the orders, rendered as landed pages: many hops down to a few shared tables, which form cycles."""
    target = "CASE WHEN o_custkey < 10 THEN 9 - o_custkey WHEN o_orderkey % 2 = 0 THEN o_custkey div 2 ELSE o_custkey div 3 END"
    edges = _read(spark, sf, "orders").selectExpr(
        "concat('source_catalog.r', o_custkey % 2, '.tbl_', o_custkey, '_', o_orderkey % 2) AS table_name",
        f"{target} AS target",
        "o_orderkey div 2 % 2 AS parity",
        "o_orderkey div 1000 AS page",
    )
    listed = edges.groupBy("table_name", "page").agg(F.collect_set(F.expr("named_struct('name', concat('source_catalog.r', target % 2, '.tbl_', target, '_', parity))")).alias("downstreams"))
    return listed.selectExpr("table_name", "to_json(named_struct('downstreams', downstreams)) AS payload")


def audit(spark: SparkSession, sf: str) -> DataFrame:
    path = "CASE WHEN user_id % 3 = 0 THEN concat('/Repos/r/', user_id, '/nb_', event_id) END"
    return _read(spark, sf, "events").selectExpr(
        "ts AS event_time",
        "CASE event_type WHEN 'view' THEN 'getNotebook' ELSE event_type END AS action_name",
        f"map('notebookId', CAST(user_id AS STRING), 'path', {path}) AS request_params",
    )


def workspace_listing(spark: SparkSession, sf: str) -> DataFrame:
    # Only part of the notebooks is listed, so some ids stay without a path.
    clicks = _read(spark, sf, "events").filter("event_type = 'click' AND value >= 150").select("user_id").distinct()
    return clicks.selectExpr(
        "CAST(user_id AS STRING) AS object_id",
        "'NOTEBOOK' AS object_type",
        """CASE WHEN user_id % 2 = 0 THEN concat('/Users/u', user_id, '/nb_u', user_id)
             ELSE concat('/Archive/u', user_id, '/nb') END AS path""",
    )


def user_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "events").selectExpr("CAST(user_id AS STRING) AS entity_id").distinct()


# --- inputs of the two analyses ------------------------------------------------------------------


class Inputs(Mapping[str, DataFrame]):
    """Named relations, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def optimization_inputs(spark: SparkSession, sf: str) -> Inputs:
    return Inputs(
        {
            "tables": partial(platform_tables, spark, sf),
            "columns": partial(storage_columns, spark, sf),
            "files": partial(files, spark, sf),
            "table_props": partial(table_props, spark, sf),
            "jobs": partial(jobs, spark, sf),
            "runs": partial(runs, spark, sf),
        }
    )


def metadata_inputs(spark: SparkSession, sf: str) -> Inputs:
    """Both dates of the catalogue, in which only the order tables differ, and the logs."""

    def tables(orders: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        same = part_tables(spark, sf).unionByName(history_tables(spark, sf))
        return same.unionByName(order_tables(orders(spark, sf)))

    def columns(orders: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
        return part_columns(spark, sf).unionByName(order_columns(orders(spark, sf)))

    return Inputs(
        {
            "tables": partial(tables, current_orders),
            "columns": partial(columns, current_orders),
            "prev_tables": lambda: _stamped(tables(previous_orders), PREVIOUS_DATE),
            "prev_columns": lambda: _stamped(columns(previous_orders), PREVIOUS_DATE),
            "views": partial(views, spark, sf),
            "history": partial(history, spark, sf),
            "access_lineage": partial(access_edges, spark, sf),
            "lineage_payload": partial(lineage_pages, spark, sf),
            "audit": partial(audit, spark, sf),
            "workspace_listing": partial(workspace_listing, spark, sf),
            "jobs": partial(jobs, spark, sf),
        }
    )
