from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import storage
from tablewarden.operators.topk import top_n
from tablewarden.sources import files
from tablewarden.sources.files import file_inventory, storage_detail

FILES = "table_schema STRING, table_name STRING, file_path STRING, size_bytes BIGINT"
PROPS = (
    "table_schema STRING, table_name STRING, format STRING, partition_columns ARRAY<STRING>, clustering_columns ARRAY<STRING>"
)
DETAIL = (
    "table_schema STRING, table_name STRING, size_mb DOUBLE, files BIGINT, avg_file_mb DOUBLE, "
    "partition_columns ARRAY<STRING>, clustering_columns ARRAY<STRING>"
)
COLUMNS = "table_schema STRING, table_name STRING, column_name STRING, ordinal_position INT"


def test_storage_detail_keeps_tables_without_files_and_files_without_properties(rows):
    files = rows(FILES, ("s", "a", "1", 1048576), ("s", "a", "2", 3145728), ("s", "orphan", "3", 10))
    props = rows(PROPS, ("s", "a", "delta", ["d"], []), ("s", "empty", "delta", [], ["k"]))
    found = {r.table_name: r for r in storage_detail(files, props).collect()}
    assert (found["a"].size_bytes, found["a"].files, found["a"].size_mb, found["a"].avg_file_mb) == (4194304, 2, 4.0, 2.0)
    assert (found["empty"].files, found["empty"].size_mb, found["empty"].avg_file_mb) == (0, 0.0, 0.0)
    assert found["orphan"].files == 1 and found["orphan"].format is None


def test_file_inventory_reads_the_listing(spark, tmp_path):
    for schema, table, n in (("raw", "a", 3), ("raw", "b", 1)):
        folder = tmp_path / schema / table / "day=1"
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"part-{i}.bin").write_bytes(b"x" * (i + 1))
    found = file_inventory(spark, f"file:{tmp_path}").groupBy("table_schema", "table_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("size")
    )
    assert sorted(tuple(r) for r in found.collect()) == [("raw", "a", 3, 6), ("raw", "b", 1, 1)]


def test_file_inventory_below_a_folder_that_repeats_the_root(spark, tmp_path):
    folder = tmp_path / "raw" / "t" / str(tmp_path).lstrip("/") / "deep"
    folder.mkdir(parents=True)
    (folder / "part.bin").write_bytes(b"x")
    found = file_inventory(spark, f"file:{tmp_path}").collect()
    assert [(r.table_schema, r.table_name) for r in found] == [("raw", "t")]


def test_small_files_are_ordered_by_severity_then_files(rows, cfg):
    detail = rows(
        DETAIL,
        ("s", "many", 9000.0, 1500, 6.0, [], []),
        ("s", "tiny", 10.0, 60, 0.2, [], []),
        ("s", "high", 900.0, 300, 3.0, [], []),
        ("s", "fine", 900.0, 3, 300.0, [], []),
    )
    found = top_n(storage.small_files(detail, cfg), storage.small_file_order()).collect()
    assert [(r.table_name, r.severity) for r in found] == [("many", "CRITICAL"), ("tiny", "CRITICAL"), ("high", "HIGH")]
    assert found[0].cmd == "OPTIMIZE source_catalog.s.many;"


@pytest.mark.parametrize(
    ("size", "keys", "expected"), [(100.0, [], 0), (100.01, [], 1), (100.01, ["a"], 0), (100.01, None, 1)]
)
def test_unclustered(rows, cfg, size, keys, expected):
    detail = rows(DETAIL, ("s", "t", size, 1, 1.0, [], keys))
    assert storage.unclustered(detail, cfg).count() == expected


@pytest.mark.parametrize(("keys", "expected"), [("[]", 1), ("None", 1), ("", 1), (None, 1), ("['a']", 0)])
def test_unclustered_accepts_lists_as_text(rows, cfg, keys, expected):
    detail = rows(DETAIL.replace("clustering_columns ARRAY<STRING>", "clustering_columns STRING"), ("s", "t", 200.0, 1, 1.0, [], keys))
    assert storage.unclustered(detail, cfg).count() == expected


@pytest.mark.parametrize(
    ("names", "keys"),
    [
        (["customer_id", "created_date", "amount", "account_no", "plan_number"], ["created_date", "customer_id", "account_no"]),
        (["customer_id", "plan_number", "account", "x_key"], ["customer_id", "plan_number", "account"]),
        (["a_date", "b_time"], ["a_date"]),
        (["created_id", "x_id"], ["created_id", "x_id"]),
        (["notes", "status"], []),
        (["Customer_ID", "LOAD_TMST"], ["load_tmst", "customer_id"]),
    ],
)
def test_recommended_keys(rows, cfg, names, keys):
    detail = rows(DETAIL, ("s", "t", 200.0, 1, 1.0, [], []))
    columns = rows(COLUMNS, *[("s", "t", name, i) for i, name in enumerate(names)], ("s", "other", "z_date", 1))
    found = storage.recommend_clustering(detail, columns, cfg).first()
    assert found.rec_cols == keys
    expected = f"ALTER TABLE source_catalog.s.t CLUSTER BY ({', '.join(keys)});" if keys else ""
    assert found.alter_cmd == expected and found.opt_cmd == "OPTIMIZE source_catalog.s.t;"


@pytest.mark.parametrize(
    ("altered", "stale"),
    [(datetime(2023, 12, 2), False), (datetime(2023, 12, 2, 23, 59), False), (datetime(2023, 12, 1, 23, 59), True), (None, False)],
)
def test_stale_assets(rows, cfg, altered, stale):
    views = rows("table_schema STRING, table_name STRING, last_altered TIMESTAMP_NTZ", ("s", "v", altered))
    assert storage.stale_views(views, cfg).count() == int(stale)


def test_stale_assets_by_local_date_of_an_instant(rows, cfg):
    # 2023-12-02 04:59 UTC is still December 1 in New York.
    texts = rows("n STRING, s STRING", ("old", "2023-12-02 04:59:00"), ("new", "2023-12-02 05:00:00"))
    views = texts.select(F.lit("s").alias("table_schema"), F.col("n").alias("table_name"), F.col("s").cast("timestamp").alias("last_altered"))
    assert [r.table_name for r in storage.stale_views(views, cfg).collect()] == ["old"]


def test_landed_listings_give_what_a_folder_listing_gives(spark, rows, tmp_path):
    root = tmp_path / "lake"
    for name in ("s/t/part-1.parquet", "s/t/part-2.parquet", "s/t/_delta_log/0.json", "s/u/x=1/.part.crc", "s/u/x=1/part.parquet", "lake/t/part.parquet"):
        place = root / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(b"12345")
    listed = [(r.file_path, r.size_bytes, r.modified) for r in files.file_inventory(spark, str(root)).collect()]
    more = [(f"file:{root}/s/t/_delta_log/0.json", 5, None), (f"file:{root}/s/u/x=1/.part.crc", 5, None), ("file:/elsewhere/s/t/part.parquet", 5, None)]
    gone = [(f"file:{root}/s/t/part-0.parquet", 9, None)]
    landed = rows(
        "path STRING, size_bytes BIGINT, modified TIMESTAMP, listed_on STRING",
        *[(*f, d) for f in [*listed, *more] for d in ("2024-01-01", "2024-01-02")], *[(*f, "2024-01-01") for f in gone], ("file:/elsewhere/a/b/c", 1, None, "2024-01-03"),
    )
    scheme = listed[0][0].split(str(root))[0]
    shown = files.landed_inventory(landed, f"{scheme}{root}/")
    want = files.file_inventory(spark, str(root))
    assert shown.columns == want.columns and sorted(map(tuple, shown.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert shown.count() == 4 and files.landed_inventory(landed.limit(0), "file:/x").count() == 0
