"""Storage detail from a file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.functions.storage import avg_file_mb, size_mb
from tablewarden.sources.catalog import TABLE_KEY


def _below_root(listed: DataFrame, root: str) -> DataFrame:
    """Listed files (file_path, size_bytes, modified) with the schema and table that their folders below ``root`` name."""
    # The root is matched as plain text, wherever the file system puts its scheme.
    # Only its first occurrence counts: a folder below it may repeat its name.
    after_root = F.element_at(F.split("file_path", F.lit(rf"\Q{root.rstrip('/')}/\E"), 2), -1)
    below_root = F.split(after_root, "/")
    return listed.select(
        F.get(below_root, F.lit(0)).alias("table_schema"),
        F.get(below_root, F.lit(1)).alias("table_name"),
        "file_path",
        "size_bytes",
        "modified",
    )


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file under ``root/<schema>/<table>/``; only the listing is read, never the content.

    Spark keeps a listing on the driver, so this serves one schema or table folder at a time. Beyond a few million files
    use ``landed_inventory``.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )
    return _below_root(listed, root)


def landed_inventory(listing: DataFrame, root: str) -> DataFrame:
    """The rows of ``file_inventory`` from the listings that an object store lands as a table (path, size_bytes, modified, listed_on).

    Only the newest listing under ``root`` counts, whose date is one row that is broadcast; the listing is read by tasks and never
    held by the driver. As in a folder listing, files and folders whose names begin with a dot or an underscore are left out.
    """
    prefix = f"{root.rstrip('/')}/"
    under = listing.filter(F.col("path").startswith(prefix))
    newest = F.broadcast(under.agg(F.max("listed_on").alias("listed_on")))
    hidden = F.substring("path", len(prefix) + 1, 1 << 30).rlike(r"(^|/)[._]")
    listed = under.filter(~hidden).join(newest, "listed_on", "left_semi")
    return _below_root(listed.withColumnRenamed("path", "file_path"), root)


def storage_detail(files: DataFrame, props: DataFrame) -> DataFrame:
    """Bytes, file count and layout of every table. Files are aggregated before the join."""
    totals = files.groupBy(*TABLE_KEY).agg(
        F.sum("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("files")
    )
    joined = props.join(totals, TABLE_KEY, "full_outer")
    size_bytes = F.coalesce("size_bytes", F.lit(0))
    files_count = F.coalesce("files", F.lit(0))
    return joined.select(
        *TABLE_KEY,
        "format",
        size_bytes.alias("size_bytes"),
        files_count.alias("files"),
        size_mb(size_bytes).alias("size_mb"),
        avg_file_mb(size_bytes, files_count).alias("avg_file_mb"),
        "partition_columns",
        "clustering_columns",
    )
