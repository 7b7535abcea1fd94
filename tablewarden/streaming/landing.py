"""Folders in which documents land, followed as streams that stop when they have caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def landed(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of ``folder`` as a stream, oldest first; ``files_per_batch`` bounds what one micro-batch holds."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def catch_up(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all that has landed since the last call to ``each``, batch by batch, and return.

    ``checkpoint`` is a folder that all executors share. A batch that failed is handed over again, with the same rows, so
    ``each`` must give the same result when it is repeated.
    """
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
