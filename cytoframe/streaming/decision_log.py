"""Incremental reading of the append-only decision log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytoframe.sources.sinks import LOG_SCHEMA


def read_new_entries(spark: SparkSession, log_path: str) -> DataFrame:
    """The log as a stream; its files are only ever added."""
    return spark.readStream.schema(LOG_SCHEMA).json(log_path)


def copy_new_entries(spark: SparkSession, log_path: str, target: str, state: str) -> None:
    """Append entries not seen before to a Parquet table, then stop.

    ``state`` remembers the files already taken, so a rerun after a crash continues.
    """
    query = (
        read_new_entries(spark, log_path).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
