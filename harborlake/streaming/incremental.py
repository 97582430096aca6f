"""Loads of data that keeps arriving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, types as T

from harborlake.operators import dedupe
from harborlake.sinks import delete, is_complete, overwrite_partitions, overwrite_table, scratch_path
from harborlake.sinks.paths import exists
from harborlake.sources import read_table, stream_delimited
from harborlake.streaming.appending import in_partitions


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    *,
    sep: str = ",",
    files_per_batch: int | None = None,
) -> None:
    """Append the files that arrived since the last call to a Parquet folder, then stop.

    ``checkpoint`` remembers the files, and the folder's own log its committed batches, so
    each file is stored exactly once even when a run is cut off and started again.
    """
    stream = stream_delimited(spark, source, schema, sep=sep, files_per_batch=files_per_batch)
    _drain(stream.writeStream.format("parquet").option("path", target), checkpoint)


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _touched(df: DataFrame, partition_by: Sequence[str]) -> list[Row]:
    """Partition values that occur in ``df``: as many as the folders that a write of it lists anyway."""
    return df.select(*partition_by).distinct().collect()


def upsert_partitions(
    new: DataFrame,
    target: str,
    partition_by: Sequence[str],
    *,
    on: Sequence[str] | None = None,
    stage: str | None = None,
) -> list[Row]:
    """Add rows that are not there yet to a partitioned Parquet table.

    Only partitions that occur in ``new`` are read and replaced. Stored and new rows are
    de-duplicated together (full rows, or the smallest row per key ``on``), so doing it twice has the
    effect of doing it once, and no state is kept between runs.

    New rows and merged partitions are first written below ``stage``, by default in the
    shared scratch folder: the source is read once, and a table cannot be replaced while
    it is being read. A run that is cut off leaves its stage; one that is given the stage
    path of a run that was cut off after the merge goes on from there, since the table may
    have lost partitions half way.

    Returns the touched partitions.
    """
    spark = new.sparkSession
    stage = stage or scratch_path(spark, "upsert", keep=True)
    arrived_path, merged_path = f"{stage}/arrived", f"{stage}/merged"
    if not is_complete(spark, merged_path):
        overwrite_table(dedupe(new, on), arrived_path)
        arrived = read_table(spark, arrived_path, new.schema)
        if exists(spark, target):
            stored = _slice(spark, target, arrived, partition_by)
            overwrite_table(dedupe(stored.unionByName(arrived), on), merged_path)
        else:
            overwrite_table(arrived, merged_path)
    merged = read_table(spark, merged_path, new.schema)
    touched = _touched(merged, partition_by)
    overwrite_partitions(merged, target, partition_by, only_present=True)
    delete(spark, stage)
    return touched


def _slice(spark: SparkSession, target: str, arrived: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows of the partitions that occur in ``arrived``."""
    stored = read_table(spark, target, arrived.schema).select(*arrived.columns)
    return stored.where(in_partitions(_touched(arrived, partition_by), partition_by))
