"""Layout and reuse."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """K1: persist a frame for a block that reads it more than once, and
    release it afterwards (the studied programs never unpersist)."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def partition_profile(df: DataFrame) -> DataFrame:
    """K3: rows per partition, to spot skew (replaces asking for the count
    of partitions). Runs as one partial aggregate; nothing is collected."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("rows")))


def row_bytes(df: DataFrame) -> DataFrame:
    """One row: files, bytes, rows and bytes per row of a frame read from files (from each file's
    own ``_metadata``; a file without rows is not seen)."""
    per_file = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("n").alias("rows"),
                        F.try_divide(F.sum("file_size"), F.sum("n")).alias("bytes_per_row"))


def write_sized(df: DataFrame, path: str, target_bytes: int, bytes_per_row: float, partition_by: tuple[str, ...] = ()) -> int:
    """K3: Parquet files of about ``target_bytes`` each, at most so many rows
    as that holds at ``bytes_per_row`` (see ``row_bytes``). A task closes a file
    when it is full; with ``partition_by`` each value's rows are brought together
    first, dealt over several tasks where AQE finds them many (rebalance). Returns the rows per file."""
    most = max(1, int(target_bytes // bytes_per_row))
    w = df.hint("rebalance", *partition_by) if partition_by else df
    w = w.write.option("maxRecordsPerFile", str(most))
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return most


def file_profile(df: DataFrame, *keys: str) -> DataFrame:
    """K3 of a stored frame: files, rows, bytes, and the fewest and most rows of a file, overall or per ``keys`` (partition columns)."""
    per_file = df.groupBy(*keys, "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"), F.sum("file_size").alias("bytes"),
                                       F.min("n").alias("least_rows"), F.max("n").alias("most_rows"))


def written(df: DataFrame, label: str) -> DataFrame:
    """A frame that later steps read more than once, written as Parquet below
    ``spark.checkpoint.dir`` and read again: later readers prune its columns,
    and a lost executor never sends the job back to the raw input. The folder
    is kept, since the returned frame reads it."""
    path = scratch_path(df.sparkSession, "tables", f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
