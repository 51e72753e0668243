"""Stream sources.

The studied program reads lines from a TCP socket, which cannot be replayed
after a failure. Files landing in a folder (or Kafka, with its jar on the
class path) give offsets Spark can record in the checkpoint, so a restarted
query neither loses nor repeats input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet",
                name_filter: str | None = None, max_files_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """Unbounded frame over files arriving in ``folder`` (declared schema).

    ``name_filter`` is a file-name glob (e.g. one table's file among others);
    ``max_files_per_trigger`` bounds the size of a micro-batch.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if name_filter:
        r = r.option("pathGlobFilter", name_filter)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(folder)


def text_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files arriving in ``folder`` (``value`` column)."""
    return file_stream(spark, folder, "value string", fmt="text",
                       max_files_per_trigger=max_files_per_trigger)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S13 as in the studied program: lines from a TCP server (client side).

    Not replayable and not fault tolerant; for demonstrations only. Prefer
    ``file_stream`` or Kafka in production.
    """
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
