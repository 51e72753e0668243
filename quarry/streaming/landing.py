"""Landing a stream and running it.

The studied program writes per-batch metrics from the driver into a local
file it deletes at start. Here the stream itself is landed by the executors
into a Parquet folder with a checkpoint (exactly once: a re-run on the same
checkpoint adds nothing), and metrics are batch queries over that folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path


def with_arrival(stream: DataFrame, name: str = "arrival") -> DataFrame:
    """Stamp each row with its micro-batch time (``current_timestamp`` is
    fixed for the whole micro-batch), i.e. the batch a line arrived in."""
    return stream.withColumn(name, F.current_timestamp())


def start_sink(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
               fmt: str = "parquet", trigger: dict | None = None,
               partition_by: list[str] | None = None, name: str | None = None) -> StreamingQuery:
    """Start a streaming write. ``trigger`` is e.g.
    ``{"processingTime": "5 seconds"}`` (the studied cadence) or
    ``{"availableNow": True}`` (process what is there, then stop)."""
    w = (stream.writeStream.format(fmt).outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()


def run_available(spark: SparkSession, stream: DataFrame, label: str, mode: str = "append",
                  partition_by: list[str] | None = None) -> DataFrame:
    """Run ``stream`` over all input present now into a fresh folder below the
    shared checkpoint root, wait for it, and return the landed rows as a batch
    frame. Waits as long as it takes; fails if the query failed."""
    run = f"{label}-{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "streams", run, "data")
    ckpt = scratch_path(spark, "streams", run, "checkpoint")
    q = start_sink(stream, path, ckpt, mode=mode, trigger={"availableNow": True},
                   partition_by=partition_by)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(path)
