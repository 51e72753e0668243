"""Metrics of single micro-batches, and streams that run in several sittings.

Every micro-batch has one time stamp, ``current_timestamp``; Spark keeps it in
the checkpoint, so a batch that is repeated after a failure has the same one.
It names the batch. Grouping by it under a watermark of zero gives append-mode
results per batch: state holds the last batch only, and its rows land when the
next batch (or the closing one without data) begins, exactly once through the
file sink's own log. No driver callback, no port, no rows through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import explode_words, tokens
from ..session import remove_scratch, scratch_path
from .landing import start_sink, with_arrival
from .sources import file_stream


class Folder:
    """A shared folder that files arrive in: each ``arrive`` adds one frame's
    files (data is a part of the name, so parts of an earlier run stay apart)."""

    def __init__(self, spark: SparkSession, label: str, schema: StructType | str):
        self.spark, self.schema, self.parts = spark, schema, 0
        self.path = scratch_path(spark, "streams", f"{label}-{uuid.uuid4().hex[:12]}", "in")

    def arrive(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/part-{self.parts:05d}")
        self.parts += 1

    def stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        if not self.parts:  # a stream needs its folder
            self.arrive(self.spark.createDataFrame([], self.schema))
        return file_stream(self.spark, self.path, self.schema, max_files_per_trigger=max_files_per_trigger,
                           options={"recursiveFileLookup": "true"})


class Landing:
    """A stream's shared output folder and checkpoint, kept over any number of
    starts: whoever starts it again goes on where the last one stopped."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, "streams", f"{label}-{uuid.uuid4().hex[:12]}")
        self.path, self.checkpoint, self.schema = f"{self.root}/data", f"{self.root}/checkpoint", None

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        self.schema = stream.schema
        return start_sink(stream, self.path, self.checkpoint, trigger=trigger)

    def run(self, stream: DataFrame) -> "Landing":
        """Take all input present now, wait as long as it takes; fails if the query failed."""
        query = self.start(stream, {"availableNow": True})
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return self

    def rows(self) -> DataFrame:
        """The landed rows as a batch frame (only what the sink's log has committed)."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def remove(self) -> None:
        """Delete rows and checkpoint; frames that read them end with it."""
        remove_scratch(self.spark, self.root)


def heartbeat(spark: SparkSession) -> DataFrame:
    """One row per trigger (and per start of an ``availableNow`` run): with it a batch without input still counts."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()


def batch_counts(stream: DataFrame, zeros: bool = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """One metric row per micro-batch: its ``arrival`` and row count ``n``
    (and aggregates ``extra``). ``zeros``: batches without input give a row with 0."""
    extra = extra or {}
    rows = stream.withColumn("_one", F.lit(1))
    if zeros:
        rows = rows.unionByName(heartbeat(stream.sparkSession).select(F.lit(0).alias("_one")), allowMissingColumns=True)
    return (with_arrival(rows).withWatermark("arrival", "0 seconds").groupBy("arrival")
            .agg(F.sum("_one").cast("bigint").alias("n"), *[c.alias(k) for k, c in extra.items()]))


def batch_word_counts(stream: DataFrame, text: str = "value", sep: str = " ") -> DataFrame:
    """Word counts of each micro-batch (``arrival``, ``word``, ``count``), nothing carried over.
    Partial counts are made before the shuffle; state holds the last batch's distinct words."""
    gen, keep = explode_words(tokens(text, sep), "word")
    words = stream.select(gen).where(keep)
    return (with_arrival(words).withWatermark("arrival", "0 seconds").groupBy("arrival", "word")
            .agg(F.count(F.lit(1)).alias("count")).select("arrival", "word", "count"))


def merged_word_counts(deltas: DataFrame, upto: Column | None = None) -> DataFrame:
    """Running totals: the landed per-batch counts added up when read, as of now or of the batch time ``upto``."""
    kept = deltas if upto is None else deltas.where(F.col("arrival") <= upto)
    return kept.groupBy("word").agg(F.sum("count").cast("bigint").alias("count"))


def numbered(metrics: DataFrame, name: str = "batch") -> DataFrame:
    """Metric rows with the batch's number from 0 (one row per batch: a small table)."""
    return metrics.withColumn(name, (F.row_number().over(Window.orderBy("arrival")) - 1).cast("bigint"))


def window_counts(stream: DataFrame, marks: DataFrame, ts: str, length: str, slide: str, delay: str = "0 seconds") -> DataFrame:
    """T4 from state: rows per sliding window in append mode. ``marks`` is a
    stream of (ts) rows that count nothing but move the watermark on: one mark
    behind the last window closes all windows still open."""
    both = stream.select(ts, F.lit(1).alias("_one")).unionByName(marks.select(ts, F.lit(0).alias("_one")))
    return (both.withWatermark(ts, delay).groupBy(F.window(ts, length, slide)).agg(F.sum("_one").cast("bigint").alias("count")).where("count > 0")
            .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"), "count"))


def closing_mark(rows: DataFrame, ts: str, length: str, delay: str = "0 seconds") -> DataFrame:
    """One row behind the last window that any of ``rows`` is in; none where there are no rows."""
    last = rows.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
    return last.select((F.col(ts) + F.expr(f"INTERVAL '{length}'") + F.expr(f"INTERVAL '{delay}'")).cast("timestamp").alias(ts))
