"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: Fixed value: the white space of every contract, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a task (characters): bounds the Python objects alive.
SLICE_CHARS = 2_000_000


def materialised(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a frame as Parquet below the shared checkpoint folder and read it
    back: lineage cut that survives the loss of any executor."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns (extra columns of the input never reach an operator)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def one_of_each(keyed: DataFrame, decided: DataFrame, on: Column) -> DataFrame:
    """Rows of ``keyed`` (with a struct column ``row``) that stay after ``decided``
    (a column ``keep_as``, one row per key of ``on``; null: the key's rows go;
    otherwise: of all rows with that value the smallest in column order stays).
    Keys that are not in ``decided`` stay as they are. The second pass over the
    rows is made only where something repeats; it is a partial aggregate, so a
    row repeated any number of times costs one row per task."""
    rest = keyed.join(decided, on, "left_anti").select("row.*")
    repeated = decided.where("keep_as is not null")
    if repeated.isEmpty():
        return rest
    return rest.unionAll(keyed.join(repeated, on).groupBy("keep_as").agg(F.min("row").alias("row")).select("row.*"))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null ids count as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def map_batches(df: DataFrame, per_task: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
                schema: str) -> DataFrame:
    """mapInArrow with a per-task set-up: ``per_task()`` runs once in each task
    and returns the function applied to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = per_task()
        for b in batches:
            if b.num_rows:
                yield from fn(b)

    return df.mapInArrow(run, schema)


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about ``limit`` characters each (a longer text is alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
