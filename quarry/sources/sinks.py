"""Sinks.

Writes run on the executors, one part file per task, committed by Spark's
output committer, so a lost executor's task is simply re-run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import CSV_NULL, escape_text


def write_text(df: DataFrame, path: str, column: str | None = None,
               mode: str = "errorifexists") -> None:
    """A directory of text part files; by default fails if the path
    exists, like ``saveAsTextFile``."""
    col = column or df.columns[0]
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "errorifexists", escaped: bool = False) -> None:
    """S10, delimited form, read back unchanged by ``read_delimited``: blanks,
    empty text (a quoted nothing) and null (``CSV_NULL``), quotes and separators
    survive. A line break inside a value would split its row on reading, and a
    value that is the null mark itself would come back null: such a value fails
    the write, or survives with ``escaped`` (to be read with ``escaped`` too)."""
    def safe(n):
        c = F.col(f"`{n}`")
        if escaped:
            return escape_text(c).alias(n)
        refused = F.raise_error(F.concat(F.when(c == CSV_NULL, F.lit("null mark as text")).otherwise(F.lit("line break")), F.lit(f" in column {n}")))
        return F.when(c.rlike(r"[\r\n]") | (c == CSV_NULL), refused).otherwise(c).alias(n)

    cols = [safe(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes]
    (df.select(*cols).write.mode(mode).option("sep", sep).option("header", str(header).lower())
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("escape", '"').option("nullValue", CSV_NULL).csv(path))


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one object per row (the form ``read_json_lines`` reads)."""
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "errorifexists", fmt: str = "parquet",
                max_records_per_file: int | None = None) -> None:
    """Columnar sink, partitioned on write so later reads prune partitions."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.save(path)
