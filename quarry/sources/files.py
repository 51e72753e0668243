"""File and database sources.

Schemas are always declared: inference reads the input an extra time and
gives string or guessed types. Malformed rows are not dropped and do not
fail the job; they come back in a reject column (``_reject``), so a caller
can write the good rows and the rejects in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

REJECT = "_reject"
CORRUPT = "_corrupt"


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines (``value`` column), lazy; one split per file block."""
    return spark.read.text(path)


def inline_frame(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small in-memory table (lookups, code lists). Only for data whose
    size is fixed by the program, never for data that grows."""
    return spark.createDataFrame(list(rows), schema)


def _as_text(schema: StructType) -> StructType:
    """The declared fields with every atomic type read as text (complex types
    kept), plus the corrupt-record column for lines that do not parse at all."""
    fields = [StructField(f.name, f.dataType if isinstance(f.dataType, (StructType, ArrayType, MapType))
                          else StringType(), True) for f in schema.fields]
    return StructType(fields + [StructField(CORRUPT, StringType(), True)])


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast text fields to the declared types with ``try_cast``; a row gets a
    reject reason when its line did not parse or a present value did not
    convert (see ``typed.typed_projection``)."""
    from .typed import typed_projection
    atomic = {f.name: (F.col(f.name), f.dataType.simpleString()) for f in schema.fields
              if not isinstance(f.dataType, (StructType, ArrayType, MapType))}
    complex_ = [f.name for f in schema.fields if f.name not in atomic]
    structural = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed line"))
    pre = df.withColumn(REJECT, structural).drop(CORRUPT)
    out = typed_projection(pre, atomic, keep=complex_)
    return out.select(*[f.name for f in schema.fields], REJECT)


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                    allow_single_quotes: bool = True) -> DataFrame:
    """S3: JSON-lines files with a declared schema; malformed lines and values
    that do not convert are flagged in ``_reject``."""
    df = (spark.read.schema(_as_text(schema))
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .option("allowSingleQuotes", str(allow_single_quotes).lower())
          .json(path))
    return _typed(df, schema)


def parse_json_column(df: DataFrame, column: str, schema: StructType | str,
                      name: str | None = None, rejects: bool = False) -> DataFrame:
    """JSON records held as strings (single quotes accepted), parsed in
    place by ``from_json``. Without ``rejects`` a record that does not parse
    gives a null struct. With it the frame gets a ``_reject`` column: the
    reason for a record that is no JSON or holds a value that does not convert
    (its other fields are still read); absent fields and null records are no rejects."""
    options = {"allowSingleQuotes": "true", "mode": "PERMISSIVE"}
    if not rejects:
        return df.withColumn(name or column, F.from_json(F.col(column), schema, options))
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = StructType(declared.fields + [StructField(CORRUPT, StringType(), True)])
    parsed = df.withColumn("_parsed", F.from_json(F.col(column), wide, options | {"columnNameOfCorruptRecord": CORRUPT}))
    record = F.col(f"`{column}`")
    bad = record.isNotNull() & (F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull())
    reason = F.when(bad & F.try_parse_json(record).isNull(), F.lit(f"{column}: no JSON")).when(bad, F.lit(f"{column}: bad value"))
    value = F.when(F.col("_parsed").isNotNull(), F.struct(*[F.col(f"_parsed.`{f.name}`").alias(f.name) for f in declared.fields]))
    prior = F.coalesce(F.col(REJECT), reason) if REJECT in df.columns else reason
    out = parsed.withColumn(REJECT, prior)
    return out.withColumn(name or column, value).drop("_parsed")


# Null in delimited files; a field with nothing in it is null too, a quoted nothing is empty text.
CSV_NULL = "\\N"


def escape_text(c):
    """Text on one line that no null mark equals: a backslash is doubled, line breaks become ``\\n`` and ``\\r``."""
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_text(c):
    """The text that ``escape_text`` was given: what stands between doubled backslashes has its line breaks put back."""
    def between(x):
        return F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\", -1), between), "\\")).otherwise(c)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                   sep: str = ",", header: bool = False, quote: str | None = '"', escaped: bool = False) -> DataFrame:
    """Delimited text with a declared schema (CSV with or without a
    header, or another separator such as ``;``). A header line is skipped
    once per file; rows that do not fit the schema are flagged. ``escaped``:
    the files come from ``write_delimited(escaped=True)``."""
    reader = (spark.read.schema(_as_text(schema))
              .option("sep", sep).option("header", str(header).lower())
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("escape", '"').option("nullValue", CSV_NULL)
              .option("enforceSchema", "true"))
    if quote is not None:
        reader = reader.option("quote", quote)
    df = _typed(reader.csv(path), schema)
    if not escaped:
        return df
    texts = {f.name for f in schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[unescape_text(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename awkward source headers (``MPG-CITY`` -> ``MPG_CITY``)."""
    return df.withColumnsRenamed(mapping)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """A database table. With a numeric ``partition_column`` and bounds the
    read is split into ``num_partitions`` parallel range queries instead of
    one connection pulling the whole table."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs bounds and a partition count")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL text."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """SQL over registered views; values are bound as named parameters
    (``:name``), never pasted into the text."""
    return spark.sql(text, args=args) if args else spark.sql(text)
