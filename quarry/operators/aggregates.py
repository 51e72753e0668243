"""Aggregations.

Every aggregate is an ``agg`` of built-in functions, so Spark plans a partial
(map-side) aggregate before the shuffle: a hot key costs one row per map
task, never a whole group in one task. Global results are one-row frames,
not driver values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rounded_pct
from ..functions.text import _c, ColumnOrName, explode_words, tokens


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def total(df: DataFrame, c: ColumnOrName, name: str = "total") -> DataFrame:
    """A2: global sum (the ``reduce(_ + _)`` of the programs)."""
    return df.agg(F.sum(_c(c)).alias(name))


def shortest(df: DataFrame, c: ColumnOrName, name: str = "shortest",
             length_name: str = "length") -> DataFrame:
    """A3: the shortest value; ties go to the smallest text, so the answer
    does not depend on partitioning (``reduce`` order is not defined)."""
    col = _c(c)
    return df.agg(F.min_by(col, F.struct(F.length(col), col)).alias(name),
                  F.min(F.length(col)).alias(length_name))


def int_avg(df: DataFrame, value: Column, name: str = "avg") -> DataFrame:
    """A4: ``sum div count`` - the integer division of the programs."""
    return (df.agg(F.sum(value).cast("bigint").alias("__s"), F.count(F.lit(1)).alias("__n"))
            .select(F.expr("__s div __n").alias(name)))


def parsed_avg(df: DataFrame, value: Column, name: str = "avg") -> DataFrame:
    """A5: mean of parsed values; rows that do not parse (null) are left out
    of both the sum and the count."""
    return df.agg(F.avg(value).alias(name))


def int_avg_by_key(df: DataFrame, key: str, value: Column, name: str = "avg") -> DataFrame:
    """Per key ``sum div count`` (the ``reduceByKey`` of (sum, count) pairs)."""
    return (df.groupBy(key)
            .agg(F.sum(value).cast("bigint").alias("__s"), F.count(F.lit(1)).alias("__n"))
            .select(key, F.expr("__s div __n").alias(name)))


def group_count(df: DataFrame, *keys: ColumnOrName, name: str = "count") -> DataFrame:
    """A7."""
    return df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def group_avg_max(df: DataFrame, keys: Sequence[ColumnOrName], value: ColumnOrName,
                  avg_name: str = "avg", max_name: str = "max") -> DataFrame:
    """A8."""
    v = _c(value)
    return df.groupBy(*[_c(k) for k in keys]).agg(F.avg(v).alias(avg_name),
                                                  F.max(v).alias(max_name))


def rate_report(df: DataFrame, keys: Sequence[ColumnOrName], flag: Column,
                total_name: str = "total", flagged_name: str = "flagged",
                pct_name: str = "pct_flagged", weight: Column | None = None) -> DataFrame:
    """Per key: rows, rows flagged, ``round(flagged * 100 / rows)``.

    ``flag`` is a 0/1 (or boolean) column. ``weight`` lets a caller feed
    pre-aggregated rows (count already summed per finer key), so a report
    can be rolled up from a smaller table without re-reading the facts.
    """
    f = flag.cast("bigint")
    w = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    return (df.groupBy(*[_c(k) for k in keys])
            .agg(F.sum(w).alias(total_name), F.sum(f).alias(flagged_name))
            .withColumn(pct_name, rounded_pct(F.col(flagged_name), F.col(total_name))))


def distinct_values(df: DataFrame, *cols: ColumnOrName) -> DataFrame:
    """Distinct values (one partial-aggregate shuffle)."""
    return df.select(*[_c(c) for c in cols]).distinct()


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Several counts in one pass, exact on re-runs (unlike accumulators
    bumped inside a transformation)."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def count_above_mean(df: DataFrame, value: ColumnOrName, name: str = "n_above") -> DataFrame:
    """Rows whose value exceeds the table's own mean; the mean is a
    scalar subquery (a one-row aggregate, no join), which Spark also pushes
    into the Parquet scan as a filter value for row-group skipping."""
    v = _c(value)
    mean = df.select(F.avg(v)).scalar()
    return df.where(v > mean).agg(F.count(F.lit(1)).alias(name))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of several columns, one pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_sd")]
    return df.agg(*aggs)


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation that is null, not an ANSI divide-by-zero error,
    for a constant column."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_with_label(df: DataFrame, label: str, cols: Sequence[str],
                    field_name: str = "field", corr_name: str = "corr") -> DataFrame:
    """Correlation of ``label`` with each column in ONE pass, returned in
    long form (field, corr) - not one job per column."""
    wide = df.agg(*[safe_corr(F.col(label).cast("double"), F.col(c).cast("double")).alias(c)
                    for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as ({field_name}, {corr_name})")


def word_count(df: DataFrame, text: ColumnOrName, sep: str = " ",
               word_name: str = "word", count_name: str = "count") -> DataFrame:
    """Words of every line (JVM split rule), counted. The partial
    aggregate runs before the shuffle, so a very frequent word costs one row
    per map task."""
    gen, keep = explode_words(tokens(text, sep), word_name)
    return (df.select(gen).where(keep)
            .groupBy(word_name).agg(F.count(F.lit(1)).alias(count_name)))


def confusion_matrix(df: DataFrame, label: ColumnOrName, prediction: ColumnOrName,
                     name: str = "count") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(_c(label), _c(prediction)).agg(F.count(F.lit(1)).alias(name))
