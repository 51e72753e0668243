"""Typed projection with rejects.

The programs parse each line in a row function and fail the task on the
first bad number. Here every field is one ``try_cast`` expression inside a
single ``select``; a row whose non-empty input did not convert is kept with a
reason instead of being dropped or failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import REJECT


def typed_projection(df: DataFrame, spec: Mapping[str, tuple[Column, str]],
                     keep: list[str] | None = None) -> DataFrame:
    """Project ``name -> (expression, type)``; add ``_reject`` naming the
    first field whose value was present but did not convert."""
    cols = [F.col(k) for k in (keep or [])]
    reason = None
    for name, (expr, typ) in spec.items():
        cast = expr.try_cast(typ)
        cols.append(cast.alias(name))
        bad = expr.isNotNull() & cast.isNull()
        reason = (F.when(bad, F.lit(f"bad {name}")) if reason is None
                  else reason.when(bad, F.lit(f"bad {name}")))
    prior = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast("string")
    rej = prior if reason is None else F.coalesce(prior, reason.otherwise(F.lit(None)))
    return df.select(*cols, rej.alias(REJECT))


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows without a reject reason, reject column removed."""
    return df.where(F.col(REJECT).isNull()).drop(REJECT)


def reject_rows(df: DataFrame) -> DataFrame:
    """Rows with a reject reason."""
    return df.where(F.col(REJECT).isNotNull())


def read_counts(df: DataFrame, source: str) -> DataFrame:
    """How many rows of a read were good and how many were rejected for each
    reason: (source, reason, rows), null reason for the good ones. One partial aggregate."""
    return (df.groupBy(F.col(REJECT).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(source).alias("source"), "reason", "rows"))
