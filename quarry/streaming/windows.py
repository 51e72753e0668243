"""Windowed stream counts and per-slot metrics.

Streaming state is bounded by a watermark: a window's count is final, and
its state dropped, once the watermark passes the window end (append mode).
The per-slot metrics of the studied program (lines per 5 s batch, zero
batches included, and the sum of the last three) are computed from landed
rows with aggregates, never with a window over one global partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import explode_words, tokens


def event_time(stream: DataFrame, column: str) -> DataFrame:
    """Watermarks need ``timestamp``; cast a ``timestamp_ntz`` column (the
    session clock is UTC, so the instant is unchanged)."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))


def sliding_counts(stream: DataFrame, ts: str, length: str = "15 seconds", slide: str = "5 seconds",
                   watermark: str = "0 seconds", keys: tuple[str, ...] = ()) -> DataFrame:
    """T4: rows per sliding window (and optional keys), state bounded by the
    watermark. Window bounds come back as ``timestamp_ntz`` columns."""
    s = stream.withWatermark(ts, watermark)
    g = s.groupBy(F.window(ts, length, slide), *keys).agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"), *keys, "count")


def running_word_count(stream: DataFrame, text: str = "value", sep: str = " ") -> DataFrame:
    """T3 running total: a stateful word count (update/complete output mode).
    State holds one row per distinct word."""
    gen, keep = explode_words(tokens(text, sep), "word")
    return stream.select(gen).where(keep).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def slot_of(ts: Column, slot_seconds: int) -> Column:
    """Start of the fixed ``slot_seconds`` slot holding ``ts``, as
    ``timestamp_ntz``: midnight of the value's own wall clock plus whole slots.
    For a ``timestamp_ntz`` column no time zone enters (no DST gaps or
    repeated hours); ``slot_seconds`` must divide a day."""
    secs = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    start = F.floor(secs / F.lit(slot_seconds)) * F.lit(slot_seconds)
    offset = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), start.cast("decimal(18,6)"))
    return (F.date_trunc("day", ts) + offset).cast("timestamp_ntz")


def all_slots(landed: DataFrame, ts: str, slot_seconds: int) -> DataFrame:
    """Every slot start between the first and the last row's slot.

    Slots are generated per day and spread over tasks: the day list comes
    from a one-row aggregate (its length is the span in days), is
    hash-partitioned, and each task expands its days into slots.
    ``slot_seconds`` must divide a day.
    """
    if 86400 % slot_seconds:
        raise ValueError("slot length must divide a day")
    bounds = landed.agg(F.min(slot_of(F.col(ts), slot_seconds)).alias("lo"),
                        F.max(slot_of(F.col(ts), slot_seconds)).alias("hi"))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(slot_seconds))
    days = bounds.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day"))
    days = days.repartition("day")
    day_start = F.greatest(F.col("day").cast("timestamp_ntz"), F.col("lo"))
    day_end = F.least(F.date_add("day", 1).cast("timestamp_ntz") - step, F.col("hi"))
    return days.select(F.explode(F.sequence(day_start, day_end, step)).alias("slot_start"))


def slot_counts(landed: DataFrame, ts: str, slot_seconds: int = 5, name: str = "n") -> DataFrame:
    """Rows per slot, slots without rows included with 0."""
    counts = (landed.groupBy(slot_of(F.col(ts), slot_seconds).alias("slot_start"))
              .agg(F.count(F.lit(1)).alias(name)))
    slots = all_slots(landed, ts, slot_seconds)
    return (slots.join(counts, "slot_start", "left")
            .select("slot_start", F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)))


def last_n_slots(counts: DataFrame, slot_seconds: int, n: int = 3, value: str = "n",
                 name: str = "n_window") -> DataFrame:
    """T5: per slot, the sum over it and the ``n - 1`` slots before it (the
    studied 15 s window over 5 s batches).

    Each slot row is copied to the ``n`` slots it contributes to and summed
    per target slot: a partial aggregate and one shuffle, no ordered window
    over one partition. Targets past the last slot are dropped.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(slot_seconds))
    last = counts.select(F.max("slot_start")).scalar()
    spread = counts.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"), "slot_start", value)
    target = F.col("slot_start") + step * F.col("k")
    return (spread.select(target.alias("slot_start"), value).where(F.col("slot_start") <= last)
            .groupBy("slot_start").agg(F.sum(value).cast("bigint").alias(name)))


def tokens_per_slot(landed: DataFrame, ts: str, text: str, slot_seconds: int = 5,
                    sep: str = " ") -> DataFrame:
    """T3 as in the studied program: word counts per batch slot, no state
    carried from one slot to the next."""
    gen, keep = explode_words(tokens(text, sep), "word")
    return (landed.select(slot_of(F.col(ts), slot_seconds).alias("slot_start"), gen).where(keep)
            .groupBy("slot_start", "word").agg(F.count(F.lit(1)).alias("count")))
