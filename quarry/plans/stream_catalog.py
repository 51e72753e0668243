"""Registered streaming queries.

Each runs a real Structured Streaming query over the driver's table files
(file source, ``availableNow`` trigger, Parquet sink with a checkpoint in
the shared folder) and returns the landed result as a batch frame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import batches, landing, sources, windows
from .catalog import query
from .tables import table

SLOT_SECONDS = 300  # events are sparse (days of data): 5-minute slots
WINDOW, SLIDE = "15 minutes", "5 minutes"
ARRIVALS = 3  # parts that a table arrives in, one start of the stream each


def _stream_of(spark, d, name, cols, most=None):
    """A table's files as a stream, whether the table is one file or a folder
    of part files. ``most``: cut a folder's files into that many
    micro-batches at most (a fixed cap of files would mean thousands of tiny
    batches over a large folder); otherwise ``availableNow`` takes all at once."""
    t = table(spark, d, name)
    per_batch = -(-len(t.inputFiles()) // most) if most else None
    # a pattern that only this name fits: Spark lists what it finds there, a file or a folder's files
    s = sources.file_stream(spark, f"{d.rstrip('/')}/{name}.parque[t]", t.schema, max_files_per_trigger=per_batch or None)
    return s.select(*cols)


def _landed_events(spark, d):
    return landing.run_available(spark, _stream_of(spark, d, "events", ["ts"]), "events")


@query("stream_sliding_count")
def q_stream_sliding_count(spark, d):
    """Final windows from the stream's state. The events arrive in ARRIVALS
    parts in time order, each taken by a new start on the same checkpoint, so
    windows over two parts live in state between them; a closing mark then
    moves the watermark behind the last window, and the open ones land too."""
    rows = windows.event_time(table(spark, d, "events").select("ts"), "ts").where(F.col("ts").isNotNull())
    ends = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    lo, span = F.unix_micros(F.col("lo")), F.unix_micros(F.col("hi")) - F.unix_micros(F.col("lo")) + 1
    part = F.floor((F.unix_micros("ts") - lo) / span * ARRIVALS)
    dealt = rows.join(F.broadcast(ends), how="cross").select("ts", part.alias("part"))  # one row of bounds
    arriving, marks, landed = (batches.Folder(spark, "sliding-in", "ts timestamp"), batches.Folder(spark, "sliding-marks", "ts timestamp"),
                               batches.Landing(spark, "sliding"))
    counts = batches.window_counts(arriving.stream(), marks.stream(), "ts", WINDOW, SLIDE)
    for k in range(ARRIVALS):
        arriving.arrive(dealt.where(F.col("part") == k).select("ts"))
        landed.run(counts)
    marks.arrive(batches.closing_mark(rows, "ts", WINDOW))
    return landed.run(counts).rows()


@query("stream_tokens_per_slot")
def q_stream_tokens_per_slot(spark, d):
    """T3 as studied: word counts per slot, nothing carried from slot to slot."""
    landed = landing.run_available(spark, _stream_of(spark, d, "events", ["ts", "event_type"]), "tokens")
    return windows.tokens_per_slot(landed, "ts", "event_type", SLOT_SECONDS)


@query("stream_batch_count")
def q_stream_batch_count(spark, d):
    return windows.slot_counts(_landed_events(spark, d), "ts", SLOT_SECONDS, "n")


@query("stream_arrival_count")
def q_stream_arrival_count(spark, d):
    """The metric row of each micro-batch, landed by the stream itself.
    Events arrive in ARRIVALS parts (by id) and one part without rows, each
    taken by a new start on the same checkpoint; the empty batch gives 0."""
    rows = table(spark, d, "events").select("event_id")
    arriving, landed = batches.Folder(spark, "arrivals-in", rows.schema), batches.Landing(spark, "arrivals")
    for k in range(ARRIVALS + 1):  # no id leaves the remainder ARRIVALS: the last part is empty
        arriving.arrive(rows.where(F.coalesce(F.pmod("event_id", F.lit(ARRIVALS)), F.lit(0)) == k))
        landed.run(batches.batch_counts(arriving.stream()))
    return batches.numbered(landed.rows()).select("batch", "n")


@query("stream_batch_words")
def q_stream_batch_words(spark, d):
    """T3 as studied: the words of each micro-batch, nothing carried over. The
    turns of conversations arrive in ARRIVALS parts (by conversation)."""
    rows = table(spark, d, "conversations").select("conv_id", "text")
    arriving, landed = batches.Folder(spark, "turns-in", "text string"), batches.Landing(spark, "turns")
    for k in range(ARRIVALS):
        arriving.arrive(rows.where(F.coalesce(F.pmod("conv_id", F.lit(ARRIVALS)), F.lit(0)) == k).select("text"))
        landed.run(batches.batch_word_counts(arriving.stream(), "text"))
    deltas = landed.rows()
    numbers = batches.numbered(deltas.select("arrival").distinct())
    return deltas.join(numbers, "arrival").select("batch", "word", "count")


@query("stream_last_slots")
def q_stream_last_slots(spark, d):
    counts = windows.slot_counts(_landed_events(spark, d), "ts", SLOT_SECONDS, "n")
    return windows.last_n_slots(counts, SLOT_SECONDS, 3, "n", "n_window")


@query("stream_word_count")
def q_stream_word_count(spark, d):
    """T3 running total: per-batch counts land, totals are added up on read (the text itself is never landed)."""
    stream = _stream_of(spark, d, "documents", ["text"], most=ARRIVALS)
    return batches.merged_word_counts(batches.Landing(spark, "words").run(batches.batch_word_counts(stream, "text")).rows())


_SLOTS = """
    c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot_start, count(*) AS n FROM events GROUP BY 1),
    s AS (SELECT unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 5 MINUTE)) AS slot_start
          FROM c),
    z AS (SELECT s.slot_start, coalesce(c.n, 0) AS n FROM s LEFT JOIN c ON s.slot_start = c.slot_start)"""

ORACLES: dict[str, str] = {
    "stream_sliding_count": """
        WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - unnest([0, 1, 2]) * INTERVAL 5 MINUTE
                          AS window_start
                   FROM events)
        SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, count(*) AS count
        FROM w GROUP BY window_start""",
    "stream_tokens_per_slot": """
        SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot_start, event_type AS word, count(*) AS count
        FROM events GROUP BY 1, 2""",
    "stream_arrival_count": f"""
        SELECT batch, count(event_id) AS n
        FROM range({ARRIVALS} + 1) b(batch) LEFT JOIN events ON event_id % {ARRIVALS} = batch GROUP BY batch""",
    "stream_batch_words": f"""
        SELECT batch, word, count(*) AS count
        FROM (SELECT conv_id % {ARRIVALS} AS batch,
                     unnest(CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []::VARCHAR[]
                                 ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM conversations)
        GROUP BY batch, word""",
    "stream_batch_count": f"WITH {_SLOTS} SELECT slot_start, n FROM z",
    "stream_last_slots": f"""
        WITH {_SLOTS}
        SELECT slot_start, CAST(sum(n) OVER (ORDER BY slot_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                                AS BIGINT) AS n_window
        FROM z""",
    "stream_word_count": """
        SELECT word, count(*) AS count
        FROM (SELECT unnest(CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []::VARCHAR[]
                                 ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents)
        GROUP BY word""",
}
