"""Streaming: files dropped in order, availableNow, restart from the
checkpoint, equality with batch, and the recorded slot metrics (FIXTURES 4)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from quarry import streaming as st
from quarry.operators import aggregates as agg

# Recorded stream output (FIXTURES 4, T2/T5): lines per 5 s batch and the
# 15 s window size after each batch.
RECORDED_BATCHES = [0, 3, 3, 1, 5, 3, 2, 5, 5, 4, 3, 4, 3, 3, 4, 2, 5, 3]
RECORDED_WINDOWS = [0, 3, 6, 7, 9, 9, 10, 10, 12, 14, 12, 11, 10, 10, 10, 9, 11, 10]


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(line + "\n" for line in lines))


def test_recorded_slot_counts_and_last_three(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = []
    for b, n in enumerate(RECORDED_BATCHES):
        rows += [(t0 + dt.timedelta(seconds=5 * b, milliseconds=10 * i), f"line {b} {i}") for i in range(n)]
    # the first batch is empty: pin the start with a zero-count slot source
    landed = spark.createDataFrame(rows, "arrival timestamp_ntz, value string")
    counts = st.slot_counts(landed, "arrival", 5, "n")
    got = [r.n for r in counts.orderBy("slot_start").collect()]
    assert got == RECORDED_BATCHES[1:]  # slots start at the first arrival
    win = st.last_n_slots(counts, 5, 3, "n", "n_window")
    got_w = [r.n_window for r in win.orderBy("slot_start").collect()]
    assert got_w == RECORDED_WINDOWS[1:]


def test_slot_counts_fill_zero_slots(spark):
    t0 = dt.datetime(2024, 1, 1, 23, 59, 50)
    rows = [(t0,), (t0 + dt.timedelta(seconds=20),)]  # crosses midnight, 3 empty slots between
    landed = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [(r.slot_start, r.n) for r in st.slot_counts(landed, "ts", 5).orderBy("slot_start").collect()]
    assert [n for _, n in got] == [1, 0, 0, 0, 1]
    assert got[2][0] == dt.datetime(2024, 1, 2, 0, 0, 0)


def test_landing_is_exactly_once_and_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    _drop(src, "a.txt", ["the cat", "the dog", ""])
    _drop(src, "b.txt", ["a b c", "   "])
    stream = st.with_arrival(st.text_stream(spark, src, max_files_per_trigger=1))
    q = st.start_sink(stream, out, ckpt, trigger={"availableNow": True})
    q.awaitTermination(120)
    assert q.exception() is None
    landed = spark.read.parquet(out)
    assert landed.count() == 5
    assert landed.select("arrival").distinct().count() == 2  # one arrival time per micro-batch
    # restart on the same checkpoint: nothing is read twice
    q2 = st.start_sink(st.with_arrival(st.text_stream(spark, src)), out, ckpt, trigger={"availableNow": True})
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 5
    # a new file is picked up on the next run
    _drop(src, "c.txt", ["the end"])
    q3 = st.start_sink(st.with_arrival(st.text_stream(spark, src)), out, ckpt, trigger={"availableNow": True})
    q3.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 6
    words = {r.word: r["count"] for r in agg.word_count(landed, "value", " ").collect()}
    assert words["the"] == 3 and words[""] == 1  # the empty line is one empty token; "   " none
    per_batch = st.tokens_per_slot(landed, "arrival", "value", 5)
    assert per_batch.agg(F.sum("count")).first()[0] == sum(words.values())


def test_running_word_count_is_stateful(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    src = f"{root}/in"
    _drop(src, "a.txt", ["x y", "x"])
    counts = st.running_word_count(st.text_stream(spark, src, max_files_per_trigger=1))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("quarry_wc")
         .option("checkpointLocation", f"{root}/ckpt").start())
    q.processAllAvailable()
    _drop(src, "b.txt", ["x z"])
    q.processAllAvailable()
    got = {r.word: r["count"] for r in spark.sql("SELECT * FROM quarry_wc").collect()}
    q.stop()
    assert got == {"x": 3, "y": 1, "z": 1}


def test_sliding_counts_append_with_watermark(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    src = f"{root}/in"
    os.makedirs(src)
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=s),) for s in (1, 6, 7, 12, 40)], "ts timestamp_ntz")
    df.coalesce(1).write.mode("overwrite").parquet(f"{src}/part")
    stream = st.event_time(st.file_stream(spark, f"{src}/part", df.schema), "ts")
    counts = st.sliding_counts(stream, "ts", "15 seconds", "5 seconds", watermark="0 seconds")
    out = st.run_available(spark, counts, "sliding-test")
    got = {(r.window_start - t0).total_seconds(): r["count"] for r in out.collect()}
    # the watermark ends at 40 s: windows ending at or before it are final
    assert got[0.0] == 4 and got[5.0] == 3 and got[-10.0] == 1 and got[10.0] == 1
    assert max(got) + 15 <= 40  # no window still open at the end was emitted
    assert 25.0 not in got and 30.0 not in got


def test_table_folders_stream_in_full(spark):
    """A table stored as a folder of part files gives the same rows as one file."""
    from quarry.plans.registry import all_queries
    from quarry.plans.tables import table
    small, root = "/root/testdata/sf0.001", tempfile.mkdtemp(prefix="quarry-stream-")
    for t in ("events", "documents"):
        table(spark, small, t).repartition(3).write.parquet(f"{root}/{t}.parquet")
    for key in ("stream_batch_count", "stream_sliding_count", "stream_word_count", "stream_tokens_per_slot"):
        q = all_queries()[key]
        one, parts = q(spark, small), q(spark, root)
        assert one.count() > 0 and sorted(map(str, one.collect())) == sorted(map(str, parts.collect())), key
