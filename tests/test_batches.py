"""Per-batch metrics, state kept over restarts, the five-second cadence, clean-up."""

import datetime as dt
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from quarry import streaming as st
from quarry.operators import aggregates as agg
from quarry.session import remove_scratch

T0 = dt.datetime(2024, 1, 1)


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{name}")
    with open(hidden, "w") as f:
        f.write("".join(line + "\n" for line in lines))
    os.rename(hidden, os.path.join(folder, name))  # a file arrives whole


def _times(spark, seconds):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s),) for s in seconds], "ts timestamp")


def _windows(rows):
    return {(r.window_start - T0).total_seconds(): r["count"] for r in rows.collect()}


def test_windows_live_in_state_between_starts(spark):
    parts = [[1, 6, 7, 12], [12, 13, 19], [], [40, 41]]
    arriving, marks, landed = st.Folder(spark, "t-in", "ts timestamp"), st.Folder(spark, "t-marks", "ts timestamp"), st.Landing(spark, "t-win")
    counts = st.window_counts(arriving.stream(), marks.stream(), "ts", "15 seconds", "5 seconds")
    seen = []
    for p in parts:
        arriving.arrive(_times(spark, p))
        seen.append(set(_windows(landed.run(counts).rows())))
    assert seen[0] == {-10.0, -5.0} and seen[1] > seen[0] and 10.0 not in seen[1]  # windows still open are in no result
    landed.run(counts)  # nothing new: nothing changes
    assert set(_windows(landed.rows())) == seen[-1]
    everything = _times(spark, sum(parts, []))
    marks.arrive(st.closing_mark(everything, "ts", "15 seconds"))
    got = _windows(landed.run(counts).rows())
    want = _windows(st.sliding_counts(everything, "ts", "15 seconds", "5 seconds"))
    assert got == want and landed.rows().count() == len(want)  # each window once


def test_a_delay_keeps_late_rows(spark):
    for delay, kept in (("0 seconds", 3), ("1 minute", 4)):
        arriving, marks, landed = st.Folder(spark, "t-in", "ts timestamp"), st.Folder(spark, "t-marks", "ts timestamp"), st.Landing(spark, "t-late")
        counts = st.window_counts(arriving.stream(), marks.stream(), "ts", "5 seconds", "5 seconds", delay)
        for p in ([1, 30], [2], [31]):
            arriving.arrive(_times(spark, p))
            landed.run(counts)
        marks.arrive(st.closing_mark(_times(spark, [31]), "ts", "5 seconds", delay))
        assert sum(_windows(landed.run(counts).rows()).values()) == kept  # the row at 2 s comes after the watermark passed 30 s


def test_no_rows_no_mark(spark):
    assert st.closing_mark(_times(spark, []), "ts", "15 seconds").count() == 0
    arriving, marks, landed = st.Folder(spark, "t-in", "ts timestamp"), st.Folder(spark, "t-marks", "ts timestamp"), st.Landing(spark, "t-none")
    assert landed.run(st.window_counts(arriving.stream(), marks.stream(), "ts", "15 seconds", "5 seconds")).rows().count() == 0


def test_one_metric_row_per_batch_and_zeros(spark):
    sizes = [3, 0, 5, 1]
    arriving, landed = st.Folder(spark, "t-in", "v int"), st.Landing(spark, "t-metrics")
    for n in sizes:
        arriving.arrive(spark.range(n).select(F.col("id").cast("int").alias("v")))
        landed.run(st.batch_counts(arriving.stream(), extra={"top": F.max("v")}))
    rows = st.numbered(landed.rows()).orderBy("batch").collect()
    assert [r.n for r in rows] == sizes and [r.top for r in rows] == [2, None, 4, 0] and [r.batch for r in rows] == [0, 1, 2, 3]
    landed.run(st.batch_counts(arriving.stream(), extra={"top": F.max("v")}))  # a start without new files: one more batch, of 0
    assert [r.n for r in st.numbered(landed.rows()).orderBy("batch").collect()] == [*sizes, 0]


def test_several_batches_of_one_run(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    for k, n in enumerate([2, 4, 1]):
        _drop(root, f"{k}.txt", [f"w{k} w x"] * n)
    landed = st.Landing(spark, "t-files").run(st.batch_counts(st.text_stream(spark, root, max_files_per_trigger=1), zeros=False))
    assert sorted(r.n for r in landed.rows().collect()) == [1, 2, 4]
    words = st.Landing(spark, "t-words").run(st.batch_word_counts(st.text_stream(spark, root, max_files_per_trigger=1)))
    deltas = st.numbered(words.rows().select("arrival").distinct()).join(words.rows(), "arrival")
    assert deltas.select("batch").distinct().count() == 3 and deltas.count() == 9
    want = {r.word: r["count"] for r in agg.word_count(spark.read.text(root), "value", " ").collect()}
    assert {r.word: r["count"] for r in st.merged_word_counts(words.rows()).collect()} == want
    first = words.rows().agg(F.min("arrival")).first()[0]
    upto = {r.word: r["count"] for r in st.merged_word_counts(words.rows(), F.lit(first)).collect()}
    assert sum(upto.values()) < sum(want.values()) and upto["w"] in (1, 2, 4)


def test_a_repeated_batch_lands_once(spark):
    """The run ends after a batch's rows are written but before it is committed: it is repeated and counts once."""
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    _drop(root, "a.txt", ["x y", "x"])
    landed = st.Landing(spark, "t-repeat")
    landed.run(st.batch_word_counts(st.text_stream(spark, root)))
    before = sorted(map(tuple, landed.rows().collect()))
    commits = f"{landed.checkpoint}/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (f"{last}", f".{last}.crc"):
        os.unlink(os.path.join(commits, f))
    landed.run(st.batch_word_counts(st.text_stream(spark, root)))
    assert sorted(map(tuple, landed.rows().collect())) == before
    _drop(root, "b.txt", ["x z"])
    landed.run(st.batch_word_counts(st.text_stream(spark, root)))
    assert {r.word: r["count"] for r in st.merged_word_counts(landed.rows()).collect()} == {"x": 3, "y": 1, "z": 1}


def _wait(check, seconds=90):
    end = time.time() + seconds
    while not check():
        assert time.time() < end
        time.sleep(0.2)


def test_cadence_stop_and_resume(spark):
    """Files arrive while a five-second query runs; it is stopped in the middle and started again from its checkpoint."""
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    _drop(root, "0.txt", ["a", "b", "c"])
    landed, five = st.Landing(spark, "t-cadence"), {"processingTime": "5 seconds"}
    counts = lambda: st.batch_counts(st.text_stream(spark, root, max_files_per_trigger=1))
    q = landed.start(counts(), five)
    _wait(lambda: q.lastProgress is not None and q.lastProgress["batchId"] >= 1)
    _drop(root, "1.txt", ["d"])
    _drop(root, "2.txt", ["e", "f"])
    seen = q.lastProgress["batchId"]
    _wait(lambda: q.lastProgress["batchId"] >= seen + 2)
    q.stop()
    _drop(root, "3.txt", ["g"] * 4)  # arrives while nothing runs
    q = landed.start(counts(), five)
    _wait(lambda: landed.rows().agg(F.sum("n")).first()[0] == 10)
    q.stop()
    rows = landed.rows().orderBy("arrival").collect()
    assert sorted(r.n for r in rows if r.n) == [1, 2, 3, 4]  # every row in one batch
    assert any(r.n == 0 for r in rows)  # triggers without a file are metric rows too
    gaps = [(b.arrival - a.arrival).total_seconds() for a, b in zip(rows, rows[1:])]
    assert sum(4 <= g <= 6 for g in gaps) >= 1  # the cadence


def test_remove(spark):
    arriving, landed = st.Folder(spark, "t-in", "v int"), st.Landing(spark, "t-gone")
    landed.run(st.batch_counts(arriving.stream()))
    assert os.path.isdir(landed.path)
    landed.remove()
    landed.remove()  # gone already: fine
    assert not os.path.exists(landed.root)
    for path in ("/root/testdata/sf0.001", f"{landed.root}/../../../x"):
        with pytest.raises(ValueError):
            remove_scratch(spark, path)
