"""Delimited text that keeps every value, and JSON records with reject reasons."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry import sources

NASTY = ["\\N", "\\\\N", "", None, " ", "a\nb", "a\r\nb", "\\n", "\\\\n", "\\\n", "\\", "\\\\", '"', '""', 'a,"b"\n', ";", "\t x ", "é😀\r", "\\r\\n\n\\", "null", "#c"]


@pytest.mark.parametrize("sep,header", [(",", True), (";", False), ("|", False)])
def test_every_value_survives(spark, tmp_out, sep, header):
    df = spark.createDataFrame([(i, v, v, float(i) if i % 2 else None) for i, v in enumerate(NASTY)], "id int, a string, b string, x double").repartition(3)
    sources.write_delimited(df, f"{tmp_out}/{ord(sep)}", sep=sep, header=header, escaped=True)
    back = sources.read_delimited(spark, f"{tmp_out}/{ord(sep)}", df.schema, sep=sep, header=header, escaped=True)
    assert sources.reject_rows(back).count() == 0
    assert sorted(map(tuple, sources.valid_rows(back).collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("value", ["\\N", "a\nb", "a\rb"])
def test_plain_files_refuse_what_they_would_lose(spark, tmp_out, value):
    df = spark.createDataFrame([("fine",), (value,)], "a string")
    with pytest.raises(Exception, match="null mark as text in column a|line break in column a"):
        sources.write_delimited(df, f"{tmp_out}/x")
    assert spark.createDataFrame([("\\Nx",), ("x\\N",), ("\\\\server",)], "a string").transform(
        lambda d: (sources.write_delimited(d, f"{tmp_out}/y"), sources.read_delimited(spark, f"{tmp_out}/y", d.schema, header=True))[1]).where("a like '%\\\\\\\\%'").count() == 3


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="\\Nnr\n\r\"x, ", max_size=8), min_size=1, max_size=40))
def test_escape_and_back(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", sources.escape_text(F.col("v")).alias("e")).select("v", "e", sources.unescape_text(F.col("e")).alias("b")).collect()
    assert all(r.b == r.v and "\n" not in r.e and "\r" not in r.e and r.e != "\\N" for r in out)


def test_json_records_with_reasons(spark):
    rows = [(1, '{"k": 1, "s": "x"}'), (2, "{'k': 2}"), (3, '{"k": "many", "s": "kept"}'), (4, '{"k": 4'), (5, "text"), (6, None), (7, "{}"), (8, ""), (9, '{"k": 3.5}')]
    df = spark.createDataFrame(rows, "id int, p string")
    got = {r.id: r for r in sources.parse_json_column(df, "p", "k int, s string", "v", rejects=True).collect()}
    reasons = {i: r[sources.REJECT] for i, r in got.items()}
    assert reasons[1] is None and reasons[6] is None and reasons[7] is None
    assert reasons[3] == "p: bad value" and reasons[4] == "p: no JSON" and reasons[5] == "p: no JSON"
    assert got[1].v.k == 1 and got[3].v.k is None and got[3].v.s == "kept" and got[6].v is None
    assert reasons[2] is None and got[2].v.k == 2  # single quotes
    assert sources.parse_json_column(df, "p", "k int", rejects=False).columns == ["id", "p"]
    prior = df.withColumn(sources.REJECT, F.when(F.col("id") == 3, "earlier"))
    again = {r.id: r[sources.REJECT] for r in sources.parse_json_column(prior, "p", "k int", rejects=True).collect()}
    assert again[3] == "earlier" and again[4] == "p: no JSON"
    counts = {r.reason: r.rows for r in sources.read_counts(sources.parse_json_column(df, "p", "k int, s string", rejects=True), "j").collect()}
    assert sum(counts.values()) == 9 and counts["p: bad value"] >= 1
