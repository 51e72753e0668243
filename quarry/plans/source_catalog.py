"""Registered queries of reading with rejects, lossless text and file layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout
from ..session import scratch_path
from ..sources import files, sinks, typed
from .catalog import _scratch_dir, query
from .tables import table

FILE_BYTES = 1 << 20  # target size of a part file of the layout key


def _broken_props(spark, d):
    """Every 7th record is cut off, every 11th holds text where a number belongs."""
    cut = F.col("props").substr(F.lit(1), F.length("props") - 1)
    props = F.when(F.col("event_id") % 7 == 0, cut).when(F.col("event_id") % 11 == 0, F.lit('{"k": "many"}')).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", props.alias("props"))


@query("json_rejects")
def q_json_rejects(spark, d):
    """S4 with rejects: every record, its value where it parses, its reason where it doesn't."""
    return files.parse_json_column(_broken_props(spark, d), "props", "k int", rejects=True).select(
        "event_id", F.col("props.k").alias("k"), F.col(files.REJECT).alias("reason"))


@query("src_rejects")
def q_src_rejects(spark, d):
    """Good rows and rejects by reason of a JSON-lines read, a CSV
    read and a typed projection. Every 10th price and every 15th customer is broken."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    raw = o.select("o_orderkey",
                   F.when(F.col("o_orderkey") % 15 == 0, F.lit("none")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
                   F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("x"), F.col("o_totalprice").cast("string")))
                   .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    csv, json = _scratch_dir(spark, "rejects-csv"), _scratch_dir(spark, "rejects-json")
    sinks.write_delimited(raw, csv)
    sinks.write_json_lines(raw, json)
    spec = {"o_custkey": (F.col("o_custkey"), "bigint"), "o_totalprice": (F.col("o_totalprice"), "double")}
    reads = {"csv": files.read_delimited(spark, csv, o.schema, header=True), "json": files.read_json_lines(spark, json, o.schema),
             "typed": typed.typed_projection(raw, spec, keep=["o_orderkey"])}
    counts = [typed.read_counts(df, name) for name, df in reads.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _awkward_text():
    """Texts that a delimited file could lose: the null mark itself, nothing, null, quotes, separators, line breaks, backslashes."""
    t, k = F.col("text"), F.col("doc_id") % 9
    return (F.when(k == 0, F.lit("\\N")).when(k == 1, F.lit("")).when(k == 2, F.lit(None).cast("string"))
            .when(k == 3, F.concat(F.lit('"'), t, F.lit('",\n\r\n\\n\\'))).when(k == 4, F.concat(F.lit("\\\\N\\"), t)).otherwise(t))


@query("src_escaped_roundtrip")
def q_src_escaped_roundtrip(spark, d):
    """Whole texts with line breaks and null marks through CSV, unchanged."""
    docs = table(spark, d, "documents").select("doc_id", _awkward_text().alias("text"), "source")
    path = _scratch_dir(spark, "documents-csv")
    sinks.write_delimited(docs, path, escaped=True)
    return typed.valid_rows(files.read_delimited(spark, path, docs.schema, header=True, escaped=True))


@query("partition_profile")
def q_partition_profile(spark, d):
    """K3: line items laid out by return flag in files of FILE_BYTES at most
    (by the bytes a row takes in the table's own files), and the profile of what was written."""
    li = table(spark, d, "lineitem")
    size = layout.row_bytes(li).first()  # one row
    path = scratch_path(spark, "layout", _scratch_dir(spark, "lineitem").rsplit("/", 1)[1])
    most = layout.write_sized(li, path, FILE_BYTES, size["bytes_per_row"] or 1.0, ("l_returnflag",))
    p = layout.file_profile(spark.read.parquet(path), "l_returnflag")
    full = F.ceil(F.col("rows") / most)
    return p.select("l_returnflag", "rows", (F.col("most_rows") <= most).alias("none_over"), (F.col("files") >= full).alias("enough_files"))


_ORDER = """SELECT o_orderkey % 15 = 0 AS c, o_orderkey % 10 = 0 AS p FROM orders"""

ORACLES = {
    "json_rejects": """
        SELECT event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
               CASE WHEN event_id % 7 = 0 THEN 'props: no JSON' WHEN event_id % 11 = 0 THEN 'props: bad value' END AS reason
        FROM events""",
    "src_rejects": f"""
        SELECT source, CASE WHEN c THEN 'bad o_custkey' WHEN p THEN 'bad o_totalprice' END AS reason, count(*) AS rows
        FROM ({_ORDER}) CROSS JOIN (VALUES ('csv'), ('json'), ('typed')) s(source) GROUP BY ALL""",
    "src_escaped_roundtrip": r"""
        SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN '\N' WHEN 1 THEN '' WHEN 2 THEN NULL
                            WHEN 3 THEN '"' || text || '",' || chr(10) || chr(13) || chr(10) || '\n\' WHEN 4 THEN '\\N\' || text ELSE text END AS text, source
        FROM documents""",
    "partition_profile": "SELECT l_returnflag, count(*) AS rows, true AS none_over, true AS enough_files FROM lineitem GROUP BY l_returnflag",
}
