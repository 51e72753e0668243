"""Registered queries: SURVEY 2 operators applied to the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Every computed column carries an alias that the matching oracle SQL
(``oracles.py``) uses too; float results are rounded to 6 places so that two
engines' summation orders cannot tell them apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as qf
from ..operators import aggregates as agg
from ..operators import filters as flt
from ..operators import joins as jn
from ..operators import sets
from ..session import scratch_path
from ..sources import files, sinks, typed
from . import reports
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# --- 2.1 sources -----------------------------------------------------------

# Order status code -> name (a small lookup held in the program).
ORDER_STATUS_NAMES = [("F", "finished"), ("O", "open"), ("P", "partial")]


@query("src_inline")
def q_src_inline(spark, d):
    status = files.inline_frame(spark, ORDER_STATUS_NAMES, "code string, status_name string")
    orders = table(spark, d, "orders").select("o_orderstatus")
    enriched = jn.lookup(orders, status, "o_orderstatus", "code", fixed_size=True)
    return agg.group_count(enriched, "status_name")


@query("json_props")
def q_json_props(spark, d):
    ev = table(spark, d, "events").select("event_id", "props")
    return (files.parse_json_column(ev, "props", "k int")
            .select("event_id", F.col("props.k").alias("k")))


@query("typed_projection")
def q_typed_projection(spark, d):
    o = table(spark, d, "orders")
    spec = {
        "price": (F.col("o_totalprice").cast("string"), "double"),
        "priority": (F.substring("o_orderpriority", 1, 1), "int"),
    }
    return typed.valid_rows(typed.typed_projection(o, spec, keep=["o_orderkey", "o_orderstatus"]))


@query("sql_filter")
def q_sql_filter(spark, d):
    files.register_view(table(spark, d, "part"), "quarry_part")
    return files.run_sql(spark, "SELECT * FROM quarry_part WHERE p_size > :size", {"size": 40})


def _scratch_dir(spark, label):
    """A fresh folder below the shared checkpoint root for a round trip."""
    return scratch_path(spark, "roundtrip", f"{label}-{uuid.uuid4().hex[:12]}")


@query("src_csv_roundtrip")
def q_src_csv_roundtrip(spark, d):
    """S5 + S10: a table written as CSV with a header (one header per part
    file, fails if the folder exists), read back with its declared schema."""
    cust = table(spark, d, "customer")
    path = _scratch_dir(spark, "customer-csv")
    sinks.write_delimited(cust, path, sep=",", header=True)
    return typed.valid_rows(files.read_delimited(spark, path, cust.schema, sep=",", header=True))


@query("src_semicolon_roundtrip")
def q_src_semicolon_roundtrip(spark, d):
    """The same with ``;`` and no header (S7's form)."""
    sup = table(spark, d, "supplier")
    path = _scratch_dir(spark, "supplier-ssv")
    sinks.write_delimited(sup, path, sep=";", header=False)
    return typed.valid_rows(files.read_delimited(spark, path, sup.schema, sep=";", header=False))


@query("src_json_roundtrip")
def q_src_json_roundtrip(spark, d):
    """S3: JSON lines with a declared schema."""
    o = table(spark, d, "orders")
    path = _scratch_dir(spark, "orders-json")
    sinks.write_json_lines(o, path)
    return typed.valid_rows(files.read_json_lines(spark, path, o.schema))


@query("src_text_lines")
def q_src_text_lines(spark, d):
    """S1 + P6 + F3: text lines of part files that each start with the same
    header; every header copy is dropped, fields are split out."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    path = _scratch_dir(spark, "part-text")
    sinks.write_delimited(part, path, sep="|", header=True)  # one header per part file
    lines = flt.drop_header(files.read_lines(spark, path), "value", "p_partkey|p_name")
    return lines.select(qf.field("value", "|", 0).cast("bigint").alias("p_partkey"),
                        qf.field("value", "|", 1).alias("p_name"))


# --- 2.2 projections and filters ------------------------------------------

@query("select_cols")
def q_select_cols(spark, d):
    return flt.select_columns(table(spark, d, "customer"), "c_name", "c_acctbal")


@query("filter_eq")
def q_filter_eq(spark, d):
    # p_size is typed here, so the comparison is pushed to the scan as EqualTo
    return flt.where_equals(table(spark, d, "part"), "p_size", 40)


@query("filter_eq_text")
def q_filter_eq_text(spark, d):
    """P3 on text: the number in front of the priority's name, compared with a number."""
    o = table(spark, d, "orders").select("o_orderkey", qf.field("o_orderpriority", "-", 0).alias("priority"))
    return flt.where_equals(o, "priority", 2, cast="int")


@query("filter_range")
def q_filter_range(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return flt.where_range(li, "l_quantity", low=30)


@query("filter_contains")
def q_filter_contains(spark, d):
    return flt.where_contains(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "ring")


@query("filter_not_contains")
def q_filter_not_contains(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return flt.where_not_contains(part, "p_name", "ring")


@query("filter_prefix")
def q_filter_prefix(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return flt.drop_prefixed(part, "p_brand", ["Brand#1", "Brand#2"])


# --- 2.3 scalar functions --------------------------------------------------

@query("fn_upper")
def q_fn_upper(spark, d):
    return table(spark, d, "part").select("p_partkey", qf.upper("p_name").alias("name_upper"))


@query("fn_replace")
def q_fn_replace(spark, d):
    return table(spark, d, "part").select("p_partkey", qf.replace_all("p_name", " ", "\t").alias("name_tab"))


@query("fn_split_field")
def q_fn_split_field(spark, d):
    return table(spark, d, "part").select("p_partkey", qf.field("p_name", " ", 1).alias("word2"))


@query("fn_concat")
def q_fn_concat(spark, d):
    return table(spark, d, "part").select("p_partkey",
                                          qf.join_fields(["p_type", "p_brand"], ",").alias("type_brand"))


@query("cleanse_fields")
def q_cleanse_fields(spark, d):
    part = table(spark, d, "part")
    line = qf.join_fields(["p_brand", qf.recode_full_match("p_type", "ECONOMY", "2", "4"),
                           qf.upper("p_name")], ",")
    return part.select("p_partkey", line.alias("line"))


@query("recode_binary")
def q_recode_binary(spark, d):
    part = table(spark, d, "part")
    return part.select("p_partkey", qf.recode_contains("p_name", "ring").alias("name_code"),
                       qf.recode_contains("p_type", "ECONOMY").alias("type_code"))


# Order status code -> number; other codes fall through to a cast.
STATUS_CODES = {"F": 1.0, "O": 2.0}


@query("recode_map")
def q_recode_map(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", qf.recode_map("o_orderstatus", STATUS_CODES).alias("status_code"))


# The market segments of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("indicators")
def q_indicators(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", *qf.indicators("c_mktsegment", SEGMENTS, prefix="seg_"))


@query("parse_int_or_zero")
def q_parse_int_or_zero(spark, d):
    o = table(spark, d, "orders")
    v = qf.parse_int_or_zero("o_orderpriority", fallback=qf.field("o_orderpriority", "-", 0))
    return o.select("o_orderkey", v.alias("priority_num"))


@query("parse_float_or_zero")
def q_parse_float_or_zero(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        # plain decimal text: a double prints as 1.2E7 from ten million on, which is no number to the test
        qf.parse_float_or_zero(F.col("o_totalprice").cast("decimal(30,8)").cast("string")).alias("price_parsed"),
        qf.parse_float_or_zero("o_orderpriority",
                               fallback=qf.field("o_orderpriority", "-", 0)).alias("priority_parsed"))


@query("impute_constant")
def q_impute_constant(spark, d):
    ev = table(spark, d, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("?")).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", qf.impute_sentinel(raw, "?", 80.0).alias("value_imputed"))


@query("bucket_round")
def q_bucket_round(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", qf.round_half_up("c_acctbal", 10).alias("bal_bucket"))


@query("cap_value")
def q_cap_value(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", qf.cap("l_quantity", 40.0).alias("qty_capped"))


@query("ratio_pct")
def q_ratio_pct(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", r6(qf.ratio_pct("l_tax", "l_discount")).alias("tax_pct"))


@query("row_mean_abs")
def q_row_mean_abs(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     r6(qf.row_mean_abs(["l_quantity", "l_discount", "l_tax"])).alias("mean_abs"))


@query("label_threshold")
def q_label_threshold(spark, d):
    li = table(spark, d, "lineitem")
    mean = jn.scalar(li, F.avg("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", qf.label_threshold(F.col("l_quantity"), mean).alias("label"))


@query("explode_tokens")
def q_explode_tokens(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return qf.explode_tokens(part, "p_name", " ").select("p_partkey", "token")


# --- 2.4 joins ---------------------------------------------------------------

@query("join_inner")
def q_join_inner(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return jn.join_on(c, n, "c_nationkey", "n_nationkey")


@query("lookup_enrich")
def q_lookup_enrich(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    step1 = jn.lookup(c, n, "c_nationkey", "n_nationkey")
    return jn.lookup(step1, r, "n_regionkey", "r_regionkey").select("c_custkey", "n_name", "r_name")


@query("lookup_unmatched")
def q_lookup_unmatched(spark, d):
    """The rows an inner lookup loses, counted: orders whose customer is not in the looked-up segment."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus")
    cust = flt.where_equals(table(spark, d, "customer"), "c_mktsegment", "BUILDING")
    return agg.group_count(jn.unmatched(orders, cust, "o_custkey", "c_custkey"), "o_orderstatus")


@query("join_reattach")
def q_join_reattach(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    lab = table(spark, d, "labels").select(F.col("doc_id").alias("label_doc_id"), "quality")
    return jn.join_on(docs, lab, "doc_id", "label_doc_id").drop("label_doc_id")


@query("filter_join_agg")
def q_filter_join_agg(spark, d):
    li = flt.where_range(table(spark, d, "lineitem"), "l_quantity", low=30)
    # partial aggregate per part before the join: the join sees one row per part
    per_part = li.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("s"),
                                           F.count(F.lit(1)).alias("n"),
                                           F.max("l_extendedprice").alias("m"))
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    j = jn.join_on(per_part, part, "l_partkey", "p_partkey")
    return (j.groupBy("p_brand")
            .agg(r6(F.sum("s") / F.sum("n")).alias("avg_price"), F.max("m").alias("max_price")))


@query("scalar_broadcast")
def q_scalar_broadcast(spark, d):
    li = table(spark, d, "lineitem")
    mean = jn.scalar(li, F.avg("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", r6(F.col("l_quantity") - mean).alias("qty_dev"))


# --- 2.5 aggregations ---------------------------------------------------------

@query("agg_count")
def q_agg_count(spark, d):
    return agg.count_rows(table(spark, d, "lineitem"))


@query("agg_sum")
def q_agg_sum(spark, d):
    li = table(spark, d, "lineitem")
    exact = F.col("l_extendedprice").cast("decimal(18,2)")
    return agg.total(li, exact).select(F.col("total").cast("double").alias("total"))


@query("agg_argmin")
def q_agg_argmin(spark, d):
    return agg.shortest(table(spark, d, "documents"), "text")


@query("agg_int_avg")
def q_agg_int_avg(spark, d):
    return agg.int_avg(table(spark, d, "lineitem"), F.col("l_quantity").cast("bigint"))


@query("agg_parsed_avg")
def q_agg_parsed_avg(spark, d):
    o = table(spark, d, "orders")
    v = qf.parse_float(qf.field("o_orderpriority", "-", 0))
    return agg.parsed_avg(o, v).select(r6(F.col("avg")).alias("avg"))


@query("agg_by_key")
def q_agg_by_key(spark, d):
    return agg.int_avg_by_key(table(spark, d, "lineitem"), "l_returnflag",
                              F.col("l_quantity").cast("bigint"))


@query("group_count")
def q_group_count(spark, d):
    return agg.group_count(table(spark, d, "orders"), "o_orderstatus")


@query("group_avg_max")
def q_group_avg_max(spark, d):
    g = agg.group_avg_max(table(spark, d, "customer"), ["c_mktsegment"], "c_acctbal",
                          avg_name="avg_bal", max_name="max_bal")
    return g.withColumn("avg_bal", r6(F.col("avg_bal")))


@query("rate_by_one")
def q_rate_by_one(spark, d):
    return reports.segment_rates(table(spark, d, "lineitem"), table(spark, d, "orders"),
                                 table(spark, d, "customer")).orderBy("c_mktsegment")


@query("rate_by_two")
def q_rate_by_two(spark, d):
    return (reports.segment_rates(table(spark, d, "lineitem"), table(spark, d, "orders"),
                                  table(spark, d, "customer"), order_keys=["o_orderpriority"])
            .orderBy("c_mktsegment", "o_orderpriority"))


@query("rate_by_numeric")
def q_rate_by_numeric(spark, d):
    li = table(spark, d, "lineitem")
    return agg.rate_report(li, ["l_discount"], F.col("l_returnflag") == "R").orderBy("l_discount")


@query("sql_group_max")
def q_sql_group_max(spark, d):
    files.register_view(table(spark, d, "part"), "quarry_part")
    return files.run_sql(spark, "SELECT p_type, max(p_size) AS max_size FROM quarry_part "
                                "GROUP BY p_type ORDER BY 2")


@query("sql_group_avg")
def q_sql_group_avg(spark, d):
    files.register_view(table(spark, d, "lineitem"), "quarry_lineitem")
    return files.run_sql(spark, "SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_qty "
                                "FROM quarry_lineitem GROUP BY l_returnflag")


@query("distinct_values")
def q_distinct_values(spark, d):
    return agg.distinct_values(table(spark, d, "events"), "event_type")


@query("conditional_counts")
def q_conditional_counts(spark, d):
    li = table(spark, d, "lineitem")
    return agg.conditional_counts(li, {"n_r": F.col("l_returnflag") == "R",
                                       "n_a": F.col("l_returnflag") == "A"})


@query("count_above_avg")
def q_count_above_avg(spark, d):
    return agg.count_above_mean(table(spark, d, "lineitem"), "l_quantity")


@query("agg_moments")
def q_agg_moments(spark, d):
    m = agg.moments(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


@query("corr_with_label")
def q_corr_with_label(spark, d):
    li = table(spark, d, "lineitem")
    c = agg.corr_with_label(li, "l_extendedprice",
                            ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    return c.withColumn("corr", r6(F.col("corr")))


@query("word_count")
def q_word_count(spark, d):
    return agg.word_count(table(spark, d, "documents").select("text"), "text", " ")


def _rule_predictions(spark, d) -> DataFrame:
    """Labels with a rule-based prediction: quality predicted 1 when not toxic."""
    lab = table(spark, d, "labels")
    return lab.select("quality", F.when(F.col("toxic") == 0, 1).otherwise(0).alias("prediction"))


@query("confusion_matrix")
def q_confusion_matrix(spark, d):
    return agg.confusion_matrix(_rule_predictions(spark, d), "quality", "prediction")


# --- 2.6 sets, ordering, sampling ---------------------------------------------

def _nation_keys(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c, s


@query("union_distinct")
def q_union_distinct(spark, d):
    return sets.union_distinct(*_nation_keys(spark, d))


@query("intersect_set")
def q_intersect_set(spark, d):
    return sets.intersect_set(*_nation_keys(spark, d))


@query("top_k")
def q_top_k(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sets.top_k(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query("split_by_key")
def q_split_by_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    # the engine-portable hash, so SQL elsewhere can reproduce each row's side
    return sets.split_by_key(o, ["o_orderkey"], 0.7, seed=42, side_name="side", method="md5")
