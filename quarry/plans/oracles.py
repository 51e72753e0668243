"""DuckDB oracle SQL for the registered queries.

Written from each operator's definition (SURVEY 2 / 8), not from the Spark
plans. Column names equal the Spark aliases. JVM ``split`` drops trailing
empty fields, so token oracles strip trailing separators first.
"""

from __future__ import annotations

# Java split on a single space, as a DuckDB list expression over column X.
_JSPLIT = ("CASE WHEN rtrim(X, ' ') = '' AND X <> '' THEN []::VARCHAR[] "
           "ELSE string_split(rtrim(X, ' '), ' ') END")


def _jsplit(col: str) -> str:
    return _JSPLIT.replace("X", col)


_RATE = ("count(*) AS total, "
         "CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS flagged, "
         "round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0 / count(*)) AS pct_flagged")

ORACLES: dict[str, str] = {
    "src_inline": """
        SELECT s.status_name, count(*) AS count
        FROM orders o JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) s(code, status_name)
          ON o.o_orderstatus = s.code
        GROUP BY s.status_name""",
    "json_props": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "typed_projection": """
        SELECT o_orderkey, o_orderstatus, o_totalprice AS price,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
        FROM orders""",
    "sql_filter": "SELECT * FROM part WHERE p_size > 40",
    "src_csv_roundtrip": "SELECT * FROM customer",
    "src_semicolon_roundtrip": "SELECT * FROM supplier",
    "src_json_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "src_text_lines": "SELECT p_partkey, p_name FROM part",
    "select_cols": "SELECT c_name, c_acctbal FROM customer",
    "filter_eq": "SELECT * FROM part WHERE p_size = 40",
    "filter_eq_text": """
        SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS priority FROM orders
        WHERE TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) = 2""",
    "filter_range": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30",
    "filter_contains": "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')",
    "filter_not_contains": "SELECT p_partkey, p_name FROM part WHERE NOT contains(p_name, 'ring')",
    "filter_prefix": """
        SELECT p_partkey, p_brand FROM part
        WHERE NOT (starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2'))""",
    "fn_upper": "SELECT p_partkey, upper(p_name) AS name_upper FROM part",
    "fn_replace": "SELECT p_partkey, replace(p_name, ' ', chr(9)) AS name_tab FROM part",
    "fn_split_field": "SELECT p_partkey, string_split(p_name, ' ')[2] AS word2 FROM part",
    "fn_concat": "SELECT p_partkey, concat_ws(',', p_type, p_brand) AS type_brand FROM part",
    "cleanse_fields": """
        SELECT p_partkey,
               concat_ws(',', p_brand, CASE WHEN p_type = 'ECONOMY' THEN '2' ELSE '4' END,
                         upper(p_name)) AS line
        FROM part""",
    "recode_binary": """
        SELECT p_partkey,
               CASE WHEN contains(p_name, 'ring') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS name_code,
               CASE WHEN contains(p_type, 'ECONOMY') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS type_code
        FROM part""",
    "recode_map": """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 2.0
                    ELSE TRY_CAST(o_orderstatus AS DOUBLE) END AS status_code
        FROM orders""",
    "indicators": """
        SELECT c_custkey,
               CAST(contains(c_mktsegment, 'AUTOMOBILE') AS DOUBLE) AS seg_AUTOMOBILE,
               CAST(contains(c_mktsegment, 'BUILDING') AS DOUBLE) AS seg_BUILDING,
               CAST(contains(c_mktsegment, 'FURNITURE') AS DOUBLE) AS seg_FURNITURE,
               CAST(contains(c_mktsegment, 'HOUSEHOLD') AS DOUBLE) AS seg_HOUSEHOLD,
               CAST(contains(c_mktsegment, 'MACHINERY') AS DOUBLE) AS seg_MACHINERY
        FROM customer""",
    "parse_int_or_zero": r"""
        SELECT o_orderkey,
               CASE WHEN regexp_full_match(o_orderpriority, '\d*')
                      THEN coalesce(TRY_CAST(o_orderpriority AS BIGINT), 0)
                    WHEN regexp_full_match(split_part(o_orderpriority, '-', 1), '\d*')
                      THEN coalesce(TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT), 0)
                    ELSE 0 END AS priority_num
        FROM orders""",
    "parse_float_or_zero": r"""
        SELECT o_orderkey,
               coalesce(CASE WHEN regexp_full_match(CAST(o_totalprice AS VARCHAR),
                                   '[+-]?(([1-9][0-9]*)|(0))([.,][0-9]+)?')
                             THEN TRY_CAST(replace(CAST(o_totalprice AS VARCHAR), ',', '.') AS DOUBLE) END,
                        0.0) AS price_parsed,
               coalesce(CASE WHEN regexp_full_match(o_orderpriority, '[+-]?(([1-9][0-9]*)|(0))([.,][0-9]+)?')
                             THEN TRY_CAST(o_orderpriority AS DOUBLE) END,
                        CASE WHEN regexp_full_match(split_part(o_orderpriority, '-', 1),
                                   '[+-]?(([1-9][0-9]*)|(0))([.,][0-9]+)?')
                             THEN TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) END,
                        0.0) AS priority_parsed
        FROM orders""",
    "impute_constant": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 80.0 ELSE value END AS value_imputed
        FROM events""",
    "bucket_round": "SELECT c_custkey, floor(c_acctbal / 10.0 + 0.5) * 10.0 AS bal_bucket FROM customer",
    "cap_value": "SELECT l_orderkey, l_linenumber, least(l_quantity, 40.0) AS qty_capped FROM lineitem",
    "ratio_pct": """
        SELECT l_orderkey, l_linenumber, round(l_tax / (l_discount + 1) * 100, 6) AS tax_pct
        FROM lineitem""",
    "row_mean_abs": """
        SELECT l_orderkey, l_linenumber,
               round(abs((l_quantity + l_discount + l_tax) / 3.0), 6) AS mean_abs
        FROM lineitem""",
    "label_threshold": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_quantity IS NULL THEN 'Error'
                    WHEN l_quantity > (SELECT avg(l_quantity) FROM lineitem) THEN 'high'
                    ELSE 'low' END AS label
        FROM lineitem""",
    "explode_tokens": f"SELECT p_partkey, unnest({_jsplit('p_name')}) AS token FROM part",
    "join_inner": """
        SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_nationkey, n.n_name
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "lookup_enrich": """
        SELECT c.c_custkey, n.n_name, r.r_name
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "join_reattach": """
        SELECT d.doc_id, d.n_chars, l.quality
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "filter_join_agg": """
        SELECT p.p_brand, round(avg(l.l_extendedprice), 6) AS avg_price,
               max(l.l_extendedprice) AS max_price
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        WHERE l.l_quantity > 30
        GROUP BY p.p_brand""",
    "scalar_broadcast": """
        SELECT l_orderkey, l_linenumber,
               round(l_quantity - (SELECT avg(l_quantity) FROM lineitem), 6) AS qty_dev
        FROM lineitem""",
    "agg_count": "SELECT count(*) AS n FROM lineitem",
    "agg_sum": "SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem",
    "agg_argmin": """
        SELECT text AS shortest, CAST(length(text) AS INTEGER) AS length FROM documents
        ORDER BY length(text), text LIMIT 1""",
    "agg_int_avg": """
        SELECT CAST(sum(CAST(l_quantity AS BIGINT)) // count(*) AS BIGINT) AS avg FROM lineitem""",
    "agg_parsed_avg": r"""
        SELECT round(avg(CASE WHEN regexp_full_match(split_part(o_orderpriority, '-', 1),
                                    '[+-]?(([1-9][0-9]*)|(0))([.,][0-9]+)?')
                              THEN CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) END), 6) AS avg
        FROM orders""",
    "agg_by_key": """
        SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) // count(*) AS BIGINT) AS avg
        FROM lineitem GROUP BY l_returnflag""",
    "lookup_unmatched": """
        SELECT o_orderstatus, count(*) AS count FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')
        GROUP BY o_orderstatus""",
    "group_count": "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY o_orderstatus",
    "group_avg_max": """
        SELECT c_mktsegment, round(avg(c_acctbal), 6) AS avg_bal, max(c_acctbal) AS max_bal
        FROM customer GROUP BY c_mktsegment""",
    "rate_by_one": f"""
        SELECT c.c_mktsegment, {_RATE}
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_mktsegment ORDER BY 1""",
    "rate_by_two": f"""
        SELECT c.c_mktsegment, o.o_orderpriority, {_RATE}
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_mktsegment, o.o_orderpriority ORDER BY 1, 2""",
    "rate_by_numeric": f"""
        SELECT l_discount, {_RATE} FROM lineitem GROUP BY l_discount ORDER BY 1""",
    "sql_group_max": "SELECT p_type, max(p_size) AS max_size FROM part GROUP BY p_type ORDER BY 2",
    "sql_group_avg": """
        SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY l_returnflag""",
    "distinct_values": "SELECT DISTINCT event_type FROM events",
    "conditional_counts": """
        SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
               count(*) FILTER (WHERE l_returnflag = 'A') AS n_a
        FROM lineitem""",
    "count_above_avg": """
        SELECT count(*) AS n_above FROM lineitem
        WHERE l_quantity > (SELECT avg(l_quantity) FROM lineitem)""",
    "agg_moments": """
        SELECT round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_sd,
               round(avg(l_extendedprice), 6) AS l_extendedprice_mean,
               round(stddev_samp(l_extendedprice), 6) AS l_extendedprice_sd
        FROM lineitem""",
    "corr_with_label": """
        SELECT 'l_quantity' AS field, round(corr(l_extendedprice, l_quantity), 6) AS corr FROM lineitem
        UNION ALL SELECT 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem
        UNION ALL SELECT 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem
        UNION ALL SELECT 'l_extendedprice', round(corr(l_extendedprice, l_extendedprice), 6) FROM lineitem""",
    "word_count": f"""
        SELECT word, count(*) AS count
        FROM (SELECT unnest({_jsplit('text')}) AS word FROM documents)
        GROUP BY word""",
    "confusion_matrix": """
        SELECT quality, CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS prediction, count(*) AS count
        FROM labels GROUP BY 1, 2""",
    "union_distinct": """
        SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""",
    "intersect_set": """
        SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier""",
    "split_by_key": """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 8))
                              AS BIGINT) % 1000 < 700 THEN 'train' ELSE 'test' END AS side
        FROM orders""",
    "top_k": """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
}
