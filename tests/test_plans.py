"""Plan checks: no Python in any registered plan, filters and column
pruning reach the scan, aggregates run before joins, lookups broadcast."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from quarry.plans.registry import all_queries
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow", "AggregateInPandas", "WindowInPandas")
STREAM_KEYS = {k for k in queries() if k.startswith("stream_")}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(all_queries()) - STREAM_KEYS))
def test_no_python_in_plan(spark, key):
    text = plan(queries()[key](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES), f"{key} runs Python:\n{text}"


def test_filter_pushed_and_columns_pruned(spark):
    text = plan(queries()["filter_range"](spark, SF_SMALL))
    assert "GreaterThan(l_quantity,30.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def test_prefix_filter_pushed(spark):
    text = plan(queries()["filter_prefix"](spark, SF_SMALL))
    assert "StringStartsWith(p_brand,Brand#1)" in text


def _tables(spark):
    from quarry.plans.tables import table
    return [table(spark, SF_SMALL, t) for t in ("lineitem", "orders", "customer")]


def test_flagship_aggregates_before_joins(spark):
    from quarry.plans import reports
    df = reports.segment_rates(*_tables(spark))  # the large-table path
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    # the lineitem scan feeds an aggregate by order key, not a join
    lines = optimized.splitlines()
    li_scan = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "Relation" in line)
    above = "\n".join(lines[max(0, li_scan - 3):li_scan])
    assert "Aggregate [l_orderkey" in above
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan(df)


def test_lookup_is_broadcast(spark):
    text = plan(queries()["lookup_enrich"](spark, SF_SMALL))
    assert text.count("BroadcastHashJoin") == 2


def test_top_k_has_no_global_sort(spark):
    text = plan(queries()["top_k"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns == ["c_mktsegment", "total", "flagged", "pct_flagged"]


def test_oracle_keys_are_queries():
    assert set(oracle_sql()) <= set(queries())


def test_plans_run_no_job_while_built(spark):
    """Lookups and the flagship only build a plan: no size check, one plan at every size."""
    from quarry.operators import joins as jn
    from quarry.plans import reports
    from quarry.plans.tables import table
    c = table(spark, SF_SMALL, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey")
    tables = _tables(spark)
    spark.sparkContext.setJobGroup("planning", "planning")
    found = jn.lookup(o, c, "o_custkey", "c_custkey")
    reports.segment_rates(*tables)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("", "")
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()


def test_flagship_at_scale_shuffles_each_side_once(spark):
    """With no broadcasts (tables too big), the flagship shuffles: line-item
    partials by order, orders, per-customer partials, customer, segment
    partials - and nothing twice: each aggregate feeds its join directly."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from quarry.plans import reports
        text = plan(reports.segment_rates(*_tables(spark)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    keys = sorted(m.split("(")[1].split("#")[0]
                  for m in text.split("Exchange hashpartitioning")[1:])
    assert keys == ["c_custkey", "c_mktsegment", "l_orderkey", "o_custkey", "o_orderkey"]
    assert text.count("SortMergeJoin") == 2
