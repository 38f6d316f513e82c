"""Physical-plan checks: no Cartesian products, filters and column pruning
reach the parquet scans, the dashboard reads the materialised model."""

import re

import pytest

from shelfline.plans.catalog import QUERIES
from shelfline.sources import views as V
from tests.conftest import SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_products(spark, key):
    p = plan_of(QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_name_filter_pushed_to_scan(spark):
    df = QUERIES["sell_through_one"](spark, SMALL)
    p = plan_of(df)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(p_name,red widget\)", p)


def test_lines_scan_reads_only_needed_columns(spark):
    p = plan_of(V.lines(spark, SMALL))
    m = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", p)
    cols = {c.split("#")[0].strip() for c in m.group(1).split(",")}
    assert cols == {"l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                    "l_discount", "l_returnflag", "l_shipdate"}


def test_dashboard_reads_model_not_raw_facts(spark):
    p = plan_of(QUERIES["dashboard_payload"](spark, SMALL))
    assert "lineitem.parquet" not in p and "orders.parquet" not in p
    assert "pos_sum#" in p


def test_latest_wins_hot_key_uses_partial_aggregation(spark):
    """One key with a third of all rows: latest-wins must stay a partial +
    final hash aggregate (no window sort of the hot key in one task)."""
    import datetime as dt
    from pyspark.sql import functions as F
    from shelfline.operators import memory
    n = 3000
    log = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"),
        F.lit("k").alias("key"), F.to_json(F.struct(F.col("id").alias("v"))).alias("value_json"),
        F.lit("put").alias("op"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("seq")))
    state = memory.latest_state(log)
    p = plan_of(state)
    assert "Window" not in p and "partial_max" in p
    hot = state.filter(F.col("user_id") == "hot").first()
    assert hot["seq"] == 2997 and state.count() == 1 + (n - n // 3)


def test_batched_topk_limits_per_task_before_shuffle(spark):
    p = plan_of(QUERIES["vector_topk_batch"](spark, SMALL))
    assert re.search(r"WindowGroupLimit \[qid#\d+L\].*Partial", p)
