"""The plans of the registered queries: nothing per row in Python, no cross joins, narrow scans."""

import re

import pytest

from bindings import QUERIES
from bindings.registry import table
from steward.operators import reconcile, temporal_joins

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize(
    "name,columns",
    [
        ("Q2_rapid_fire_by_day", {"ts", "user_id"}),
        ("Q3_top_groups_by_volume", {"o_custkey", "o_totalprice", "c_custkey", "c_nationkey", "n_nationkey", "n_name"}),
        ("Q4_mean_by_group", {"event_type", "value"}),
        ("E1_fresh_rows", {"o_custkey", "c_custkey"}),
        ("S10_key_violations", {"l_orderkey", "l_linenumber"}),
    ],
)
def test_scans_read_only_what_is_used(spark, sf, name, columns):
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, sf))):
        read |= {field.split(":")[0] for field in schema.split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark, sf):
    text = plan(QUERIES["S6_bound_query"](spark, sf))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice,100000.5\)", text)


@pytest.mark.parametrize("name", ["Q2_rapid_fire_by_day", "Q4_mean_by_group", "D3_candidate_keys", "E1_fresh_rows"])
def test_aggregates_combine_before_they_shuffle(spark, sf, name):
    assert "partial_" in plan(QUERIES[name](spark, sf))


def test_copies_share_one_aggregation(spark, sf):
    """The two branches that write out few and many copies read the same exchange."""
    orders = table(spark, sf, "orders").selectExpr("o_custkey AS key")
    customer = table(spark, sf, "customer").selectExpr("c_custkey AS key")
    counted = reconcile.paired_counts(orders, customer).selectExpr("key", "_incoming AS n")
    df = reconcile.repeat_rows(counted, "n", per_task=10)
    assert len(df.collect()) == orders.count()
    assert "ReusedExchange" in plan(df).split("== Initial Plan ==")[0]


def windows(text):
    """The partition columns of each window of a plan."""
    return [set(re.findall(r"(_\w+|\w+)#", found)) for found in re.findall(r"Window \[.*?\], \[([^\]]*?)\], \[", text)]


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("Q5")])
def test_frame_counts_share_no_hot_window(spark, sf, name):
    """No window gathers a whole key: all are partitioned by key and slice."""
    found = windows(plan(QUERIES[name](spark, sf)))
    assert found and all("_slice" in columns and "_k0" in columns for columns in found)


@pytest.mark.parametrize("name", ["J1_asof_join", "J1b_asof_join_within_types"])
def test_asof_windows_hold_slices(spark, sf, name, monkeypatch):
    """Rows meet in a window by key and slice, before they are stored; those after hold slices of a block, or blocks of a key."""
    inner, keep = [], temporal_joins.stored
    monkeypatch.setattr(temporal_joins, "stored", lambda df, label: (inner.append(plan(df)), keep(df, label))[1])
    text = plan(QUERIES[name](spark, sf))
    (first,) = inner
    assert windows(first) == [{"_k0", "_slice"}] and sorted(map(sorted, windows(text))) == [["_block", "_k0"], ["_k0"]]
    assert "NestedLoop" not in text + first


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["Q3_top_groups_by_volume"](spark, sf))
