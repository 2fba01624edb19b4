"""Plan-shape checks: the properties that matter at scale, asserted on the physical plans."""

import re

import pytest

from cumulus.plans import catalog
from tests.conftest import SMALL

# Queries that run a job before returning (they write files first); their plans
# are checked through the operators they use.
SIDE_EFFECTS = {"ingest_reports", "ingest_quarantine", "incremental_ingest", "month_to_date", "replace_partition_replay", "delta_dup_keys_compat"}
NAMES = sorted(set(catalog.queries()) - SIDE_EFFECTS)


def plan(spark, name):
    df = catalog.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_no_nested_loop_no_row_udf(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p  # no row-at-a-time Python UDF


@pytest.mark.parametrize("name", NAMES)
def test_windows_are_partitioned(spark, name):
    # Physical Window nodes print "Window [exprs], [partition keys], [order]".
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan(spark, name)):
        assert m.group(1).strip(), f"global window in {name}"


def test_flagship_delta_reuses_the_snapshot_partitioning(spark):
    p = plan(spark, "delta_all_snapshots")
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", p)
    # daily aggregate, (key, month) repartition, and the calendar (distinct days; index window).
    assert len(exchanges) <= 5
    assert "SortMergeJoin" not in p
    # The delta's aggregate sits directly on the snapshot stream: no exchange between
    # the running-sum window and the final increment aggregate.
    final_agg = p.index("HashAggregate(keys=[month")
    window = p.index("Window [sum(")
    assert final_agg < window and "Exchange" not in p[final_agg:window]


def test_scans_read_only_needed_columns(spark):
    def scans(p, table):
        # "FileScan parquet [col#1,col#2,...] ... Location: ...[file:.../<table>.parquet]"
        return [cols for cols, loc in re.findall(r"FileScan parquet \[(.*?)\].*?Location: [^\]]*\[([^\]]*)\]", p) if loc.endswith(f"/{table}.parquet")]

    orders = scans(plan(spark, "delta_all_snapshots"), "orders")
    assert orders and all("o_totalprice" not in c for c in orders)
    (lineitem,) = scans(plan(spark, "unpivot_measures"), "lineitem")
    assert "l_shipdate" not in lineitem and "l_returnflag" not in lineitem and "l_tax" in lineitem


def test_partial_aggregation_before_every_delta_shuffle(spark):
    p = plan(spark, "delta_null_keys")  # keys are trimmed there, so the delta shuffles
    assert "partial_sum" in p and "partial_max" in p


def test_snapshots_are_derived_once(spark):
    def orders(p):
        return len(re.findall(r"FileScan parquet \[[^\]]*\][^\n]*/orders\.parquet", p))

    # the derivation reads orders for the calendar and for the counts; a second derivation would double that
    assert orders(plan(spark, "delta_no_reset")) <= orders(plan(spark, "delta_all_snapshots"))
    p = plan(spark, "delta_dup_keys_compat")
    assert "Expand" not in p and "o_orderpriority" not in p  # counted, not derived again: it reads the stored snapshot


@pytest.mark.parametrize("name", ["missing_files", "rescrape_targets", "missing_by_state", "completeness_totals", "header_name_audit"])
def test_file_names_are_parsed_in_stages(spark, name):
    # an expression that holds the whole chain of regular expressions is some tens of thousands of characters long
    lines = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert max(map(len, lines)) < 3000
