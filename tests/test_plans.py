"""Plan-shape guards: the scale properties the design relies on."""

import os
import re

import pytest

import __spark_entry__ as E
from bench import HEADLINE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
UNUSED_LINEITEM = ["l_discount", "l_tax", "l_linestatus", "l_linenumber"]


def _plan(spark, key) -> str:
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in HEADLINE if k != "fit_boosted_trees"])
def test_no_cartesian_and_pruned_scans(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for schema in re.findall(r"lineitem\.parquet\][^\n]*ReadSchema: (struct<[^\n]*)", plan):
        assert not any(c in schema for c in UNUSED_LINEITEM), schema


def _panel_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_mart_scans_its_fact_table_once(spark):
    from strata.sources import panels as P
    # mart_quarterly stores its panel first: the panel is the one fact scan
    for key, fact, plan in [("quarterly panel", "lineitem", _panel_plan(P.quarterly(spark, SF))),
                            ("mart_employment", "lineitem", _plan(spark, "mart_employment")),
                            ("mart_monthly", "orders", _plan(spark, "mart_monthly"))]:
        assert len(re.findall(rf"FileScan parquet [^\n]*{fact}\.parquet", plan)) == 1, key
        schemas = re.findall(rf"{fact}\.parquet\][^\n]*ReadSchema: (struct<[^\n]*)", plan)
        assert len(schemas) == 1 and "struct<" in schemas[0]


def test_mart_quarterly_windows_never_partition_by_geo_alone(spark):
    plan = _plan(spark, "mart_quarterly")
    assert "lineitem.parquet" not in plan
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows and not any(re.search(r"\[geo#\d+\](,|$)", w) for w in windows), windows
    keys = [re.sub(r"#\d+", "", e) for e in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    assert {"geo, year", "geo, naics", "geo, date_parsed"} <= set(keys), keys
    assert keys.count("geo") <= 1                                # the threshold aggregate


@pytest.mark.parametrize("key", ["missing_by_year", "topk_per_group", "anomaly_rows", "seasonal_decompose",
                                 "sustained_demand_pct", "lookup_dimension", "label_encode",
                                 "check_row_reconciliation", "quality_report"])
def test_diagnostics_do_not_scan_the_fact_table_twice(spark, key):
    """The stored panel is the only fact scan; what is left reads stored tables."""
    assert "lineitem.parquet" not in _plan(spark, key)


def test_feature_stage_joins_only_label_codes(spark):
    plan = _plan(spark, "ml_features")
    joins = re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|NestedLoopJoin)[^\n]*", plan)
    assert all("__label" in j or "__part" in j for j in joins), joins
