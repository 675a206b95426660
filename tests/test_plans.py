"""Plan-shape tests: the flagship job keeps Python out of the plan, broadcasts its
dimensions, never cartesian-joins the facts, and prunes/pushes to the scan."""

import pytest

from yearloom.operators.units.convert import convert_crosswalk
from yearloom.plans.catalog import flagship_inputs
from yearloom.plans.fixtures import lineitem_obs
from yearloom.plans.harmonize import attach_units, map_and_rollup

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def rolled(spark):
    obs, smap, template = flagship_inputs(spark, SF)
    tu = template.withColumnRenamed("unit", "emf_units")
    return attach_units(map_and_rollup(obs, smap), tu)


def test_fact_pass_plan(rolled):
    plan = _plan(rolled)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2            # series map and template units
    assert "HashAggregate" in plan and "partial_sum" in plan  # map-side combine before the shuffle


def test_scan_is_pruned(spark):
    plan = _plan(lineitem_obs(spark, SF))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string,l_shipdate" in plan
    assert "l_quantity" not in plan and "l_orderkey" not in plan


def test_conversion_broadcasts_factors(spark, rolled):
    out = convert_crosswalk(rolled, [("trillion Btu", "EJ/yr"), ("quadrillion Btu", "EJ/yr")])
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan
