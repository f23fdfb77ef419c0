"""Registered queries: oracles at the smallest scale, and the shape of the physical plans."""

import os
import re

import pytest
from oracle_check import compare, connect
from plan_text import PYTHON, final_plan, planned

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLES[name], SF) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 25


#: Queries with the k x k solve of the regression, the one place with Python.
SOLVED = {"ols_fit", "roi_compare", "ols_summary", "mmm_fit", "fitted_contributions", "fitted_roi", "naive_durbin_watson"}


@pytest.mark.parametrize("name", sorted(SOLVED))
def test_python_only_factors_and_solves(spark, name):
    """Tasks reduce their rows to factors, a tree of two levels merges them, one step solves; no cross join."""
    plan = planned(QUERIES[name](spark, SF))
    assert len(re.findall(PYTHON, plan)) == 4
    before, after = plan.split("MapInPandas reduce_rows")[0], plan.split("MapInPandas reduce_rows")[1]
    assert before.count("collect_list(r") >= 2  # factors are merged above
    assert not re.search(PYTHON, after)  # rows enter Python once
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop", plan)


#: Queries of the optional part that run task functions over Arrow batches.
ARROW = {"op5_warc", "op11_vector_codes", "op13_phrases"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SOLVED))
def test_no_python_and_no_cross_join(spark, name):
    plan = planned(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan)
    assert name in ARROW or not re.search(PYTHON, plan)


def test_fact_tables_are_scanned_once_and_pruned(spark):
    plan = final_plan(QUERIES["mmm_design"](spark, SF))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/(\w+)\.parquet", plan)
    tables = [t for _, t in scans]
    assert sorted(tables) == ["customer", "lineitem", "nation", "orders", "region"]
    columns = {t: re.sub(r"#\d+L?", "", c).split(",") for c, t in scans}
    assert columns["lineitem"] == ["l_orderkey", "l_extendedprice", "l_discount"]


def test_running_totals_reuse_their_shuffle(spark):
    """The rows are scanned for the cut points only; the other readers reuse that shuffle."""
    plan = final_plan(QUERIES["auc_roc"](spark, SF))
    assert plan.count("ReusedExchange") >= 1 and plan.count("FileScan") <= 1


def test_draws_shuffle_once(spark):
    """With small series, everything after the placement by draw stays in place."""
    plan = final_plan(QUERIES["uplift_by_draw"](spark, SF))
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 1
