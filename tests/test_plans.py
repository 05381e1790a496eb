"""Plan assertions on registered queries: no row-at-a-time Python, filters and
column pruning reach the Parquet scan, whole-table statistics are not
un-partitioned windows over rows."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", [k for k in sorted(E.queries()) if not k.startswith("e")])
def test_no_python_row_udf(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filter_pushdown_and_pruning(spark):
    plan = _plan(E.queries()["c10_filter_rows"](spark, SF))
    assert "PushedFilters: [Or(" in plan
    read = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "l_orderkey" not in read and "l_shipdate" not in read


def test_table_stats_are_scalar_subqueries(spark):
    plan = _plan(E.queries()["w2_table_stat"](spark, SF))
    assert "Subquery" in plan
    # no window without a partition over the row-level table
    assert "Window" not in plan


@pytest.mark.parametrize("key", ["e2_areg_one_regressor", "e3_areg_two_way"])
def test_fit_passes(spark, key, monkeypatch):
    """Every frame whose rows reach the driver during a fit: no row-at-a-time Python, no cross join."""
    seen = []
    frame = type(spark.range(1))
    collect = frame.collect

    def recorded(self):
        seen.append(_plan(self))
        return collect(self)
    monkeypatch.setattr(frame, "collect", recorded)
    E.queries()[key](spark, SF)
    assert seen
    for plan in seen:
        assert not any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"))
        assert "BroadcastNestedLoopJoin" not in plan
