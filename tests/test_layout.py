"""Bucketed lineitem: same rows, and no shuffle of lineitem for the order join."""

import contextlib
import io

from tillroll.operators import report
from tillroll.sources.layout import bucket_testdata
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL, rows


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_lineitem_skips_its_shuffle(spark, tmp_path):
    read = bucket_testdata(spark, SF_SMALL, str(tmp_path / "bucketed"), buckets=8)
    plain = testdata_transactions(spark, SF_SMALL)
    bucketed = testdata_transactions(spark, SF_SMALL, read=read)
    for step in (report.sales_by_region, report.window_ranking, report.top_products):
        assert rows(step(bucketed)) == rows(step(plain))
    plan = _plan(report.sales_by_region(bucketed))
    assert "Exchange hashpartitioning(l_orderkey" not in plan
    assert "Exchange hashpartitioning(l_orderkey" in _plan(report.sales_by_region(plain))
