"""The tuned report returns the same rows as the plain steps."""

import pytest

from tillroll.operators import report
from tillroll.plans.run import run_report
from tillroll.plans.tuned import tuned_report
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL, rows


@pytest.mark.parametrize("storage,one_pass", [
    ("cache", False), ("table", False), ("checkpoint", False), (None, False),
    ("table", True), ("cache", True),
])
def test_tuned_equals_plain(spark, storage, one_pass):
    fact = testdata_transactions(spark, SF_SMALL)
    plain = {
        "sales_by_category": rows(report.sales_by_category(fact)),
        "sales_by_region": rows(report.sales_by_region(fact)),
        "top_products": rows(report.top_products_with_discount(fact)),
        "monthly_trends": rows(report.monthly_trends(fact)),
        "age_group_analysis": rows(report.age_group_analysis(fact)),
        "payment_analysis": rows(report.payment_analysis(fact)),
        "window_ranking": rows(report.window_ranking(fact)),
        "basic_stats": sorted(rows(report.column_profile(fact))),
    }
    shape = rows(report.load_shape(fact))[0][:2]
    with tuned_report(fact, storage=storage, one_pass_groups=one_pass) as t:
        for name, expect in plain.items():
            got = rows(getattr(t, name)())
            if name == "basic_stats":
                got = sorted(got)
            assert got == expect, name
        assert rows(t.load_shape())[0][:2] == shape


def test_runner_records_every_step(spark, tmp_path):
    load = lambda: testdata_transactions(spark, SF_SMALL)
    rec, res = run_report(spark, load, "basic_t", mode="plain", out_path=str(tmp_path / "a"))
    assert [s["name"] for s in rec["steps"]][0] == "load_data" and len(rec["steps"]) == 10
    rec2, _ = run_report(spark, load, "opt_t", mode="tuned", out_path=str(tmp_path / "b"))
    names = [s["name"] for s in rec2["steps"]]
    assert names[0] == "load_and_cache" and "top_products_with_broadcast" in names
    assert rec["row_count"] == rec2["row_count"] > 0


def test_onepass_runner_matches_plain_results(spark, tmp_path):
    load = lambda: testdata_transactions(spark, SF_SMALL)
    _, plain = run_report(spark, load, "basic_t", mode="plain", out_path=str(tmp_path / "p"))
    rec, onep = run_report(spark, load, "one_t", mode="onepass", out_path=str(tmp_path / "o"))
    assert "grouped_aggregate" in [s["name"] for s in rec["steps"]]
    for name in ["sales_by_category", "sales_by_region", "monthly_trends",
                 "age_group_analysis", "payment_analysis", "window_ranking", "top_products"]:
        assert onep[name] == plain[name], name


def test_repartition_before_caching(spark):
    fact = testdata_transactions(spark, SF_SMALL)
    want = rows(report.sales_by_region(fact))
    with tuned_report(fact, storage="cache", partitions=4) as t:
        assert rows(t.load_shape())[0][2] == 4
        assert rows(t.sales_by_region()) == want


def _files(root):
    return [p for p in root.rglob("*") if p.is_file() and "tillroll" in str(p) or "rdd-" in p.name]


@pytest.mark.parametrize("storage", ["table", "checkpoint"])
def test_stored_data_is_deleted_on_exit(spark, tmp_path, monkeypatch, storage):
    import tillroll.plans.tuned as tuned_mod

    monkeypatch.setattr(tuned_mod, "scratch_path", lambda *_: str(tmp_path / "tillroll"))
    old = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        fact = testdata_transactions(spark, SF_SMALL)
        with tuned_report(fact, storage=storage) as t:
            assert t.load_shape().first()[0] > 0 and _files(tmp_path)
        assert not _files(tmp_path)
        with pytest.raises(ZeroDivisionError):
            with tuned_report(fact, storage=storage):
                assert _files(tmp_path)
                raise ZeroDivisionError
        assert not _files(tmp_path)
    finally:
        if old:
            spark.sparkContext._jsc.sc().setCheckpointDir(old)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tillroll import session

    conf = SimpleNamespace(get=lambda *_: None)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(conf=conf, sparkContext=sc))


def test_cached_frames_live_as_long_as_the_result(spark):
    import gc

    from tillroll.plans.registry import QUERIES

    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    held = lambda: len(spark.sparkContext._jsc.getPersistentRDDs()) - before
    df = QUERIES["cached_top_products"](spark, SF_SMALL)
    first = rows(df)
    assert held() == 2
    assert "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") >= 2 and "BroadcastHashJoin" in plan
    later = df.orderBy("product_name", "category")
    del df
    gc.collect()
    assert held() == 0
    assert sorted(rows(later)) == sorted(first)
