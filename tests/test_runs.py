"""Run comparison over metric documents, checked against plain Python."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tillroll.operators import runs as R
from tillroll.plans.run import metrics_frame
from tillroll.sources.sinks import write_json

from conftest import rows

FIXTURE = os.path.join(os.path.dirname(__file__), "fixtures", "metrics")


def load_py(folder):
    out = {}
    for exp in R.EXPERIMENTS:
        p = os.path.join(folder, f"metrics_{exp}.json")
        if os.path.exists(p):
            with open(p) as fh:
                out[exp] = json.load(fh)
    return out


def step_time(doc, step):
    for s in doc["steps"]:
        if R.STEP_ALIASES.get(s["name"], s["name"]) == step:
            return s["time_s"]
    return 0.0


@pytest.fixture(scope="module")
def runs_df(spark):
    return R.read_metrics(spark, FIXTURE).cache()


def test_steps_alias_mapping(runs_df):
    got = rows(R.metrics_steps(runs_df).filter("experiment = 'opt_1dn'").orderBy("step_index"))
    assert [r[2] for r in got] == R.CANONICAL_STEPS
    assert got[4][3] == 0.382


def test_summary_order_and_axis_bound(runs_df):
    got = rows(R.metrics_summary(runs_df))
    assert [r[0] for r in got] == R.EXPERIMENTS
    assert [r[2] for r in got] == [8.713, 7.332, 7.007, 7.367]
    assert {r[5] for r in got} == {8.713}
    assert got[0][1] == "Basic / 1 DataNode"


def test_speedup_and_scaling_match_published(runs_df):
    assert rows(R.metrics_speedup(runs_df)) == [("1dn", 8.713, 7.332, 1.19), ("3dn", 7.007, 7.367, 0.95)]
    assert rows(R.metrics_scaling(runs_df)) == [("basic", 8.713, 7.007, 1.24), ("opt", 7.332, 7.367, 1.0)]


def test_step_speedup_equals_python(runs_df):
    py = load_py(FIXTURE)
    expect = []
    for setup in R.SETUPS:
        b, o = py[f"basic_{setup}"], py[f"opt_{setup}"]
        for i, step in enumerate(R.CANONICAL_STEPS):
            tb, to = step_time(b, step), step_time(o, step)
            expect.append((setup, i, step, tb, to, tb / to if to > 0 else 1.0))
    assert rows(R.metrics_step_speedup(runs_df)) == expect


def test_step_matrix(runs_df):
    py = load_py(FIXTURE)
    got = rows(R.metrics_step_matrix(runs_df))
    assert [r[1] for r in got] == R.CANONICAL_STEPS
    for i, step in enumerate(R.CANONICAL_STEPS):
        assert got[i][2:] == tuple(step_time(py[e], step) for e in R.EXPERIMENTS)


def test_missing_run_step_and_zero_time(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    for exp in ["basic_1dn", "opt_1dn", "basic_3dn"]:  # opt_3dn absent
        shutil.copy(os.path.join(FIXTURE, f"metrics_{exp}.json"), folder)
    doc = json.loads((folder / "metrics_opt_1dn.json").read_text())
    doc["steps"] = [s for s in doc["steps"] if s["name"] != "basic_stats"]  # a step missing
    doc["steps"][0]["time_s"] = 0.0  # tuned time 0
    del doc["row_count"]
    (folder / "metrics_opt_1dn.json").write_text(json.dumps(doc))
    df = R.read_metrics(spark, str(folder))
    assert [r[0] for r in rows(R.metrics_speedup(df))] == ["1dn"]
    assert [r[0] for r in rows(R.metrics_scaling(df))] == ["basic"]
    sp = {r[2]: r for r in rows(R.metrics_step_speedup(df))}
    assert sp["basic_stats"][4] == 0.0 and sp["basic_stats"][5] == 1.0
    assert sp["load_data"][5] == 1.0
    summary = {r[0]: r for r in rows(R.metrics_summary(df))}
    assert summary["opt_1dn"][4] is None and "opt_3dn" not in summary
    matrix = rows(R.metrics_step_matrix(df))
    assert all(r[5] == 0.0 for r in matrix)  # opt_3dn column


def test_metrics_round_trip(spark, tmp_path):
    py = load_py(FIXTURE)
    df = metrics_frame(spark, list(py.values()))
    path = write_json(df, str(tmp_path / "out"), single_file=True)
    back = spark.read.schema(df.schema).json(path)
    assert sorted(rows(back)) == sorted(rows(df))


def test_other_runs_are_kept(spark, runs_df):
    extra = runs_df.limit(1).withColumn("experiment", F.lit("basic_local"))
    both = runs_df.union(extra)
    assert [r[0] for r in rows(R.metrics_summary(both))] == [*R.EXPERIMENTS, "basic_local"]
    matrix = R.metrics_step_matrix(both)
    assert matrix.columns[2:] == [*R.EXPERIMENTS, "basic_local"]
    assert any(r["basic_local"] > 0 for r in matrix.collect())
