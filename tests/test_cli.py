"""The command line, run in-process against the test session."""

import json
import os

import pytest

from tillroll import __main__ as cli

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture
def keep_session(spark, monkeypatch):
    # The CLI builds (getOrCreate) and stops its session; keep the test one alive.
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    return spark


def test_generate_then_report(keep_session, tmp_path, capsys):
    gen = str(tmp_path / "gen")
    assert cli.main(["generate", "--rows", "3000", "--output", gen]) == 0
    out = str(tmp_path / "out")
    assert cli.main(["report", "--input", gen, "--mode", "plain", "--output", out, "--show", "2"]) == 0
    record = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert record["row_count"] == 3000 and len(record["steps"]) == 10
    back = keep_session.read.json(f"{out}/metrics")
    assert back.first()["experiment"] == "basic_local"
    out2 = str(tmp_path / "out2")
    assert cli.main(["report", "--input", gen, "--mode", "tuned", "--storage", "table",
                     "--one-pass-groups", "--output", out2, "--show", "1"]) == 0
    record2 = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert record2["experiment"] == "opt_local" and record2["row_count"] == 3000


def test_compare_and_joblog(keep_session, capsys):
    assert cli.main(["compare", "--metrics", os.path.join(FIXTURES, "metrics")]) == 0
    assert cli.main(["joblog", "--eventlog", os.path.join(FIXTURES, "eventlog")]) == 0
    text = capsys.readouterr().out
    assert "1.19" in text and "bad_cast" in text


def test_report_on_bucketed_testdata(keep_session, tmp_path, capsys):
    from conftest import SF_SMALL

    assert cli.main(["report", "--testdata", SF_SMALL, "--bucketed", str(tmp_path / "b"),
                     "--buckets", "4", "--output", str(tmp_path / "o"), "--show", "1"]) == 0
    record = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert record["row_count"] > 0
