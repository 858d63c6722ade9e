"""Job and stage reports over a real event log (fixture written by
scripts/make_eventlog_fixture.py), checked against plain Python."""

import json
import os

import pytest

from tillroll.operators import joblog as J

from conftest import rows

FIXTURE = os.path.join(os.path.dirname(__file__), "fixtures", "eventlog", "app-events.json")


def py_events(path=FIXTURE):
    with open(path) as fh:
        return [json.loads(line) for line in fh]


@pytest.fixture(scope="module")
def events(spark):
    return J.read_event_log(spark, FIXTURE).cache()


def test_job_log_equals_python(events):
    evs = py_events()
    ends = {e["Job ID"]: e for e in evs if e["Event"] == J.JOB_END}
    expect = []
    for e in evs:
        if e["Event"] != J.JOB_START:
            continue
        end = ends[e["Job ID"]]
        res = end["Job Result"]
        status = "success" if res["Result"] == "JobSucceeded" else f"failed({res['Exception']['Message']})"
        expect.append((e["Job ID"], e["Stage IDs"], e["Properties"].get("spark.job.description"), status))
    got = [(r["job_id"], r["stage_ids"], r["description"], r["status"]) for r in J.job_log(events).collect()]
    assert got == expect
    assert any(s.startswith("failed(") for *_, s in got)


def test_stage_log_equals_python(events):
    expect = {}
    for e in py_events():
        si = e.get("Stage Info")
        if e["Event"] == J.STAGE_COMPLETED:
            reason = si.get("Failure Reason")
            expect[si["Stage ID"]] = (si["Stage Name"], si["Number of Tasks"],
                                      "done" if reason is None else f"failed: {reason[:120]}")
    got = {r["stage_id"]: (r["name"], r["num_tasks"], r["status"]) for r in J.stage_log(events).collect()}
    assert got == expect
    failed = [s for _, _, s in got.values() if s.startswith("failed")]
    assert failed and all(len(s) <= len("failed: ") + 120 for s in failed)


def test_job_without_end_and_stage_without_completion(spark, tmp_path):
    evs = py_events()
    last_job = max(e["Job ID"] for e in evs if e["Event"] == J.JOB_START)
    last_stage = max(e["Stage Info"]["Stage ID"] for e in evs if "Stage Info" in e)
    kept = [e for e in evs
            if not (e["Event"] == J.JOB_END and e["Job ID"] == last_job)
            and not (e["Event"] == J.STAGE_COMPLETED and e["Stage Info"]["Stage ID"] == last_stage)]
    path = tmp_path / "cut.json"
    path.write_text("".join(json.dumps(e) + "\n" for e in kept))
    ev = J.read_event_log(spark, str(path))
    jobs = {r["job_id"]: r for r in J.job_log(ev).collect()}
    assert jobs[last_job]["status"] is None and jobs[last_job]["completion_time"] is None
    stages = {r["stage_id"]: r for r in J.stage_log(ev).collect()}
    assert stages[last_stage]["status"] is None and stages[last_stage]["num_tasks"] > 0


def test_step_job_times(events):
    got = {r["step"]: r for r in J.step_job_times(events).collect()}
    assert set(got) == {"sales_by_category", "window_ranking", "bad_cast"}
    assert got["window_ranking"]["jobs"] == 2 and got["window_ranking"]["stages"] == 3
    assert got["bad_cast"]["failed_jobs"] == 1
    assert all(r["wall_ms"] >= 0 for r in got.values())
    assert rows(J.step_job_times(events).select("step"))[0] == ("sales_by_category",)


def test_a_rolled_log_is_one_application(spark, tmp_path, events):
    """The same events spread over the files of one eventlog_v2 folder."""
    folder = tmp_path / "eventlog_v2_app-1"
    folder.mkdir()
    with open(FIXTURE) as fh:
        lines = fh.readlines()
    for i in range(5):
        (folder / f"events_{i + 1}_app-1").write_text("".join(lines[i::5]))
    rolled = J.read_event_log(spark, str(tmp_path / "*"))
    for table in (J.job_log, J.stage_log, J.step_job_times):
        assert rows(table(rolled).drop("app")) == rows(table(events).drop("app"))
