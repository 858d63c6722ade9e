"""Write a small Spark event log for the job-log tests.

Runs three described steps (one of them fails under ANSI mode) on a fresh
local session with an uncompressed, unrolled event log, then copies the log
into tests/fixtures/eventlog/.  Only the four event kinds the job log reads
are kept, so the fixture stays small.

Usage: python scripts/make_eventlog_fixture.py
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import build_session  # noqa: E402

KEEP = {
    "SparkListenerJobStart",
    "SparkListenerJobEnd",
    "SparkListenerStageSubmitted",
    "SparkListenerStageCompleted",
}


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="tillroll-eventlog-")
    spark = build_session(
        "local[2]",
        app_name="tillroll-eventlog-fixture",
        shuffle_partitions=2,
        conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.sql.adaptive.enabled": "false",
        },
    )
    sc = spark.sparkContext
    sc.setJobDescription("sales_by_category")
    spark.range(0, 1000, 1, 2).selectExpr("id % 6 AS k", "id AS v").groupBy("k").sum("v").collect()
    sc.setJobDescription("window_ranking")
    spark.range(0, 100, 1, 2).selectExpr("id % 3 AS k", "id AS v").orderBy("k", "v").collect()
    sc.setJobDescription("bad_cast")
    try:
        spark.range(0, 10, 1, 2).selectExpr("CAST(concat('x', id) AS INT) AS n").collect()
    except Exception:
        pass
    sc.setJobDescription(None)
    spark.stop()
    (path,) = glob.glob(os.path.join(log_dir, "*"))
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "tests", "fixtures", "eventlog")
    os.makedirs(out_dir, exist_ok=True)
    with open(path) as src, open(os.path.join(out_dir, "app-events.json"), "w") as dst:
        for line in src:
            if json.loads(line).get("Event") in KEEP:
                dst.write(line)


if __name__ == "__main__":
    main()
