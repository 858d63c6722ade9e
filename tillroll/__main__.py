"""Command line: ``python -m tillroll <command> ...`` (or via spark-submit).

Commands:

  report    run the ten report steps (plain or tuned) over transactions,
            print each result, write the category CSV and a metric document
  generate  write N synthetic transactions as CSV or parquet
  compare   compare metric documents: summary, speedups, per-step table
  joblog    job, stage and per-step tables from a Spark event log

Every path is a Hadoop-compatible URI; nothing is hard-coded.
"""

from __future__ import annotations

import argparse
import json
import sys

from tillroll.session import build_session, scratch_path


def _load_fn(spark, args):
    from tillroll.sources.transactions import read_transactions, testdata_transactions

    if args.testdata:
        read = None
        if args.bucketed:
            from tillroll.sources.layout import bucket_testdata

            read = bucket_testdata(spark, args.testdata, args.bucketed, args.buckets)
        return lambda: testdata_transactions(spark, args.testdata, read=read)
    return lambda: read_transactions(spark, args.input, fmt=args.format, infer_schema=args.infer_schema)


def cmd_report(spark, args) -> int:
    from tillroll.plans.run import metrics_frame, run_report
    from tillroll.sources.sinks import write_json

    experiment = f"{'opt' if args.mode == 'tuned' else 'basic'}_{args.setup}"
    out = args.output or scratch_path(spark, experiment)
    record, results = run_report(
        spark, _load_fn(spark, args), experiment, mode=args.mode,
        out_path=f"{out}/category_stats", storage=args.storage,
        one_pass_groups=args.one_pass_groups, show=args.show,
    )
    for step, rows in results.items():
        print(f"-- {step}")
        for row in rows:
            print("   ", tuple(row))
    write_json(metrics_frame(spark, [record]), f"{out}/metrics", single_file=True)
    print(json.dumps(record))
    return 0


def cmd_generate(spark, args) -> int:
    from tillroll.sources.generate import gen_transactions
    from tillroll.sources.sinks import write_csv, write_parquet

    df = gen_transactions(spark, args.rows, args.partitions)
    if args.format == "csv":
        write_csv(df, args.output)
    else:
        write_parquet(df, args.output)
    print(f"wrote {args.rows} rows to {args.output}")
    return 0


def cmd_compare(spark, args) -> int:
    from tillroll.operators import runs

    df = runs.read_metrics(spark, args.metrics).cache()
    for title, fn in [
        ("summary", runs.metrics_summary),
        ("speedup tuned vs plain", runs.metrics_speedup),
        ("scaling 1 vs 3 nodes", runs.metrics_scaling),
        ("per-step speedup", runs.metrics_step_speedup),
        ("step x run times", runs.metrics_step_matrix),
    ]:
        print(f"-- {title}")
        for row in fn(df).toLocalIterator():
            print("   ", tuple(row))
    return 0


def cmd_joblog(spark, args) -> int:
    from tillroll.operators import joblog

    ev = joblog.read_event_log(spark, args.eventlog).cache()
    for title, fn in [
        ("jobs", joblog.job_log),
        ("stages", joblog.stage_log),
        ("steps", joblog.step_job_times),
    ]:
        print(f"-- {title}")
        fn(ev).show(args.show, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tillroll")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("report")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="transactions file or folder")
    src.add_argument("--testdata", help="folder with the TPC-H-like parquet tables")
    r.add_argument("--bucketed", help="with --testdata: write lineitem bucketed on the "
                   "order key to this folder first, and join from it")
    r.add_argument("--buckets", type=int, default=64)
    r.add_argument("--format", default="csv", choices=["csv", "parquet", "json"])
    r.add_argument("--infer-schema", action="store_true")
    r.add_argument("--mode", default="plain", choices=["plain", "tuned", "onepass"])
    r.add_argument("--one-pass-groups", action="store_true",
                   help="tuned mode: the five group-bys from one shared aggregate")
    r.add_argument("--storage", default="cache", choices=["cache", "table", "checkpoint", "none"])
    r.add_argument("--setup", default="local", help="label in the experiment name")
    r.add_argument("--output", help="result folder (default: under spark.checkpoint.dir)")
    r.add_argument("--show", type=int, default=20)

    g = sub.add_parser("generate")
    g.add_argument("--rows", type=int, default=120_000)
    g.add_argument("--partitions", type=int, default=None)
    g.add_argument("--format", default="csv", choices=["csv", "parquet"])
    g.add_argument("--output", required=True)

    c = sub.add_parser("compare")
    c.add_argument("--metrics", required=True, help="folder or glob of metric documents")

    j = sub.add_parser("joblog")
    j.add_argument("--eventlog", required=True, help="event-log file, folder or glob")
    j.add_argument("--show", type=int, default=100)

    args = p.parse_args(argv)
    if getattr(args, "storage", None) == "none":
        args.storage = None
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    spark.sparkContext.setLogLevel("ERROR")
    try:
        return {
            "report": cmd_report,
            "generate": cmd_generate,
            "compare": cmd_compare,
            "joblog": cmd_joblog,
        }[args.command](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
