"""Run the whole report step by step, timed, and emit a metric record.

Every step runs under ``setJobDescription(<step>)``, so a Spark event log of
the run can be grouped per step afterwards (``tillroll.operators.joblog``).
Steps bring the first rows of their results to the driver, as ``show`` does.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import report
from tillroll.operators.runs import CANONICAL_STEPS
from tillroll.plans.onepass import one_pass
from tillroll.plans.tuned import tuned_report
from tillroll.schemas import METRICS
from tillroll.session import scratch_path
from tillroll.sources.sinks import write_csv

#: Rows of each result that are brought to the driver.
SHOWN_ROWS = 100


class _Timer:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.steps: list[dict] = []
        self.results: dict[str, list] = {}

    def run(self, name: str, action: Callable[[], object]) -> object:
        self.spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        try:
            out = action()
        finally:
            self.spark.sparkContext.setJobDescription(None)
        self.steps.append({"name": name, "time_s": round(time.perf_counter() - start, 3), "ram_mb": None})
        if isinstance(out, list):
            self.results[name] = out
        return out


def run_report(
    spark: SparkSession,
    load: Callable[[], DataFrame],
    experiment: str,
    mode: str = "plain",
    out_path: str | None = None,
    storage: str | None = "cache",
    one_pass_groups: bool = False,
    show: int = SHOWN_ROWS,
) -> tuple[dict, dict[str, list]]:
    """Run the ten steps; return (metric record, collected step results).

    ``mode="plain"`` recomputes every step from the source, as the plain
    app does; ``mode="tuned"`` runs inside ``tuned_report`` (optionally with
    the five group-bys from one shared aggregate, ``one_pass_groups``);
    ``mode="onepass"`` reads the source like plain, but computes the five
    group-by steps from one shared aggregate (``plans.onepass``) and records
    that aggregate as an extra ``grouped_aggregate`` step.
    """
    timer = _Timer(spark)
    out_path = out_path or scratch_path(spark, f"{experiment}-category_stats")
    total_start = time.perf_counter()
    if mode == "plain":
        fact = load()
        shape = timer.run("load_data", lambda: report.load_shape(fact).collect())
        steps = [
            ("basic_stats", report.column_profile),
            ("sales_by_category", report.sales_by_category),
            ("sales_by_region", report.sales_by_region),
            ("top_products", report.top_products),
            ("monthly_trends", report.monthly_trends),
            ("age_group_analysis", report.age_group_analysis),
            ("payment_analysis", report.payment_analysis),
            ("window_ranking", report.window_ranking),
        ]
        for name, fn in steps:
            timer.run(name, lambda fn=fn: fn(fact).take(show))
        timer.run(
            "save_to_hdfs",
            lambda: write_csv(report.sales_by_category(fact), out_path, single_file=True),
        )
        row_count = shape[0]["row_count"]
    elif mode == "tuned":
        fact = load()
        start = time.perf_counter()
        spark.sparkContext.setJobDescription("load_and_cache")
        with tuned_report(fact, storage=storage, one_pass_groups=one_pass_groups) as tuned:
            shape = tuned.load_shape().collect()
            spark.sparkContext.setJobDescription(None)
            timer.steps.append(
                {"name": "load_and_cache", "time_s": round(time.perf_counter() - start, 3), "ram_mb": None}
            )
            for name in CANONICAL_STEPS[1:-1]:
                label = "top_products_with_broadcast" if name == "top_products" else name
                timer.run(label, lambda name=name: getattr(tuned, name)().take(show))
            timer.run("save_to_hdfs", lambda: tuned.save(out_path))
        row_count = shape[0]["row_count"]
    elif mode == "onepass":
        # Plain source, but the five group-by steps share one aggregate.
        fact = load()
        shape = timer.run("load_data", lambda: report.load_shape(fact).collect())
        timer.run("basic_stats", lambda: report.column_profile(fact).take(show))
        with ExitStack() as stack:
            grouped = timer.run("grouped_aggregate", lambda: stack.enter_context(one_pass(fact)))
            for name in CANONICAL_STEPS[2:-1]:
                if name in grouped:
                    timer.run(name, lambda name=name: grouped[name].take(show))
                elif name == "top_products":
                    timer.run(name, lambda: report.top_products(fact).take(show))
                else:
                    timer.run(name, lambda: report.window_ranking(fact).take(show))
            timer.run(
                "save_to_hdfs",
                lambda: write_csv(grouped["sales_by_category"], out_path, single_file=True),
            )
        row_count = shape[0]["row_count"]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    record = {
        "experiment": experiment,
        "timestamp": dt.datetime.now().isoformat(),
        "steps": timer.steps,
        "total_time_s": round(time.perf_counter() - total_start, 3),
        "peak_ram_mb": None,
        "row_count": int(row_count),
    }
    return record, timer.results


def metrics_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Metric records as a DataFrame with the declared nested schema."""
    return spark.createDataFrame(records, METRICS)
