"""Comparison of timed report runs, over metric JSON documents.

A metric document (one per run, ``tillroll.schemas.METRICS``) holds the
run's steps with their times.  These functions turn a directory of them into
the comparison tables: steps per run, a per-run summary, total speedup per
setup, scaling per variant, per-step speedup, and the step x run matrix.

The inputs are small by nature (one row per run), but every function is an
ordinary DataFrame job with no driver-side loop, so it takes any number of
runs: pairing is a conditional aggregation by key, never a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import METRICS

# Run names, their display order and labels, the step-name
# aliases of the tuned app, and the ten canonical steps in report order.
EXPERIMENTS = ["basic_1dn", "opt_1dn", "basic_3dn", "opt_3dn"]
LABELS = {
    "basic_1dn": "Basic / 1 DataNode",
    "opt_1dn": "Optimized / 1 DataNode",
    "basic_3dn": "Basic / 3 DataNodes",
    "opt_3dn": "Optimized / 3 DataNodes",
}
STEP_ALIASES = {
    "load_and_cache": "load_data",
    "top_products_with_broadcast": "top_products",
}
CANONICAL_STEPS = [
    "load_data", "basic_stats", "sales_by_category", "sales_by_region",
    "top_products", "monthly_trends", "age_group_analysis",
    "payment_analysis", "window_ranking", "save_to_hdfs",
]
BASELINE_VARIANT, TUNED_VARIANT = "basic", "opt"
SETUPS = ["1dn", "3dn"]


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric documents under ``path`` (a file, folder or glob).

    Each file holds one pretty-printed document, hence ``multiLine``.  A run
    whose file is missing simply contributes no row.
    """
    return spark.read.schema(METRICS).option("multiLine", True).json(path)


def _map_literal(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def _variant(exp: Column) -> Column:
    return F.regexp_extract(exp, r"^(.*)_([^_]*)$", 1)


def _setup(exp: Column) -> Column:
    return F.regexp_extract(exp, r"^(.*)_([^_]*)$", 2)


def metrics_steps(runs: DataFrame) -> DataFrame:
    """One row per (run, step), step names with the tuned aliases mapped.

    A name without an alias passes through (a map miss is NULL).
    """
    exploded = runs.select("experiment", F.posexplode("steps").alias("step_index", "s"))
    name = F.col("s.name")
    return exploded.select(
        "experiment",
        "step_index",
        F.coalesce(F.element_at(_map_literal(STEP_ALIASES), name), name).alias("step"),
        F.col("s.time_s").alias("time_s"),
        F.col("s.ram_mb").alias("ram_mb"),
    )


def _run_order(exp: Column) -> Column:
    return F.array_position(F.array(*[F.lit(e) for e in EXPERIMENTS]), exp)


def metrics_summary(runs: DataFrame) -> DataFrame:
    """Per run: label, total, peak RAM, rows (NULL when absent), the known runs
    in their fixed order and then all others by name, plus the largest total
    (the chart's axis bound).  A run without a fixed label is its own label."""
    name = F.col("experiment")
    order = F.nullif(_run_order(name), F.lit(0))
    max_total = runs.agg(F.max("total_time_s")).scalar()
    return runs.select(
        "experiment",
        F.coalesce(F.element_at(_map_literal(LABELS), name), name).alias("label"),
        "total_time_s",
        "peak_ram_mb",
        "row_count",
        max_total.alias("max_total_time_s"),
        order.alias("run_order"),
    ).orderBy(F.asc_nulls_last("run_order"), "experiment")


def _pair(df: DataFrame, key: Column, side: Column, a: str, b: str, value: str) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(
        F.max(F.when(side == a, F.col(value))).alias("a"),
        F.max(F.when(side == b, F.col(value))).alias("b"),
        F.sum(F.when(side == a, 1).otherwise(0)).alias("na"),
        F.sum(F.when(side == b, 1).otherwise(0)).alias("nb"),
    )


def metrics_speedup(runs: DataFrame) -> DataFrame:
    """Total speedup basic / tuned per setup, for setups with both runs."""
    exp = F.col("experiment")
    paired = _pair(runs, _setup(exp), _variant(exp), BASELINE_VARIANT, TUNED_VARIANT, "total_time_s")
    return (
        paired.filter((F.col("na") > 0) & (F.col("nb") > 0))
        .select(
            F.col("key").alias("setup"),
            F.col("a").alias("basic_total_s"),
            F.col("b").alias("opt_total_s"),
            F.round(F.col("a") / F.col("b"), 2).alias("speedup"),
        )
        .orderBy("setup")
    )


def metrics_scaling(runs: DataFrame) -> DataFrame:
    """Total time 1 node / 3 nodes per variant, for variants with both."""
    exp = F.col("experiment")
    paired = _pair(runs, _variant(exp), _setup(exp), SETUPS[0], SETUPS[1], "total_time_s")
    return (
        paired.filter((F.col("na") > 0) & (F.col("nb") > 0))
        .select(
            F.col("key").alias("variant"),
            F.col("a").alias("total_1dn_s"),
            F.col("b").alias("total_3dn_s"),
            F.round(F.col("a") / F.col("b"), 2).alias("ratio"),
        )
        .orderBy(F.array_position(F.array(F.lit(BASELINE_VARIANT), F.lit(TUNED_VARIANT)), F.col("variant")))
    )


def _first_time(steps: DataFrame) -> DataFrame:
    """Time of the first occurrence of each step in each run."""
    return steps.groupBy("experiment", "step").agg(
        F.min_by("time_s", "step_index").alias("time_s")
    )


def metrics_step_speedup(runs: DataFrame) -> DataFrame:
    """Per setup with both runs, per canonical step: basic / tuned time.

    A step missing from a run counts as 0.0 s; a tuned time of 0 gives 1.0.
    """
    exp = F.col("experiment")
    times = _first_time(metrics_steps(runs))
    setups = (
        runs.select(_setup(exp).alias("setup"), _variant(exp).alias("variant"))
        .groupBy("setup")
        .agg(
            F.max(F.when(F.col("variant") == BASELINE_VARIANT, True)).alias("has_a"),
            F.max(F.when(F.col("variant") == TUNED_VARIANT, True)).alias("has_b"),
        )
        .filter(F.col("has_a") & F.col("has_b"))
    )
    steps = F.array(*[F.lit(s) for s in CANONICAL_STEPS])
    grid = setups.select("setup", F.posexplode(steps).alias("step_order", "step"))
    per_step = times.groupBy(_setup(exp).alias("setup"), "step").agg(
        F.max(F.when(_variant(exp) == BASELINE_VARIANT, F.col("time_s"))).alias("b"),
        F.max(F.when(_variant(exp) == TUNED_VARIANT, F.col("time_s"))).alias("o"),
    )
    joined = grid.join(per_step, ["setup", "step"], "left").select(
        "setup",
        "step_order",
        "step",
        F.coalesce("b", F.lit(0.0)).alias("basic_time_s"),
        F.coalesce("o", F.lit(0.0)).alias("opt_time_s"),
    )
    return joined.select(
        "*",
        F.when(F.col("opt_time_s") > 0, F.col("basic_time_s") / F.col("opt_time_s"))
        .otherwise(F.lit(1.0))
        .alias("speedup"),
    ).orderBy("setup", "step_order")


def metrics_step_matrix(runs: DataFrame) -> DataFrame:
    """Canonical steps x runs, time per cell, 0.0 where missing.

    The known runs have their columns always; other runs follow by name.
    """
    others = runs.filter(~F.col("experiment").isin(EXPERIMENTS)).select("experiment").distinct()
    names = EXPERIMENTS + sorted(r[0] for r in others.collect())
    times = _first_time(metrics_steps(runs))
    pivoted = times.groupBy("step").pivot("experiment", names).agg(F.first("time_s"))
    steps = (
        runs.select(F.posexplode(F.array(*[F.lit(s) for s in CANONICAL_STEPS])).alias("step_order", "step"))
        .dropDuplicates(["step"])
    )
    out = steps.join(pivoted, "step", "left")
    return out.select(
        "step_order",
        "step",
        *[F.coalesce(F.col(f"`{e}`"), F.lit(0.0)).alias(e) for e in names],
    ).orderBy("step_order")
