"""A hot order and a hot part, each holding a third of all line items:
results stay exact, and both of the view's sort-merge joins are split by AQE
instead of landing in one task.

AQE's skew thresholds are in bytes (256 MB by default), far above test data,
so this test lowers them for its own duration only.  AQE splits a skewed
reduce partition along map-output boundaries, so the skewed table is written
as several files, as any large table is.
"""

import contextlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.operators import report
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    for t in TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "lineitem":
            hot_order = df.agg(F.min("l_orderkey")).first()[0]
            hot_part = df.agg(F.min("l_partkey")).first()[0]
            # every third line item moves to one order and one part
            hot = F.abs(F.hash("l_orderkey", "l_linenumber", "l_partkey")) % 3 == 0
            df = (
                df.withColumn("_hot", hot)
                .withColumn("l_orderkey", F.when(F.col("_hot"), F.lit(hot_order)).otherwise(F.col("l_orderkey")))
                .withColumn("l_partkey", F.when(F.col("_hot"), F.lit(hot_part)).otherwise(F.col("l_partkey")))
                .drop("_hot")
            )
            # several files: AQE splits a skewed partition along map outputs
            df = df.repartition(8)
        df.write.parquet(str(out / f"{t}.parquet"))
    return str(out)


def _final_plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_is_split_and_results_exact(spark, skewed_dir):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        fact = testdata_transactions(spark, skewed_dir)
        li = spark.read.parquet(f"{skewed_dir}/lineitem.parquet")
        for key in ("l_orderkey", "l_partkey"):
            top = li.groupBy(key).count().orderBy(F.desc("count")).first()[1]
            assert top >= li.count() / 4
        df = report.sales_by_category(fact)
        got = df.collect()
        plan = _final_plan(df)
        # both lineitem joins (order key, part key) were split
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()["sales_by_category"]).fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)
