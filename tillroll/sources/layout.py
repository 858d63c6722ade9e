"""Physical layout: bucket the big input once so later joins skip a shuffle.

``lineitem`` is the table every report reads and the largest by far.
Written once as a bucketed table on the order key (sorted within buckets),
its join with ``orders`` no longer shuffles it: Spark reads each bucket as a
partition already hash-distributed on the key and shuffles only the other,
smaller side to match.  At 100 TB that removes the largest shuffle of every
report run, at the price of one rewrite.

Tables are saved through the session catalog with an explicit location
(``path``), so the files live wherever the caller says (shared storage on a
cluster) and nothing depends on a local warehouse folder.

Trade-off: with no shuffle on the lineitem side, AQE cannot split a skewed
bucket (skew splitting works on shuffle outputs).  When one order may hold
a large share of all line items, keep the default shuffled plan, which AQE
splits; bucketing is for steady data whose largest cost is the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.transactions import testdata_table

# Tables bucketed and their key; the others are read as they are.
BUCKET_KEYS = {"lineitem": "l_orderkey"}


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> str:
    """Write ``df`` as ``table`` at ``path``, bucketed and sorted on ``key``."""
    (
        df.write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return table


def bucket_testdata(
    spark: SparkSession, sf_dir: str, out_dir: str, buckets: int, prefix: str = "tillroll_"
) -> Callable[[str], DataFrame]:
    """Bucket the big TPC-H-like tables once; return a table reader.

    The reader maps a table name to the bucketed table where one exists and
    to the original parquet otherwise; pass it to
    ``testdata_transactions(..., read=...)``.
    """
    names = {}
    for name, key in BUCKET_KEYS.items():
        table = f"{prefix}{name}"
        save_bucketed(testdata_table(spark, sf_dir, name), table, key, buckets,
                      f"{out_dir.rstrip('/')}/{name}")
        names[name] = table

    def read(name: str) -> DataFrame:
        if name in names:
            return spark.table(names[name])
        return testdata_table(spark, sf_dir, name)

    return read
