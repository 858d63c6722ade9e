from tillroll.plans.sizing import input_bytes, size_shuffles

from conftest import SF_SMALL

PATHS = [f"{SF_SMALL}/{t}.parquet" for t in ["lineitem", "orders", "part"]]


def test_size_shuffles(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        total = input_bytes(spark, PATHS)
        assert total > 0
        assert size_shuffles(spark, PATHS, min_partitions=3) == 3
        n = size_shuffles(spark, PATHS, target_bytes=max(1, total // 50), min_partitions=1)
        assert 50 <= n <= 51
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_adv)
