"""Declared schemas: no inference pass over the data at read time."""

from pyspark.sql import types as T

# The flat retail fact table every report step reads.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount_pct", T.IntegerType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("customer_age", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

TRANSACTION_COLUMNS = [f.name for f in TRANSACTIONS.fields]

# One document per timed run of the report.
METRICS = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "steps",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("time_s", T.DoubleType()),
                        T.StructField("ram_mb", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("total_time_s", T.DoubleType()),
        T.StructField("peak_ram_mb", T.DoubleType()),
        T.StructField("row_count", T.LongType()),
    ]
)

# The subset of Spark's JSON event log the job and stage reports use.
# Optional fields (failure reason, exception, properties) are declared so a
# log without any failure still has the columns.
_STAGE_INFO = T.StructType(
    [
        T.StructField("Stage ID", T.LongType()),
        T.StructField("Stage Attempt ID", T.LongType()),
        T.StructField("Stage Name", T.StringType()),
        T.StructField("Number of Tasks", T.LongType()),
        T.StructField("Submission Time", T.LongType()),
        T.StructField("Completion Time", T.LongType()),
        T.StructField("Failure Reason", T.StringType()),
    ]
)

EVENT_LOG = T.StructType(
    [
        T.StructField("Event", T.StringType()),
        T.StructField("Job ID", T.LongType()),
        T.StructField("Submission Time", T.LongType()),
        T.StructField("Completion Time", T.LongType()),
        T.StructField("Stage IDs", T.ArrayType(T.LongType())),
        T.StructField(
            "Job Result",
            T.StructType(
                [
                    T.StructField("Result", T.StringType()),
                    T.StructField(
                        "Exception",
                        T.StructType([T.StructField("Message", T.StringType())]),
                    ),
                ]
            ),
        ),
        T.StructField("Properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("Stage Info", _STAGE_INFO),
    ]
)

# The TPC-H-like input tables, as measured on the driver's parquet files.
# Declaring them skips the footer read that schema inference does per table.
TPCH = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
