"""Sources and sinks: CSV/parquet round trips, file sizes, the testdata view."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import report
from tillroll.schemas import TRANSACTION_COLUMNS
from tillroll.sources.files import file_sizes
from tillroll.sources.generate import gen_transactions
from tillroll.sources.sinks import write_csv, write_parquet
from tillroll.sources.transactions import bad_cells, read_transactions, testdata_transactions

from conftest import SF_SMALL, rows


def test_csv_round_trip_declared_and_inferred(spark, tmp_path):
    df = gen_transactions(spark, 2_000, partitions=3)
    path = write_csv(df, str(tmp_path / "csv"))
    back = read_transactions(spark, path)
    assert back.columns == TRANSACTION_COLUMNS
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    inferred = read_transactions(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["quantity"] == "int" and inferred.count() == 2_000


def test_single_file_sink_keeps_order(spark, tmp_path):
    stats = report.sales_by_category(gen_transactions(spark, 3_000, partitions=4))
    path = write_csv(stats, str(tmp_path / "one"), single_file=True, sort_by=["category"])
    files = [p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1
    back = spark.read.schema(stats.schema).csv(path, header=True)
    assert [r[0] for r in back.collect()] == sorted(r[0] for r in stats.collect())


def test_parquet_partitioned_sink(spark, tmp_path):
    df = gen_transactions(spark, 1_000, partitions=2)
    path = write_parquet(df, str(tmp_path / "pq"), partition_by=["region"])
    back = read_transactions(spark, path, fmt="parquet")
    assert back.filter(F.col("region") == "North").count() == df.filter(F.col("region") == "North").count()


def test_file_sizes(spark, tmp_path):
    df = gen_transactions(spark, 1_000, partitions=2)
    path = write_csv(df, str(tmp_path / "sz"))
    sizes = file_sizes(spark, [path])
    on_disk = {str(p): p.stat().st_size for p in (tmp_path / "sz").glob("part-*")}
    assert sorted(r[1] for r in rows(sizes)) == sorted(on_disk.values())
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "Aggregate" not in plan


def test_testdata_view_keeps_every_line_item(spark):
    fact = testdata_transactions(spark, SF_SMALL)
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert fact.count() == lineitem.count()
    assert fact.columns == TRANSACTION_COLUMNS
    assert fact.filter(F.col("transaction_id").isNull()).count() == 0


def test_json_round_trip(spark, tmp_path):
    from tillroll.sources.sinks import write_json

    df = gen_transactions(spark, 1_500, partitions=2)
    path = write_json(df, str(tmp_path / "js"))
    back = read_transactions(spark, path, fmt="json")
    assert back.columns == TRANSACTION_COLUMNS
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


HEADER = "transaction_id,date,category,product_name,quantity,unit_price,discount_pct,total_amount,region,customer_age,payment_method"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names = HEADER.split(",")
    swapped = [n for n in names if n not in ("quantity", "discount_pct")] + ["discount_pct", "extra", "quantity"]
    values = dict(zip(names, "7,2023-05-06,A,p,3,1.5,20,3.6,North,44,Cash".split(",")), extra="z")
    f = tmp_path / "t.csv"
    f.write_text(",".join(swapped) + "\n" + ",".join(values[n] for n in swapped) + "\n")
    r = read_transactions(spark, str(f)).first()
    assert (r.transaction_id, r.quantity, r.discount_pct, r.customer_age) == (7, 3, 20, 44)
    f.write_text(HEADER.replace("region,", "") + "\n")
    with pytest.raises(ValueError, match="region"):
        read_transactions(spark, str(f))


def test_csv_cells_that_do_not_fit(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_text(HEADER + "\n1,2023-05-06,A,p,three,1.5,20,3.6,North,44,Cash\n2,not a day,A,p,1,x,20,3.6,North,,Cash\n3,,A,p,1,1,2,3,,,\n")
    got = rows(read_transactions(spark, str(f)).select("transaction_id", "date", "quantity", "unit_price"))
    assert [(r[0], r[1] is None, r[2], r[3]) for r in got] == [
        (1, False, None, 1.5), (2, True, 1, None), (3, True, 1, 1.0)]
    assert rows(bad_cells(spark, str(f))) == [(3, 2)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|three"):
        read_transactions(spark, str(f), strict=True).collect()


def test_one_file_is_for_small_results(spark, tmp_path, monkeypatch):
    from tillroll.sources import sinks

    monkeypatch.setattr(sinks, "MAX_SINGLE_FILE_ROWS", 10)
    with pytest.raises(ValueError, match="many files"):
        sinks.write_csv(spark.range(11), str(tmp_path / "x"), single_file=True)
    sinks.write_csv(spark.range(10), str(tmp_path / "x"), single_file=True)


def test_one_file_is_written_in_one_run(spark, tmp_path):
    from tillroll.sources.sinks import write_json

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    for write, sort in ((write_csv, ["id"]), (write_csv, None), (write_json, None)):
        seen.value = 0
        more = {"sort_by": sort} if write is write_csv else {}
        write(spark.range(100).mapInPandas(counted, "id long"), str(tmp_path / "o"), single_file=True, **more)
        assert seen.value == 100
        assert len([p for p in (tmp_path / "o").iterdir() if p.name.startswith("part-")]) == 1


def test_csv_files_of_different_headers(spark, tmp_path):
    from tillroll.sources.transactions import read_folders

    line = ",2023-05-06,A,p,3,1.5,20,3.6,North,44,Cash\n"
    swapped = HEADER.replace("quantity", "?").replace("discount_pct", "quantity").replace("?", "discount_pct")
    (tmp_path / "a.csv").write_text(HEADER + "\n1" + line)
    (tmp_path / "b.csv").write_text(swapped + "\n2" + line)
    for read in (lambda p: read_transactions(spark, p).select("quantity").collect(),
                 lambda p: read_transactions(spark, p, strict=True).collect(),
                 lambda p: report.sales_by_category(read_transactions(spark, p)).collect(),
                 lambda p: bad_cells(spark, p).collect()):
        with pytest.raises(Exception, match="header"):
            read(str(tmp_path))
    both = read_folders(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted(rows(both.select("transaction_id", "quantity", "discount_pct"))) == [(1, 3, 20), (2, 20, 3)]
