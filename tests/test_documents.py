"""Nested documents: gathered, written as JSON, read with a schema, unfolded."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tillroll.operators import documents as report
from tillroll.sources import documents


@pytest.fixture
def lines(spark):
    data = [(k, i, f"x{i}", float(i)) for k in (1, 2, None) for i in (3, 1, 2)]
    data += [(9, i % 7, "hot", 0.5) for i in range(200)] + [(4, None, None, None)]
    return spark.createDataFrame(data, "k long, line int, name string, amount double").repartition(5)


def test_arrays_are_sorted_and_bounded(lines):
    docs = documents.to_documents(lines, ["k"], ["line"], ["name", "amount"], max_items=20).collect()
    assert {d.k for d in docs} == {1, 2, 4, 9, None}
    for d in docs:
        assert [tuple(i) for i in d["items"]] == sorted(map(tuple, d["items"]), key=repr)
    hot = [d for d in docs if d.k == 9]
    assert len(hot) == 10 and {d.part for d in hot} == set(range(10))
    assert max(len(d["items"]) for d in hot) <= 20 + 5 * 4  # a task's numbering starts anew
    assert sum(len(d["items"]) for d in docs) == lines.count()


def test_round_trip(spark, lines, tmp_path):
    args = ["k"], ["line"], ["name", "amount"]
    docs = documents.to_documents(lines, *args, max_items=30)
    path = documents.write_documents(docs, str(tmp_path / "d"))
    back = documents.read_documents(spark, path, documents.document_schema(lines.schema, *args))
    flat = documents.unfold(back)
    assert flat.columns == ["k", "part", "item_index", "line", "name", "amount"]
    assert sorted(rows(flat.select(lines.columns)), key=repr) == sorted(rows(lines), key=repr)
    assert rows(documents.document_counts(back))[0][1:] == (0, lines.count())


def test_what_does_not_fit_is_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"k":1,"part":0,"items":[{"line":1,"name":"a","amount":2.5}]}\n'
        "not json\n"
        '{"k":"one","part":0,"items":[]}\n'
        '{"k":2,"part":0}\n{"k":3,"part":0,"items":[],"extra":{"deep":[1]}}\n')
    schema = documents.document_schema(
        spark.createDataFrame([], "k long, line int, name string, amount double").schema,
        ["k"], ["line"], ["name", "amount"])
    docs = documents.read_documents(spark, str(tmp_path), schema).cache()
    assert rows(documents.document_counts(docs)) == [(5, 2, 1)]
    assert rows(documents.unfold(docs)) == [(1, 0, 0, 1, "a", 2.5)]
    kept = documents.unfold(docs.filter(F.col(documents.CORRUPT).isNull()), keep_empty=True)
    assert sorted(r[0] for r in rows(kept)) == [1, 2, 3]


def test_pretty_printed_documents(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"{i}.json").write_text('{\n "k": %d,\n "part": 0,\n "items": [\n  {"line": 7}\n ]\n}' % i)
    schema = "k long, part long, items array<struct<line:int,name:string>>"
    from pyspark.sql.types import StructType

    docs = documents.read_documents(spark, str(tmp_path), StructType.fromDDL(schema), multi_line=True)
    assert sorted(rows(documents.unfold(docs))) == [(1, 0, 0, 7, None), (2, 0, 0, 7, None)]


def test_empty_table(spark, lines):
    docs = report.nested(lines.limit(0), ["k"], ["line"], ["name"])
    assert rows(documents.unfold(docs)) == [] and rows(documents.document_counts(docs)) == [(0, 0, 0)]


def test_parts_do_not_change_the_report(spark):
    flat = report.order_lines(spark, SF_SMALL)
    args = report.ORDER_KEY, report.LINE_ORDER, report.LINE_FIELDS
    whole, cut = (report.nested(flat, *args, max_items=n) for n in (1000, 2))
    assert cut.count() > whole.count() == flat.select("order_id").distinct().count()
    for step in (report.lines_by_position, report.order_sizes):
        assert rows(step(whole)) == rows(step(cut))


def test_hot_key_is_joined_without_meeting_in_one_task(lines):
    """Parts of a hot key are groups of their own in the shuffle."""
    docs = documents.to_documents(lines, ["k"], ["line"], ["name"], max_items=20)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "part" in plan.split("hashpartitioning(k")[1][:40]
