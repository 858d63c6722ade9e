"""Nested documents: rows gathered per key, written as JSON, read and unfolded.

A document holds its key columns and one array of structs, in order.  A key with
very many rows becomes several documents (``part`` 0, 1, ...; each of about
``max_items`` rows, in order in itself), so that no array, and no task, ever
holds a whole hot key.  Unfolding gives back the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one document, about.
MAX_ITEMS = 10_000

#: Where a document that is not JSON, or does not fit the schema, is kept.
CORRUPT = "_corrupt_record"


def to_documents(
    rows: DataFrame, key: list[str], order: list[str], fields: list[str], *, max_items: int = MAX_ITEMS
) -> DataFrame:
    """(key columns, part, items): the rows of a key as arrays of structs.

    Structs hold ``order`` and then ``fields``, and are sorted by them.  Rows of
    a key beyond ``max_items`` are dealt to its parts in turn.  Keys are compared
    null-safely, so rows without a key form documents of their own.

    One counting pass finds the keys to cut (at most one in ``max_items`` rows);
    the arrays come from one aggregation by key and part.
    """
    parts = (
        rows.groupBy(*key).count().filter(F.col("count") > max_items)
        .select(*(F.col(k).alias(f"_{k}") for k in key), F.ceil(F.col("count") / max_items).alias("_parts"))
    )
    match = F.lit(True)
    for k in key:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    # Numbers of rows as they are scanned: the same again if a task is repeated.
    dealt = (
        rows.withColumn("_nth", F.monotonically_increasing_id())
        .join(parts, match, "left")
        .withColumn("part", F.pmod("_nth", F.coalesce("_parts", F.lit(1))))
    )
    items = F.sort_array(F.collect_list(F.struct(*order, *fields)))
    return dealt.groupBy(*key, "part").agg(items.alias("items"))


def document_schema(rows: T.StructType, key: list[str], order: list[str], fields: list[str]) -> T.StructType:
    """The schema that documents made of ``rows`` are read with."""
    kind = {f.name: f.dataType for f in rows.fields}
    item = T.StructType([T.StructField(c, kind[c]) for c in [*order, *fields]])
    return T.StructType([
        *(T.StructField(k, kind[k]) for k in key),
        T.StructField("part", T.LongType()), T.StructField("items", T.ArrayType(item))])


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON document per line, one file per task.  Null cells stay as nulls,
    so every document has all its fields."""
    docs.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """Documents with a declared schema, and CORRUPT: the text of what did not fit.

    ``multi_line`` is for files that hold one document each, over several lines.
    """
    own = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(own)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=multi_line).json(path)
    )


def unfold(docs: DataFrame, items: str = "items", *, keep_empty: bool = False) -> DataFrame:
    """One row per item: the document's other columns, ``item_index`` within the
    document, and the item's fields.  Documents without items have no row, or one
    of NULLs if ``keep_empty``."""
    others = [c for c in docs.columns if c not in (items, CORRUPT)]
    each = F.posexplode_outer if keep_empty else F.posexplode
    return docs.select(*others, each(items).alias("item_index", "_item")).select(*others, "item_index", "_item.*")


def document_counts(docs: DataFrame) -> DataFrame:
    """One row: documents, those that could not be read, and items."""
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count(CORRUPT).alias("corrupt"),
        F.coalesce(F.sum(F.when(F.col("items").isNotNull(), F.size("items"))), F.lit(0)).alias("items"))
