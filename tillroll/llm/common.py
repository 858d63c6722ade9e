"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import scratch_path

#: Bytes of text that one step of a Python worker holds at a time.
BATCH_BYTES = 1 << 20

#: ASCII white space: words are the maximal runs of anything else.
ASCII_SPACE = " \t\n\r\x0b\x0c"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session.

    Needed where it is not installed on them; Spark's own file server moves it.
    """
    sc, root = spark.sparkContext, Path(__file__).parents[1]
    if root.is_dir() and not any(f.endswith("/tillroll.zip") for f in sc.listFiles):
        made = shutil.make_archive(
            f"{tempfile.mkdtemp()}/tillroll", "zip", root.parent, root.name)
        sc.addPyFile(made)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else (``F.lower`` also folds other letters)."""
    return F.translate(col, _UPPER, _UPPER.lower())


def texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with a null text read as empty; every other column is left out."""
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def text_id(text: Column) -> Column:
    """128 bits of a text (binary), to tell rows apart that share a doc_id."""
    return F.unhex(F.md5(text))


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each.

    A single longer value stays whole, in a batch of its own.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def apart(key: Column) -> Column:
    """A long join key that no earlier grouping by ``key`` already distributes.

    A sort-merge join over it shuffles both sides by itself, and only then can
    adaptive execution split a hot key of one side over several tasks.
    """
    return key.bitwiseXOR(F.lit(1))


def arrow_map(df: DataFrame, column: str, fn: Callable, schema: str,
              limit: int = BATCH_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of about ``limit`` bytes of ``column``.

    ``fn`` turns one record batch into a dict of columns.
    """
    names = T.StructType.fromDDL(schema).names

    def run(batches):
        for batch in by_bytes(batches, column, limit):
            out = fn(batch)
            yield pa.RecordBatch.from_pydict({n: out[n] for n in names})

    return df.mapInArrow(run, schema)


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage where a lost executor would otherwise repeat everything
    before.  Returns the frame and the path, for :func:`release`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later plan reads.

    Spark deletes the shuffle files of finished stages when the driver's JVM
    finds them unreachable, so a collection is asked for as well.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    jvm.System.gc()
