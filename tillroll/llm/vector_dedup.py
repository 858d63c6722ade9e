"""Near-duplicate vectors by p-stable hashing.

A vector of length one is projected on random normal directions; a projection
plus a random shift, cut into steps of ``WIDTH``, is one number, and a few such
numbers together are a bucket.  Vectors at a small Euclidean distance often
share a bucket, and there are enough tables of buckets that a pair at the
threshold shares one with probability ``recall`` at least.  Whatever shares a
bucket is compared by its exact cosine in double precision.

The numbers per bucket follow from the rows of the largest label: with them
some ``CHANCE`` unrelated (orthogonal) vectors share a bucket, at every size.

Scale: equal vectors are one node with a weight, so copies are never paired.  A
pair counts in the first table in which it meets, so partners add up without
listing pairs, and a bucket hands on a star per connected group, not its pairs.
A bucket of more than ``TILE`` nodes is cut into tiles, and each pair of tiles is
a group of its own.  Distinct vectors that all lie close together have to be
compared with each other (the result counts each one's partners): that work,
not the rows, is quadratic in the size of such a bunch.  Tables are
taken a few at a time, and each round's shuffle is let go before the next.

Defined results: a vector that is null, zero, empty or holds a null or
non-finite number, or whose label is null, has no link.  Vectors of different
dimensions never link.  A component's id is its smallest id that is not null;
repeated rows keep their rows.  Other input columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import apart, materialize, release
from tillroll.llm.components import components

#: Step of a projection; unit vectors at the threshold of 0.93 are 0.37 apart.
WIDTH = 2.0

#: Unrelated vectors that share a bucket, on average.
CHANCE = 16

#: Nodes of a bucket beyond which it is cut, and tables of one round.
TILE, ROUND = 512, 2

SEED = 20240229

#: Cosines this close to the threshold are computed again, one by one.
_DOUBT = 1e-9

#: Candidate pairs multiplied at once.
_PAIRS = 1 << 17


def meeting(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts two points at ``distance`` in one step."""
    r = width / distance
    return (math.erf(r / math.sqrt(2))
            - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2)))


def plan_tables(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """(projections per bucket, tables) for so many rows of one label."""
    near, far = meeting(math.sqrt(2 - 2 * threshold)), meeting(math.sqrt(2))
    size = max(1, math.ceil(math.log(max(rows, 1) / CHANCE) / -math.log(far))) if rows > CHANCE else 1
    return size, math.ceil(math.log(1 - recall) / math.log(1 - near ** size))


def usable(vec: Column, label: Column) -> Column:
    """True for a vector that can link with others."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest part first, against overflow."""
    big = values / np.abs(values).max(axis=1, keepdims=True)
    return big / np.sqrt(np.einsum("ij,ij->i", big, big))[:, None]


def _matrices(column: pa.ListArray):
    """(row indices, matrix) for every dimension that occurs in a column of lists."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield rows, flat[starts[rows][:, None] + np.arange(dim)].astype(np.float64)


def _directions(dim: int, table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The random directions and shifts of one table, the same in every task."""
    draw = np.random.default_rng([SEED, dim, table])
    return draw.standard_normal((dim, size)), draw.uniform(0, WIDTH, size)


def _mixed(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash per row of whole numbers."""
    h = np.full(len(values), 0x9E3779B97F4A7C15, np.uint64)
    for column in values.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def with_buckets(nodes: DataFrame, size: int, tables: int) -> DataFrame:
    """``nodes`` (vec and others) with ``buckets``: the bucket in each table."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, tables), np.int64)
            for rows, values in _matrices(batch.column("vec")):
                unit = _unit(values)
                for t in range(tables):
                    axes, shift = _directions(values.shape[1], t, size)
                    steps = np.floor((unit @ axes + shift) / WIDTH)
                    out[rows, t] = _mixed(np.column_stack([steps, np.full(len(rows), values.shape[1])]))
            offsets = pa.array(np.arange(0, out.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))],
                names=schema.names)

    return nodes.mapInArrow(run, schema)


def _least(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest member of each of n nodes' connected group."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
    return label


class _Block:
    """Whole groups of candidates, sorted by group."""

    def __init__(self, batch: pa.RecordBatch, threshold: float):
        self.threshold = threshold
        self.group = np.cumsum(_changes(batch))
        self.node = batch.column("node").to_numpy()
        self.weight = batch.column("weight").to_numpy()
        self.side = batch.column("side").to_numpy()
        self.split = batch.column("low").to_numpy() != batch.column("high").to_numpy()
        self.unit = [(rows, _unit(m)) for rows, m in _matrices(batch.column("vec"))]
        before = batch.column("earlier")
        sizes = np.diff(before.offsets.to_numpy())
        self.earlier = np.zeros((batch.num_rows, max(1, sizes.max(initial=0))), np.int64)
        filled = np.arange(self.earlier.shape[1]) < sizes[:, None]
        self.earlier[filled] = before.flatten().to_numpy(zero_copy_only=False)
        self.tables = sizes

    def pairs(self):
        """(i, j) of rows that link and did not meet in an earlier table."""
        for rows, unit in self.unit:
            group = self.group[rows]
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.append(first, len(rows)))
            # All groups of a few rows at once, by distance within the group ...
            small = sizes <= 64
            inside = np.repeat(small, sizes)
            for step in range(1, sizes[small].max(initial=0)):
                at = np.flatnonzero(inside[:-step] & inside[step:] & (group[:-step] == group[step:]))
                for k in range(0, len(at), _PAIRS):
                    i = at[k:k + _PAIRS]
                    j = i + step
                    cosine = np.einsum("ij,ij->i", unit[i], unit[j])
                    yield self._new(rows[i], rows[j], cosine >= self.threshold)
            # ... and the others a product each.
            for s, n in zip(first[~small].tolist(), sizes[~small].tolist()):
                for k in range(s, s + n, TILE):
                    stop = min(k + TILE, s + n)
                    cosine = unit[k:stop] @ unit[s:s + n].T
                    i, j = np.nonzero(cosine >= self.threshold - _DOUBT)
                    i, j, near = i + k, j + s, cosine[i, j]
                    i, j, near = i[i < j], j[i < j], near[i < j]
                    doubt = np.flatnonzero(near < self.threshold + _DOUBT)
                    near[doubt] = np.einsum("ij,ij->i", unit[i[doubt]], unit[j[doubt]])
                    yield self._new(rows[i], rows[j], near >= self.threshold)

    def _new(self, i: np.ndarray, j: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = i[near], j[near]
        apart_ = ~self.split[i] | (self.side[i] != self.side[j])
        i, j = i[apart_], j[apart_]
        for t in range(self.tables[i].max(initial=0)):
            new = (t >= self.tables[i]) | (self.earlier[i, t] != self.earlier[j, t])
            i, j = i[new], j[new]
        return i, j

    def result(self) -> pa.RecordBatch:
        """(node, links, root): the weight of partners, and a node of its group."""
        links = np.zeros(len(self.node), np.int64)
        label = np.arange(len(self.node))
        for i, j in self.pairs():
            np.add.at(links, i, self.weight[j])
            np.add.at(links, j, self.weight[i])
            # Groups found so far count as links, so that no list of pairs is kept.
            own = np.flatnonzero(label != np.arange(len(label)))
            label = _least(len(label), np.concatenate([i, own]), np.concatenate([j, label[own]]))
        met = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(self.node[met]), pa.array(links[met]), pa.array(self.node[label[met]])],
            names=["node", "links", "root"])


_GROUP = ["table", "bucket", "lab", "low", "high"]


def _changes(batch: pa.RecordBatch) -> np.ndarray:
    """True where a row belongs to another group than the row before."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in _GROUP:
        c = batch.column(name).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return new


def _compare(threshold: float):
    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < TILE:
                continue
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            last = np.flatnonzero(_changes(table))[-1]
            held = [table.slice(last)]
            if last:
                yield _Block(_own(table.slice(0, last)), threshold).result()
        if held and sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield _Block(_own(table), threshold).result()

    return run


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A slice with buffers of its own, so that list offsets start at zero."""
    return batch.take(pa.array(np.arange(batch.num_rows)))


def _round(nodes: DataFrame, hot: DataFrame, tables: range, threshold: float) -> DataFrame:
    """(node, links, root) from some of the tables."""
    met = nodes.select(
        "node", "lab", "weight", "vec", "buckets",
        F.explode(F.array(*(F.lit(t) for t in tables))).alias("table"),
    ).select(
        "table", F.expr("buckets[table]").alias("bucket"), "lab", "node", "weight", "vec",
        F.expr("slice(buckets, 1, table)").alias("earlier"))
    cut = met.join(hot, ["table", "bucket", "lab"], "left").withColumn(
        "tiles", F.coalesce("tiles", F.lit(1))).withColumn("side", F.pmod(F.xxhash64("node"), "tiles"))
    dealt = cut.withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)"))).select(
        "table", "bucket", "lab", F.least("side", "other").alias("low"),
        F.greatest("side", "other").alias("high"), "side", "node", "weight", "vec", "earlier")
    return dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(
        _compare(threshold), "node long, links long, root long")


def vector_links(
    rows: DataFrame, *, threshold: float = 0.93, recall: float = 0.995,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per row of ``rows``: its id, n_links (other rows it links with) and
    component_id (the smallest id reachable by links).

    Rows link when their labels are equal and their cosine is ``threshold`` or more.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    good = usable(F.col("vec"), F.col("label"))
    distinct, distinct_path = materialize(
        base.filter(good).groupBy("label", "vec")
        .agg(F.count("*").alias("weight"), F.min("id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    size, tables = plan_tables(largest, threshold, recall)
    nodes, nodes_path = materialize(
        with_buckets(distinct.select("node", "weight", "vec", F.xxhash64("label").alias("lab")), size, tables),
        "vector-buckets")
    hot, _ = materialize(
        nodes.select(F.posexplode("buckets").alias("table", "bucket"), "lab")
        .groupBy("table", "bucket", "lab").count().filter(F.col("count") > TILE)
        .select("table", "bucket", "lab", F.ceil(F.col("count") / TILE).alias("tiles")), "hot-buckets")
    found = []
    for at in range(0, tables, ROUND):
        part = range(at, min(at + ROUND, tables))
        done, path = materialize(_round(nodes, hot, part, threshold), "vector-links")
        found.append(path)
        release(spark)
    release(spark, nodes_path)
    met = spark.read.schema(done.schema).parquet(*found)
    partners = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named, _ = materialize(
        distinct.join(partners, "node", "left")
        .join(groups, "node", "left")
        .select("label", "vec", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component")), "vector-groups")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    whole = named.withColumn("k", apart(F.col("component"))).join(
        least.select(apart(F.col("component")).alias("k"), "component_id"), "k").select(
        "label", "vec", "n_links", "component_id")
    release(spark, distinct_path, *found)
    linked = base.filter(good).join(whole, ["label", "vec"]).select("id", "n_links", "component_id")
    alone = base.filter(~good).select("id", F.lit(0).cast("long"), "id")
    return linked.union(alone).withColumnRenamed("id", id_col)
