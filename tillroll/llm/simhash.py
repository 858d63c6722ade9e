"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64 bits over word shingles.  Two fingerprints at distance r or
less agree, in one of their two halves, up to r // 2 bits.  So every distinct
fingerprint is filed under its two halves, looks up each half's small Hamming
ball, and the full distance of what it finds is verified.

Rows: copies share a fingerprint and count once.  A half under which more than
``HOT_HALF`` distinct fingerprints are filed would pair all of them; those
fingerprints are linked in linear space instead, over points of the Hamming cube
(see :func:`_cube_links`), so that no link is lost and no group is paired up.

Defined results: a null or empty text has fingerprint zero, linked like any
other.  Repeated rows and null ids keep their rows; a component's id is its
smallest id that is not null.  Other input columns are left out.
"""

from __future__ import annotations

import json
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import apart, arrow_map, materialize, release, text_id, texts
from tillroll.llm.components import components

SEED = 42

#: Distinct fingerprints under one half beyond which they are linked over the cube.
HOT_HALF = 64

#: Shingles whose bits are counted at once.
_CHUNK = 1 << 15


def fingerprint(text: str, width: int) -> int:
    """64-bit SimHash, unsigned, of the word shingles of one text."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), _CHUNK):
        hashes = [digest(joined[s:e], SEED)
                  for s, e in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, tid, fp): the fingerprint as a signed long; tid is the text's 128 bits."""
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn("tid", text_id(F.col("text")))

    def hashed(batch):
        found = [fingerprint(t, width) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "tid": batch.column("tid"),
                "fp": np.array(found, np.uint64).view(np.int64)}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, "text", hashed, f"doc_id {kind}, tid binary, fp long")


def _halves(fp: Column) -> list[Column]:
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return [low, F.shiftrightunsigned(fp, 32)]


def _masks(bits: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` of ``bits`` bits, as signed longs."""
    out = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def _longs(values: list[int]) -> Column:
    """An array literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<long>")


def _filed(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under its two halves."""
    keys = [F.lit(j << 32).bitwiseOR(half) for j, half in enumerate(_halves(F.col("fp")))]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _probes(fps: DataFrame, radius: int) -> DataFrame:
    """(key, fp): the ball around each half.

    Of two halves that differ, the smaller looks up the larger, so only masks
    that raise the half are needed.
    """
    masks = _longs(_masks(32, radius))

    def ball(j, half):
        up = F.filter(masks, lambda m: half.bitwiseXOR(m) >= half)
        return F.transform(up, lambda m: F.lit(j << 32).bitwiseOR(half.bitwiseXOR(m)))

    keys = [ball(j, half) for j, half in enumerate(_halves(F.col("fp")))]
    return fps.select(F.explode(F.concat(*keys)).alias("key"), "fp")


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _cube_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) that connect all ``fps`` within ``max_bits`` (3 or fewer).

    Two fingerprints are that close exactly if some point of the cube is within
    one bit of one and within two of the other; with three differing bits, two
    of them lie in the same half, so only such pairs of bits are needed.  At
    each point everything within two bits is linked to one fingerprint within
    one bit: those links are all real, and linear in number.
    """
    ones = _masks(64, 1)
    pairs = [sum(1 << (i + s) for i in c) for s in (0, 32) for c in combinations(range(32), 2)]
    pairs = [m - (1 << 64) if m >> 63 else m for m in pairs]

    def around(masks):
        return fps.select("fp", F.explode(_longs(masks)).alias("mask")).select(
            F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp")

    near = around(ones).groupBy("point").agg(F.min("fp").alias("v"))
    links = around(ones + (pairs if max_bits == 3 else [])).join(near, "point")
    return links.select(F.col("fp").alias("u"), "v").filter("u != v").distinct()


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) over the distinct ``fps``: enough pairs within ``max_bits`` to
    connect all that are linked (every pair, except within hot halves)."""
    if not 2 <= max_bits <= 3:
        raise ValueError("max_bits must be 2 or 3")
    filed, probes = _filed(fps), _probes(fps, max_bits // 2)
    hot = filed.groupBy("key").count().filter(F.col("count") > HOT_HALF).select("key")
    hot, _ = materialize(hot, "hot")
    found = (
        probes.join(filed.join(hot, "key", "left_anti").withColumnRenamed("fp", "v"), "key")
        .withColumnRenamed("fp", "u")
        .filter((F.col("u") != F.col("v")) & (_distance("u", "v") <= max_bits))
        .select("u", "v")
    )
    crowded = (
        probes.union(filed).join(hot, "key", "left_semi").select("fp").distinct()
        if not hot.isEmpty() else None
    )
    return found.union(_cube_links(crowded, max_bits)) if crowded is not None else found


def simhash_components(
    docs: DataFrame,
    *,
    width: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, tid, fp (signed long), component_id.

    Documents whose fingerprints differ in ``max_bits`` or fewer bits are
    linked; component_id is the smallest doc_id reachable.
    """
    spark = docs.sparkSession
    rows, _ = materialize(
        fingerprints(docs, width, id_col=id_col, text_col=text_col), "fingerprints")
    nodes, node_path = materialize(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    groups = components(links(nodes.select("fp"), max_bits))
    labelled = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    labelled, label_path = materialize(labelled, "labelled")
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = labelled.withColumn("k", apart(F.col("component"))).join(
        least.select(apart(F.col("component")).alias("k"), "component_id"), "k")
    ids, _ = materialize(ids.select("fp", "component_id"), "component-ids")
    release(spark, node_path, label_path)
    return rows.join(ids, "fp").select("doc_id", "tid", "fp", "component_id")


def keep_one(docs: DataFrame, *, width: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each component, with all columns: that of the smallest id.

    Of rows with one id, that of the smallest text_id; of repeated rows, one.
    """
    groups = simhash_components(docs, width=width, max_bits=max_bits)
    # A null id sorts last, so it stays only where its component has no other.
    pick = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tid")
    one = groups.groupBy(F.coalesce("component_id", "doc_id").alias("c"),
                         F.when(F.col("component_id").isNull(), F.col("fp")).alias("f"))
    chosen = one.agg(F.min(pick).alias("one")).select(
        F.col("one.doc_id").alias("_keep_id"), F.col("one.tid").alias("_keep_text")).distinct()
    row = docs.select("doc_id", text_id(F.coalesce("text", F.lit(""))).alias("_tid"),
                      F.struct("*").alias("_row"))
    kept = row.join(
        chosen, (F.col("_tid") == F.col("_keep_text")) & F.col("doc_id").eqNullSafe(F.col("_keep_id")),
        "left_semi")
    return kept.dropDuplicates(["doc_id", "_tid"]).select("_row.*")
