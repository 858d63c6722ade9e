"""How the sources of a language differ in their use of terms.

Counting is by length-bucketed packing.  A term of up to 8 bytes is one
unsigned 64-bit word, one of up to 16 bytes two; words are radix-sorted in
16-bit digits, least significant first, and runs of equal ones counted.  Longer
terms go to buckets of their own, one per power of two of their length, and are
sorted there as bytes.  Each task counts slices of bounded bytes; Spark adds up.

Each (lang, source) group and each lang has a smoothed distribution over the
terms the lang keeps.  Two distributions differ by the sum over terms of
``(p - q)**2 / (p + q)``, in whole numbers throughout.

Scale: no group's rows meet in one task.  Counts are keyed by (lang, source,
term) and summed per task first.  For the comparison of sources a lang's terms
are dealt into blocks and its sources into tiles; one task step holds one block
for one pair of tiles, and terms that neither of two sources uses are added by
one product.  The result itself is quadratic in the sources of a lang.

Defined results: null text, lang and source are empty strings; a document
without terms still makes its group occur; repeated rows are documents of their
own; an empty table gives an empty result.  Other input columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import by_bytes, materialize, release

#: Probabilities are in units of one part in so many.
SCALE = 1_000_000_000

#: Added to each count.
SMOOTHING = 2

#: Bytes of text counted together; a longer text is cut between terms.
_SLICE = 1 << 22

#: Terms of a block and sources of a tile, about.
BLOCK_TERMS, TILE_SOURCES = 4096, 64

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_IN_TERM = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def _radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned ``columns``, the last of them counting most.

    numpy sorts 16-bit integers by counting; a digit that never changes is passed over.
    """
    order = np.arange(len(columns[0]))
    for column in columns:
        for shift in range(0, 8 * column.dtype.itemsize, 16):
            digit = (column >> column.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _run_counts(order: np.ndarray, columns: list[np.ndarray], doc: np.ndarray):
    """Per run of equal rows in ``order``: (index of one, rows, distinct documents).

    ``order`` is stable, so the documents of a run ascend.
    """
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in columns:
        c = column[order]
        new[1:] |= c[1:] != c[:-1]
    d = doc[order]
    fresh = new.copy()
    fresh[1:] |= d[1:] != d[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order))), np.add.reduceat(fresh.astype(np.int64), first)


def _words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each start as one big-endian word, padded with zeros.

    A term has no zero byte, so the words of different terms differ.
    """
    window = np.lib.stride_tricks.sliding_window_view(data, 8)[starts]
    cut = (8 * (8 - np.minimum(sizes, 8))).astype(np.uint64)
    return (np.ascontiguousarray(window).view(">u8")[:, 0].astype(np.uint64) >> cut) << cut


def count_terms(raw: list[bytes], group: np.ndarray) -> list[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """Tables (group, terms, occurrences, documents), one per bucket of lengths."""
    joined = np.frombuffer(b"\n".join(raw) + b"\n" * 17, np.uint8)
    inside = _IN_TERM[joined]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, stops = edge[::2], edge[1::2]
    data = _LOWER[joined]
    ends = np.cumsum([len(r) + 1 for r in raw])
    doc = np.searchsorted(ends, starts, side="right")
    sizes, code = stops - starts, group[doc].astype(np.uint32)
    out = []
    one, two = sizes <= 8, (sizes > 8) & (sizes <= 16)
    if one.any():
        low = _words(data, starts[one], sizes[one])
        g, d = code[one], doc[one]
        at, n, docs = _run_counts(_radix_order([low, g]), [low, g], d)
        out.append((g[at], low[at].astype(">u8").view("S8").tolist(), n, docs))
    if two.any():
        high = _words(data, starts[two], sizes[two])
        low = _words(data, starts[two] + 8, sizes[two] - 8)
        g, d = code[two], doc[two]
        at, n, docs = _run_counts(_radix_order([low, high, g]), [low, high, g], d)
        both = np.stack([high[at], low[at]], axis=1).astype(">u8")
        out.append((g[at], both.view("S16")[:, 0].tolist(), n, docs))
    left = np.flatnonzero(sizes > 16)
    width = 32
    while len(left):
        here, left = left[sizes[left] <= width], left[sizes[left] > width]
        if len(here):
            text = data.tobytes()
            terms = np.array([text[s:e] for s, e in zip(starts[here], stops[here])], f"S{width}")
            order = np.argsort(terms, kind="stable")
            order = order[_radix_order([code[here][order]])]
            at, n, docs = _run_counts(order, [terms, code[here]], doc[here])
            out.append((code[here][at], terms[at].tolist(), n, docs))
        width *= 2
    return out


def _pieces(raw: bytes) -> list[bytes]:
    """A long text cut into slices, each ending where a term does not go on."""
    out, at = [], 0
    while at < len(raw):
        stop = min(at + _SLICE, len(raw))
        while stop < len(raw) and _IN_TERM[raw[stop - 1]] and _IN_TERM[raw[stop]]:
            stop += 1
        out.append(raw[at:stop])
        at = stop
    return out


def _count_long(raw: bytes) -> tuple[list[bytes], list[int]]:
    """Distinct terms of one long text and their occurrences."""
    held: dict[bytes, int] = {}
    for piece in _pieces(raw):
        for _, terms, n, _ in count_terms([piece], np.zeros(1, np.int64)):
            for t, k in zip(terms, n.tolist()):
                held[t] = held.get(t, 0) + k
    return list(held), list(held.values())


def _count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    pairs: dict[tuple[str, str], int] = {}
    group = np.array([pairs.setdefault(p, len(pairs)) for p in zip(
        batch.column("lang").to_pylist(), batch.column("source").to_pylist())], np.int64)
    raw = [t.encode() for t in batch.column("text").to_pylist()]
    if len(raw) == 1 and len(raw[0]) > _SLICE:
        terms, n = _count_long(raw[0])
        tables = [(np.zeros(len(terms), np.int64), terms, np.array(n, np.int64), np.ones(len(terms), np.int64))]
    else:
        tables = count_terms(raw, group)
    # A row with the empty term says that the group occurs.
    tables.append((np.arange(len(pairs)), [b""] * len(pairs), np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)))
    code = pa.array(np.concatenate([t[0] for t in tables]).astype(np.int64))
    lang, source = (pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))
    return pa.RecordBatch.from_arrays(
        [lang.take(code), source.take(code),
         pa.array([t for table in tables for t in table[1]], pa.binary()).cast(pa.string()),
         pa.array(np.concatenate([t[2] for t in tables]).astype(np.int64)),
         pa.array(np.concatenate([t[3] for t in tables]).astype(np.int64))],
        names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and
    documents that hold it.  The empty term stands for the group itself."""
    empty = F.lit("")
    rows = docs.select(*(F.coalesce(docs[c], empty).alias(c) for c in ("lang", "source", "text")))

    def run(batches):
        for batch in by_bytes(batches, "text", _SLICE):
            yield _count_batch(batch)

    return (
        rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _parts(count: str, total: str, terms: str) -> Column:
    """Smoothed probability in parts of SCALE; the product may pass 64 bits."""
    return F.expr(
        f"1 + ({SCALE}BD * (cast({count} as decimal(20, 0)) + {SMOOTHING}BD))"
        f" div (cast({total} as decimal(20, 0)) + {SMOOTHING}BD * cast({terms} as decimal(18, 0)))")


def _block_values(key, terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """What one block of terms adds to each pair of sources of two tiles."""
    lang, block, low, high = key
    names, base = groups["source"].to_numpy(), groups["p0"].to_numpy(np.int64)
    tile, kept = groups["tile"].to_numpy(), groups["v"].to_numpy(np.int64)
    place = {s: i for i, s in enumerate(names)}
    row, distinct = pd.factorize(terms["term"])
    matrix = np.repeat(base[None, :], len(distinct), axis=0)
    matrix[row, [place[s] for s in terms["source"]]] = terms["p"]
    right = np.flatnonzero(tile == high)
    found = []
    for a in np.flatnonzero(tile == low):
        other = right[names[right] > names[a]] if low == high else right
        if not len(other):
            continue
        p, q = matrix[:, [a]], matrix[:, other]
        none = (base[a] - base[other]) ** 2 // (base[a] + base[other])
        value = ((p - q) ** 2 // (p + q)).sum(axis=0) - len(distinct) * none
        if block == 0:
            value = value + kept[a] * none
        found.append(pd.DataFrame({"lang": lang, "a": names[a], "b": names[other], "value": value}))
    return pd.concat(found) if found else pd.DataFrame(
        {"lang": pd.Series(dtype=str), "a": pd.Series(dtype=str), "b": pd.Series(dtype=str),
         "value": pd.Series(dtype=np.int64)})


def _pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every pair of sources a, b of a lang, once."""
    per_lang = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / TILE_SOURCES).alias("tiles"),
        F.greatest(F.lit(1), F.ceil(F.max("v") / BLOCK_TERMS)).alias("blocks"))
    dealt = groups.join(per_lang, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))

    def to_pairs(df):
        met = df.withColumn("met", F.explode(F.expr("sequence(0L, tiles - 1)")))
        return met.withColumn("low", F.least("tile", "met")).withColumn("high", F.greatest("tile", "met"))

    key = ["lang", "block", "low", "high"]
    place = dealt.select("lang", "source", "tile", "tiles", "blocks")
    left = to_pairs(
        terms.select("lang", "source", "term", "p").join(place, ["lang", "source"])
        .withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    ).select(*key, "source", "term", "p")
    right = to_pairs(dealt.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))).select(
        *key, "source", "tile", "p0", "v")
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _block_values, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, *, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: for each group of ``docs``

    * part ``pair``: every other source of its lang and how far it is;
    * part ``term``: the ``top`` terms the group uses more than its lang does.

    A lang keeps the terms that at least ``min_docs`` of its documents hold.
    """
    spark = docs.sparkSession
    counts, counts_path = materialize(term_counts(docs), "term-counts")
    real = counts.filter("term != ''")
    vocabulary, _ = materialize(
        real.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "vocabulary")
    kept, kept_path = materialize(
        real.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept-terms")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups, _ = materialize(
        counts.filter("term = ''").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total")))
        .withColumn("p0", F.when(F.col("v") > 0, _parts("0", "total", "v")).otherwise(1)),
        "groups")
    terms, _ = materialize(
        kept.join(groups.drop("p0"), ["lang", "source"]).select(
            "lang", "source", "term", _parts("n", "total", "v").alias("p"),
            _parts("lang_n", "lang_total", "v").alias("q")), "term-parts")
    release(spark, counts_path, kept_path)
    pairs = _pair_values(terms, groups)
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        pairs.select("lang", "b", "a", "value"))
    more = terms.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df, part):
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                         F.row_number().over(order).alias("rank"))

    return ranked(both, "pair").union(ranked(more, "term").filter(F.col("rank") <= top))
