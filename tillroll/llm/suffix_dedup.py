"""Suffix-array dedup: depth-limited radix sort of all suffixes.

Suffixes are ordered through their first ``depth`` bytes only, by
most-significant-digit passes; a group that a pass leaves with one member holds
no repeat and drops out, and the groups equal through all digits are exactly the
windows of ``depth`` bytes that occur more than once.  Every byte that such a
window covers is removed.

A row for each suffix could not be moved, so suffixes travel in runs that share
an anchor (see ``anchors``); equal windows have equal anchors:

1. runs with an anchor of their own hold no repeat and drop out;
2. runs that are equal as a whole repeat in all their windows, and one goes on;
3. the anchors left are packed into groups that fit a task, and each group's
   suffixes are radix-sorted, eight bytes a pass from the window's start on.

An anchor with more bytes than a task should hold is split first, in steps, by
what neighbouring windows share beyond it, and the parts that fit are sorted
like the others.  The last step is a whole window: all that share it are
equal, however many, and are counted by an aggregation (two 64-bit hashes
together).  So a group is never larger than a task holds.

Intermediate tables live in the shared folder and are deleted when a later one
replaces them.

Defined results: null and empty texts, and texts shorter than ``depth``, lose
nothing.  A repeated row is a document of its own, so both lose what they share.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import anchors
from tillroll.llm.common import by_bytes, materialize, release, texts

DEPTH = 200

#: Bytes of runs that one task should sort.
GROUP_BYTES = 1 << 22

#: Bytes of the runs of one anchor beyond which it is split.
HOT_BYTES = 1 << 21

#: Neighbouring windows whose shared bytes split an anchor, step by step; then one.
STEPS = (64, 16, 4)

RUN_KEY = ("key", "content", "offset", "n")


def _candidates(rows: DataFrame, depth: int) -> tuple[DataFrame, str]:
    """Pass 1: the runs whose anchor occurs more than once."""
    spark = rows.sparkSession
    all_runs, path = materialize(
        anchors.runs(rows, anchors.byte_symbols, depth, max(1, depth // 4)), "runs")
    shared = all_runs.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    out = materialize(anchors.in_groups(all_runs, shared, "key", how="left_semi"), "candidates")
    del all_runs, shared
    release(spark, path)
    return out


def _repeated_runs(found: DataFrame, groups: DataFrame, depth: int) -> DataFrame:
    """Pass 2: (doc_id, tid, start, stop) of the runs that occur as a whole elsewhere."""
    again = groups.filter("copies > 1").select(*RUN_KEY)
    return anchors.in_groups(found, again, *RUN_KEY, how="left_semi").select(
        "doc_id", "tid", "start", (F.col("start") + F.col("n") + (depth - 1)).alias("stop"))


def _contexts(rows: DataFrame, groups: DataFrame, depth: int) -> DataFrame:
    """(doc_id, tid, key, size, start, offset, n, open, bytes, part) of one run of
    each content, for the anchors that have several contents.

    ``open`` marks the runs whose windows are still to be decided, ``size`` is the
    number of bytes of all runs of a ``part``, here of an anchor.  A run of a
    repeated row comes once for each row, but is never open, and what it shares
    with itself alone decides nothing.
    """
    several = groups.groupBy("key").agg(
        F.count("*").alias("c"), F.sum(F.col("n") + (depth - 1)).alias("size")).filter(
        "c > 1").select("key", "size")
    left = anchors.in_groups(groups, several, "key").select(
        "key", "size", "offset", "n", (F.col("copies") == 1).alias("open"), "one.*")
    per_doc = left.groupBy("doc_id", "tid").agg(
        F.collect_list(F.struct("key", "size", "start", "offset", "n", "open")).alias("runs"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in by_bytes(batches, "text"):
            doc, flat, raw = [], [], []
            for i, (text, held) in enumerate(zip(batch.column("text").to_pylist(),
                                                 batch.column("runs").to_pylist())):
                data, done = text.encode(), set()
                for r in held:
                    # Equal rows of one document come once for each.
                    if (r["start"], r["n"]) not in done:
                        done.add((r["start"], r["n"]))
                        doc.append(i)
                        flat.append(r)
                        raw.append(data[r["start"]:r["start"] + r["n"] - 1 + depth])
            at = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("tid").take(at),
                 *(pa.array([r[k] for r in flat], pa.int64()) for k in ("key", "size")),
                 *(pa.array([r[k] for r in flat], pa.int32()) for k in ("start", "offset", "n")),
                 pa.array([r["open"] for r in flat], pa.bool_()), pa.array(raw, pa.binary())],
                names=["doc_id", "tid", "key", "size", "start", "offset", "n", "open", "bytes"])

    joined = anchors.with_texts(rows, per_doc, "inner").select("doc_id", "tid", "text", "runs")
    return joined.mapInArrow(
        cut, f"doc_id {kind}, tid binary, key long, size long, start int, offset int, n int, "
             "open boolean, bytes binary").withColumn("part", F.col("key"))


def equal_windows(data: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of ``depth`` bytes at ``place`` that are equal to another one.

    Returns their indices in ``place``, sorted by the windows' bytes, and where in
    that order each group of equal ones begins.  A most-significant-digit radix
    sort: digits are eight bytes, from the window's start on; after each pass,
    groups of one member drop out, and groups that agree need no sorting.
    """
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    digits = np.zeros(len(data), np.uint64)
    for i in range(8):
        digits = digits << np.uint64(8) | padded[i:i + len(data)]
    alive, edge = np.arange(len(place)), np.zeros(min(1, len(place)), np.int64)
    for at in range(0, depth, 8):
        if not len(alive):
            break
        digit = digits[place[alive] + at] >> np.uint64(8 * max(0, 8 - (depth - at)))
        group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(alive))))
        mixed = np.logical_or.reduceat(digit != digit[edge][group], edge)
        todo = np.flatnonzero(mixed[group])
        order = todo[np.lexsort((digit[todo], group[todo]))]
        alive[todo], digit[todo] = alive[order], digit[order]
        edge = np.flatnonzero(np.concatenate(
            [[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])]))
        sizes = np.diff(np.append(edge, len(alive)))
        alive, sizes = alive[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
        edge = np.cumsum(sizes) - sizes
    return alive, edge


def _sorted_spans(table: pa.Table, depth: int) -> pa.Table:
    """(doc_id, tid, start, stop): the repeated windows of the open runs of a group."""
    raw = table.column("bytes").to_pylist()
    sizes = np.array([len(r) for r in raw])
    n = sizes - (depth - 1)
    run = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    found, _ = equal_windows(np.frombuffer(b"".join(raw), np.uint8),
                             (np.cumsum(sizes) - sizes)[run] + within, depth)
    undecided = np.array(table.column("open").to_pylist(), bool)
    hit = np.sort(found[undecided[run[found]]])
    # Neighbouring windows of a run make one span.
    new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(run[hit]) != 0)])[:len(hit)]
    low, high = hit[new], hit[np.concatenate([new[1:], [True]])[:len(hit)]]
    start = table.column("start").to_numpy()[run] + within
    return table.select(["doc_id", "tid"]).take(pa.array(run[low])).append_column(
        "start", pa.array(start[low], pa.int32())).append_column(
        "stop", pa.array(start[high] + depth, pa.int32()))


def _sorted(runs: DataFrame, total: int, depth: int) -> DataFrame:
    """The spans of :func:`_sorted_spans`, of ``runs`` with ``total`` bytes in all."""
    kind = runs.schema["doc_id"].dataType.simpleString()
    groups = F.pmod(F.xxhash64("part"), F.lit(math.ceil(total / GROUP_BYTES)))
    return runs.select("doc_id", "tid", "start", "open", "bytes", groups.alias("group")).groupBy(
        "group").applyInArrow(lambda table: _sorted_spans(table, depth),
                              f"doc_id {kind}, tid binary, start int, stop int")


def _longer(runs: DataFrame, width: int, depth: int) -> DataFrame:
    """``runs`` cut into ``width`` windows or fewer, with a new ``part`` for each.

    Windows are dealt by where in them the anchor is, in blocks of ``width``
    places; the part is what all windows of a block hold: one window for a width
    of one.
    """
    n = F.length("bytes") - (depth - 1)
    ahead = F.col("offset") - F.col("block") * width
    low = F.greatest(F.lit(0), ahead - (width - 1)).cast("int")
    high = F.least(n - 1, ahead).cast("int")
    return runs.withColumn("block", F.explode(F.sequence(
        F.floor((F.col("offset") - n + 1) / width), F.floor(F.col("offset") / width)))).select(
        "doc_id", "tid", "key", "open", (F.col("start") + low).alias("start"),
        (F.col("offset") - low).alias("offset"),
        F.xxhash64("part", "block", F.substring(
            F.col("bytes"), ahead.cast("int") + 1, F.lit(depth - width + 1))).alias("part"),
        F.substring(F.col("bytes"), low + 1, high - low + depth).alias("bytes"))


def _split(runs: DataFrame, width: int, depth: int) -> DataFrame:
    """The parts of :func:`_longer` with several members, one open, with their size."""
    rows = _longer(runs, width, depth)
    parts = rows.groupBy("part").agg(
        F.sum(F.length("bytes")).alias("size"), F.count("*").alias("c"),
        F.bool_or("open").alias("o")).filter("c > 1 AND o").select("part", "size")
    return anchors.in_groups(rows, parts, "part")


def _whole_windows(runs: DataFrame, depth: int) -> DataFrame:
    """The spans of what only whole windows split."""
    rows = _longer(runs, 1, depth).drop("bytes")
    again = rows.groupBy("part", "key").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    return anchors.in_groups(
        rows.filter("open"), again, "part", "key", how="left_semi").select(
        "doc_id", "tid", "start", (F.col("start") + depth).alias("stop"))


def _open_spans(runs: DataFrame, depth: int) -> tuple[list[DataFrame], list[str]]:
    """Spans (doc_id, tid, start, stop) of repeated windows of open runs, and the
    tables that they read."""
    spans, paths = [], []
    steps = [w for w in STEPS if w < depth]
    while True:
        total, hot = runs.agg(
            F.sum(F.when(F.col("size") <= HOT_BYTES, F.length("bytes"))),
            F.count_if(F.col("size") > HOT_BYTES)).first()
        if total:
            spans.append(_sorted(runs.filter(F.col("size") <= HOT_BYTES), total, depth))
        if not hot:
            return spans, paths
        many = runs.filter(F.col("size") > HOT_BYTES)
        if not steps:
            return [*spans, _whole_windows(many, depth)], paths
        runs, path = materialize(_split(many, steps.pop(0), depth), "longer")
        paths.append(path)


def repeated_spans(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, tid, spans) of the documents with repeated windows, from (doc_id, text).

    Spans may overlap; ``tid`` tells rows of one doc_id apart.
    """
    spark = rows.sparkSession
    found, found_path = _candidates(rows, depth)
    groups, group_path = materialize(
        found.groupBy(*RUN_KEY).agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "tid", "start")).alias("one")),
        "groups")
    whole, whole_path = materialize(_repeated_runs(found, groups, depth), "spans")
    runs, run_path = materialize(_contexts(rows, groups, depth), "contexts")
    del found, groups
    release(spark, found_path, group_path)
    spans, paths = _open_spans(runs, depth)
    out = whole
    for more in spans:
        out = out.union(more)
    done, _ = materialize(anchors.per_document(out), "document-spans")
    del runs, whole, spans, out
    release(spark, run_path, whole_path, *paths)
    return done


def _kept(text: str, spans) -> tuple[bytes, np.ndarray, int]:
    """(remaining bytes, mask of removed bytes, number of bytes)."""
    data = text.encode()
    gone = anchors.covered(spans, len(data))
    if not spans:
        return data, gone, len(data)
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), gone, len(data)


def suffix_dedup(docs: DataFrame, depth: int = DEPTH, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    ``kept`` is what remains, concatenated; it may not be valid UTF-8.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in by_bytes(batches, "text"):
            found = [_kept(t, s) for t, s in zip(batch.column("text").to_pylist(),
                                                 batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([n for _, _, n in found], pa.int64()),
                 pa.array([int(g.sum()) for _, g, _ in found], pa.int64()),
                 pa.array([len(anchors.mask_spans(g)) for _, g, _ in found], pa.int64()),
                 pa.array([k for k, _, _ in found], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = anchors.with_texts(rows, repeated_spans(rows, depth), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


@F.pandas_udf(T.StringType())
def _kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The text without the characters that lie wholly within the spans."""
    def cut(t, s):
        data = np.frombuffer(t.encode(), np.uint8)
        first = np.flatnonzero((data & 0xC0) != 0x80)
        gone = np.logical_and.reduceat(anchors.covered(s, len(data)), first)
        size = np.diff(np.concatenate([first, [len(data)]]))
        return data[np.repeat(~gone, size)].tobytes().decode()

    return pd.Series([t if s is None or not len(s) else cut(t, s) for t, s in zip(text, spans)])


def remove_repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The documents with the repeated windows taken out of ``text``.

    A character goes if all its bytes do, so the text stays valid; a null text
    that loses nothing stays null.  ``n_chars``, where there is one, is counted
    anew.  All other columns are kept, whatever their names.
    """
    spans = repeated_spans(texts(docs), depth)
    row = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                      F.struct("*").alias("_row"))
    joined = anchors.with_texts(row, spans, "left")
    kept = F.when(F.col("spans").isNull(), F.col("_row.text")).otherwise(_kept_text("text", "spans"))
    out = joined.select("_row", kept.alias("_kept"))
    return out.select([
        F.col("_kept").alias(c) if c == "text"
        else F.char_length("_kept").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"_row.`{c}`") for c in docs.columns])
