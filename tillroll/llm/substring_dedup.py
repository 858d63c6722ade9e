"""Substring dedup over words by prefix-partitioned suffix trees.

A window is ``depth`` consecutive words.  A word is removed if some window over
it also starts in a document with a smaller id.

Suffixes are partitioned by a prefix of variable length: the words up to and
with the window's anchor gram (see ``anchors``).  Prefixes that do not occur in
two documents hold no such repeat and drop out.  Whole runs of suffixes that
occur again are settled by one aggregation; one copy of each distinct run goes
on.  The prefixes left are packed into groups that fit a task, and each group
builds the suffix tree of its suffixes, as a suffix array with the lengths of
common prefixes: its internal nodes at ``depth`` words or deeper are the maximal
repeats long enough, and each takes the smallest document below it.  A prefix
with more words than a task should hold is split by longer ones, in steps, and
each part that fits goes to the same trees.  The longest prefix is a whole
window: all that share it are one node, however many, and no tree is needed to
find the smallest document.

Defined results: null and empty texts have no words.  Rows without an id are
neither changed nor taken as earlier documents; rows with one id are one
document to each other.  Extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import anchors
from tillroll.llm.common import by_bytes, materialize, release, texts

DEPTH = 50

#: Words that the runs of one task's trees should hold.
GROUP_WORDS = 1 << 19

#: Words of the runs of one prefix beyond which longer prefixes split it.
HOT_WORDS = 1 << 18

#: Windows whose shared words are the longer prefixes, step by step; then one.
STEPS = (16, 4)

RUN_KEY = ("key", "content", "offset", "n")


def _candidates(rows: DataFrame, depth: int) -> tuple[DataFrame, str]:
    """The runs whose prefix occurs in more than one document."""
    spark = rows.sparkSession
    found = anchors.runs(rows, anchors.word_symbols, depth, max(1, depth // 4))
    all_runs, path = materialize(found.filter("doc_id IS NOT NULL"), "runs")
    shared = all_runs.groupBy("key").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("key")
    out = materialize(anchors.in_groups(all_runs, shared, "key", how="left_semi"), "candidates")
    del all_runs, shared, found
    release(spark, path)
    return out


def _settled(found: DataFrame, groups: DataFrame, depth: int) -> DataFrame:
    """Spans of the runs that occur as a whole in an earlier document."""
    again = groups.filter("copies > 1").select(*RUN_KEY, "one.doc_id").withColumnRenamed(
        "doc_id", "first")
    return anchors.in_groups(found, again, *RUN_KEY).filter("first < doc_id").select(
        "doc_id", "tid", "start", (F.col("start") + F.col("n") + (depth - 1)).alias("stop"))


def _contexts(rows: DataFrame, groups: DataFrame, depth: int) -> DataFrame:
    """(doc_id, RUN_KEY, size, words, part, at): one run of each content, of its
    first document.

    For prefixes with several contents; ``words`` are the word hashes of the run,
    ``part`` its prefix, ``size`` the number of words of all runs under that and
    ``at`` the run's window that ``words`` begins with.
    """
    several = groups.groupBy("key").agg(
        F.count("*").alias("c"), F.sum(F.col("n") + (depth - 1)).alias("size")).filter("c > 1").select("key", "size")
    left = anchors.in_groups(groups, several, "key").select(*RUN_KEY, "size", "one.*")
    per_doc = left.groupBy("doc_id", "tid").agg(
        F.collect_list(F.struct(*RUN_KEY, "start", "size")).alias("runs"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in by_bytes(batches, "text"):
            symbols, ends = anchors.word_symbols(batch.column("text").to_pylist())
            begins = [0, *ends[:-1].tolist()]
            doc, flat, words = [], [], []
            for i, held in enumerate(batch.column("runs").to_pylist()):
                for r in held:
                    low = begins[i] + r["start"]
                    doc.append(i)
                    flat.append(r)
                    words.append(symbols[low:low + r["n"] - 1 + depth].view(np.int64))
            at = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at),
                 *(pa.array([r[k] for r in flat], pa.int64()) for k in ("key", "content", "size")),
                 *(pa.array([r[k] for r in flat], pa.int32()) for k in ("offset", "n")),
                 pa.array(words, pa.list_(pa.int64()))],
                names=["doc_id", "key", "content", "size", "offset", "n", "words"])

    joined = anchors.with_texts(rows, per_doc, "inner").select("doc_id", "tid", "text", "runs")
    return joined.mapInArrow(
        cut, f"doc_id {kind}, key long, content long, size long, offset int, n int, "
             "words array<long>").withColumns({"part": F.col("key"), "at": F.lit(0)})


def suffix_order(symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes of several sequences laid end to end, by prefix doubling.

    Each sequence ends in a symbol of its own, larger than all others.  Item k of
    the result ranks suffixes by 2 ** k symbols; the last one tells all apart, and
    so is the place of each suffix in the suffix array.
    """
    distinct, code = np.unique(symbols, return_inverse=True)
    stops = np.cumsum(sizes + 1) - 1
    rank = np.empty(len(symbols) + len(sizes), np.int64)
    inner = np.ones(len(rank), bool)
    inner[stops] = False
    rank[inner], rank[stops] = code, len(distinct) + np.arange(len(sizes))
    ranks, have = [rank.astype(np.int32)], 1
    while rank.max() < len(rank) - 1:
        # What would reach beyond the last sequence is told apart by its end already.
        rank *= len(rank) + 1
        rank[:-have] += ranks[-1][have:]
        _, rank = np.unique(rank, return_inverse=True)
        ranks.append(rank.astype(np.int32))
        have *= 2
    return ranks


def common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` begin with in common."""
    size = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        size += (ranks[k][a + size] == ranks[k][b + size]).astype(np.int64) << k
    return size


def _tree_spans(table: pa.Table, depth: int) -> pa.Table:
    """Spans within runs, of windows that an earlier document holds too, in one
    group's trees: (doc_id, RUN_KEY, low, high)."""
    docs = table.column("doc_id").to_numpy()
    at = table.column("at").to_numpy().astype(np.int64)
    words = table.column("words").combine_chunks()
    sizes = words.value_lengths().to_numpy().astype(np.int64)
    ranks = suffix_order(words.flatten().to_numpy(), sizes)
    # The suffixes of depth words or more: where they begin, and in which run.
    n = sizes - (depth - 1)
    run = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    place = (np.cumsum(sizes + 1) - (sizes + 1))[run] + within
    order = np.argsort(ranks[-1][place])
    shared = common_prefix(ranks, place[order[:-1]], place[order[1:]])
    # Internal nodes of the tree: neighbours that share depth words or more.
    edge = np.flatnonzero(np.concatenate([[True], shared < depth]))
    least = np.minimum.reduceat(docs[run][order], edge)
    first = np.empty(len(run), docs.dtype)
    first[order] = np.repeat(least, np.diff(np.concatenate([edge, [len(order)]])))
    hit = np.flatnonzero(first < docs[run])
    # Neighbouring windows of a run make one span.
    new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(run[hit]) != 0)])[:len(hit)]
    low, high = hit[new], hit[np.concatenate([new[1:], [True]])[:len(hit)]]
    return table.select(["doc_id", *RUN_KEY]).take(pa.array(run[low])).append_column(
        "low", pa.array((at[run] + within)[low], pa.int32())).append_column(
        "high", pa.array((at[run] + within)[high] + depth, pa.int32()))


def _trees(runs: DataFrame, total: int, depth: int) -> DataFrame:
    """The spans of :func:`_tree_spans`, of ``runs`` with ``total`` words in all."""
    kind = runs.schema["doc_id"].dataType.simpleString()
    groups = F.pmod(F.xxhash64("part"), F.lit(math.ceil(total / GROUP_WORDS)))
    return runs.groupBy(groups.alias("group")).applyInArrow(
        lambda table: _tree_spans(table, depth),
        f"doc_id {kind}, key long, content long, offset int, n int, low int, high int")


def _longer(runs: DataFrame, width: int, depth: int) -> DataFrame:
    """``runs`` cut into ``width`` windows or fewer, by longer prefixes.

    Windows are dealt by where in them the anchor is, in blocks of ``width``
    places; the new ``part`` is what all windows of a block hold: one window for
    a width of one.
    """
    place = F.col("offset") - F.col("at")
    n = F.size("words") - (depth - 1)
    ahead = place - F.col("block") * width
    low = F.greatest(F.lit(0), ahead - (width - 1)).cast("int")
    high = F.least(n - 1, ahead).cast("int")
    return runs.withColumn("block", F.explode(F.sequence(
        F.floor((place - n + 1) / width), F.floor(place / width)))).select(
        "doc_id", *RUN_KEY, (F.col("at") + low).alias("at"),
        F.xxhash64("part", "block", F.slice(
            "words", ahead.cast("int") + 1, F.lit(depth - width + 1))).alias("part"),
        F.slice("words", low + 1, high - low + depth).alias("words"))


def _split(runs: DataFrame, width: int, depth: int) -> DataFrame:
    """The parts of :func:`_longer` that occur in more than one document, with their size."""
    rows = _longer(runs, width, depth)
    parts = rows.groupBy("part").agg(
        F.sum(F.size("words")).alias("size"), F.min("doc_id").alias("a"),
        F.max("doc_id").alias("b")).filter("a < b").select("part", "size")
    return anchors.in_groups(rows, parts, "part")


def _whole_windows(runs: DataFrame, depth: int) -> DataFrame:
    """The spans of prefixes that only whole windows split: each is one node."""
    rows = _longer(runs, 1, depth).drop("words")
    first = rows.groupBy("part", "key").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("c")).filter("c > 1").drop("c")
    return anchors.in_groups(rows, first, "part", "key").filter("first < doc_id").select(
        "doc_id", *RUN_KEY, F.col("at").alias("low"), (F.col("at") + depth).alias("high"))


def _judged(runs: DataFrame, depth: int) -> tuple[list[DataFrame], list[str]]:
    """Spans (doc_id, RUN_KEY, low, high) of the trees of all prefixes, and the
    tables that they read."""
    spans, paths = [], []
    steps = [w for w in STEPS if w < depth]
    while True:
        few = runs.filter(F.col("size") <= HOT_WORDS)
        total, hot = runs.agg(
            F.sum(F.when(F.col("size") <= HOT_WORDS, F.size("words"))),
            F.count_if(F.col("size") > HOT_WORDS)).first()
        if total:
            spans.append(_trees(few, total, depth))
        if not hot:
            return spans, paths
        many = runs.filter(F.col("size") > HOT_WORDS)
        if not steps:
            return [*spans, _whole_windows(many, depth)], paths
        runs, path = materialize(_split(many, steps.pop(0), depth), "longer")
        paths.append(path)


def _in_first_documents(found: DataFrame, parts: DataFrame) -> DataFrame:
    """Spans of the runs that equal a judged one and are in its document."""
    return anchors.in_groups(found, parts, *RUN_KEY, "doc_id").select(
        "doc_id", "tid", (F.col("start") + F.col("low")).alias("start"),
        (F.col("start") + F.col("high")).alias("stop"))


def repeated_spans(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, tid, spans) in words, of the documents that lose any."""
    spark = rows.sparkSession
    found, found_path = _candidates(rows, depth)
    groups, group_path = materialize(
        found.groupBy(*RUN_KEY).agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "tid", "start")).alias("one")),
        "groups")
    whole, whole_path = materialize(_settled(found, groups, depth), "spans")
    runs, run_path = materialize(_contexts(rows, groups, depth), "contexts")
    del groups
    release(spark, group_path)
    judged, paths = _judged(runs, depth)
    spans = whole
    for part in judged:
        spans = spans.union(_in_first_documents(found, part))
    done, _ = materialize(anchors.per_document(spans), "document-spans")
    del found, runs, whole, judged, spans
    release(spark, found_path, run_path, whole_path, *paths)
    return done


def substring_dedup(docs: DataFrame, depth: int = DEPTH, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept.

    ``kept`` (a string) is the words that remain, joined by one space.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in by_bytes(batches, "text"):
            n, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(),
                                   batch.column("spans").to_pylist()):
                words = text.encode().split()
                gone = anchors.covered(spans, len(words))
                n.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]
                                      if spans else words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    joined = anchors.with_texts(rows, repeated_spans(rows, depth), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, kept string")
