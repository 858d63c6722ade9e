"""Quality rules per document, with suffix-array repetition.

Each document is one sequence of words.  Its suffix array (prefix doubling,
only ties are sorted again) and the longest common prefixes of neighbouring
suffixes give its maximal repeated substrings: a repeat of ``min_repeat`` words
or more marks the words of all its occurrences.  A document is rejected when
the marked share of its words or its longest repeat exceeds a limit, or when
the plain rules fail (too short, too many repeated 3-word windows).

Every document is judged alone, so nothing is shuffled.  Documents are packed
into batches of bounded bytes and one suffix array is built per batch, over
symbols that are a document's own, so that no repeat joins two documents.

Defined results: null and empty texts have no words and fail the length rule.
Repeated rows are judged row by row.  ``quality_filter`` keeps all columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import ASCII_SPACE, arrow_map, by_bytes, texts

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_NOT_SPACE = re.compile(rf"[^{ASCII_SPACE}]")

SIGNALS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, covered_words long, longest_repeat long")


@dataclass(frozen=True)
class Limits:
    """Thresholds of the verdict; words unless said otherwise."""

    min_words: int = 50
    #: Most words, in per cent, inside 3-word windows found twice or more.
    max_repeat_percent: int = 50
    #: Shortest repeated substring that counts as repetition.
    min_repeat: int = 10
    #: Most words, in per cent, covered by such substrings.
    max_covered_percent: int = 30
    #: Longest repeated substring, in per cent of the words.
    max_longest_percent: int = 20


def _suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Rank of every suffix by its first 1, 2, 4, ... symbols, until all differ.

    Equal ranks at level k mean equal first 2**k symbols; the last level is the
    inverse suffix array.  ``ids`` must end with a symbol found only there.
    """
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]
    levels, step = [rank], 1
    tied = np.flatnonzero(counts[ids] > 1)
    while tied.size:
        prev = levels[-1]
        order = np.lexsort((prev[tied + step], prev[tied]))
        tied = tied[order]
        old, nxt = prev[tied], prev[tied + step]
        new_bucket = np.r_[True, old[1:] != old[:-1]]
        new_group = new_bucket | np.r_[True, nxt[1:] != nxt[:-1]]
        at = np.arange(tied.size)
        bucket = np.maximum.accumulate(np.where(new_bucket, at, 0))
        group = np.maximum.accumulate(np.where(new_group, at, 0))
        rank = prev.copy()
        rank[tied] = old + (group - bucket)
        levels.append(rank)
        alone = new_group & np.r_[new_group[1:], True]
        tied, step = tied[~alone], step * 2
    return levels


def repeat_lengths(ids: np.ndarray) -> np.ndarray:
    """For every position, the longest prefix of its suffix found elsewhere too.

    That is the larger common prefix with the two neighbours in the suffix
    array: the deepest LCP interval that holds the suffix.
    """
    levels = _suffix_ranks(ids)
    suffixes = np.empty(len(ids), np.int64)
    suffixes[levels[-1]] = np.arange(len(ids))
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(a), np.int64)
    live = np.flatnonzero(levels[0][a] == levels[0][b])
    for k in range(len(levels) - 1, -1, -1):
        # A match ends before the closing symbol, so no index runs over the end.
        x, y = a[live] + common[live], b[live] + common[live]
        common[live[levels[k][x] == levels[k][y]]] += 1 << k
    longest = np.zeros(len(ids), np.int64)
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask over n positions of the union of [start, start + length)."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def signals(batch_texts: list[str], min_repeat: int) -> dict[str, np.ndarray]:
    """The SIGNALS of each text of one batch."""
    words = [t.encode().split() for t in batch_texts]
    n_words = np.array([len(w) for w in words], np.int64)
    docs = len(words)
    flat = np.array([w for ws in words for w in ws], dtype=object)
    codes, distinct = pd.factorize(flat)
    # A symbol is a word of one document, so no repeat joins two documents.
    codes, _ = pd.factorize(np.repeat(np.arange(docs), n_words) * max(1, len(distinct)) + codes)
    n_codes = int(codes.max()) + 1 if len(codes) else 0
    # One closing symbol per document, each a number of its own.
    ends = np.cumsum(n_words + 1) - 1
    ids = np.empty(len(flat) + docs, np.int64)
    is_word = np.ones(len(ids), bool)
    is_word[ends] = False
    ids[is_word], ids[ends] = codes, n_codes + np.arange(docs)
    owner = np.repeat(np.arange(docs), n_words + 1)
    longest = repeat_lengths(ids)
    longest[ends] = 0

    def per_doc(mask):
        return np.bincount(owner[mask], minlength=docs).astype(np.int64)

    def cover(depth, width=None):
        at = np.flatnonzero(longest >= depth)
        return _covered(at, width or longest[at], len(ids))

    top = np.zeros(docs, np.int64)
    np.maximum.at(top, owner, longest)
    lines = [[x for x in t.split("\n") if _NOT_SPACE.search(x)] for t in batch_texts]
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, ASCII_SPACE)) for t in batch_texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in batch_texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": per_doc(cover(3, 3)),
        "covered_words": per_doc(cover(min_repeat)),
        "longest_repeat": top,
    }


def _verdict(df: DataFrame, limits: Limits) -> DataFrame:
    n = F.col("n_words")
    failed = (n < limits.min_words) | (
        F.lit(100) * F.col("n_repeat_words") > limits.max_repeat_percent * n)
    repetitive = (F.lit(100) * F.col("covered_words") > limits.max_covered_percent * n) | (
        (F.col("longest_repeat") >= limits.min_repeat)
        & (F.lit(100) * F.col("longest_repeat") > limits.max_longest_percent * n))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)


def quality_signals(
    docs: DataFrame,
    limits: Limits = Limits(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, the SIGNALS, base_failed, kept."""
    rows = texts(docs, id_col=id_col, text_col=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    depth = limits.min_repeat

    def judge(batch):
        return {"doc_id": batch.column("doc_id"),
                **signals(batch.column("text").to_pylist(), depth)}

    return _verdict(arrow_map(rows, "text", judge, f"doc_id {kind}, {SIGNALS}"), limits)


def quality_filter(docs: DataFrame, limits: Limits = Limits(), *, text_col: str = "text") -> DataFrame:
    """The documents whose verdict is ``kept``, with all columns, in one pass."""
    depth, at = limits.min_repeat, docs.columns.index(text_col)
    names = ["n_words", "n_repeat_words", "covered_words", "longest_repeat"]
    # Columns go by position in between, so no name of theirs can clash.
    passed = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    schema = T.StructType([*passed, *(T.StructField(n, T.LongType()) for n in names)])

    def judge(batches):
        for batch in by_bytes(batches, f"c{at}"):
            found = signals([t or "" for t in batch.column(at).to_pylist()], depth)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(found[n]) for n in names)], names=schema.names)

    judged = docs.toDF(*(f.name for f in passed)).mapInArrow(judge, schema)
    kept = _verdict(judged, limits).filter("kept")
    return kept.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
