"""Runs of suffixes that share an anchor, and spans of documents.

A document is a sequence of symbols (bytes, or hashes of words).  Only its
windows of ``depth`` symbols matter to the operators that remove repeats: a
suffix is ordered through its first ``depth`` symbols.  The anchor of a window
is its gram (a short substring) with the smallest hash, the leftmost of equals.
It depends on the window alone, so equal windows have equal anchors at equal
offsets.  Neighbouring windows mostly share their anchor; such a run is one row
here, an order of magnitude fewer than suffixes.

Hashes are polynomials modulo 2**64.  Rows are always compared by two of them
together, the anchor's and one more, never by a single one across all rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import apart, by_bytes, text_id

#: Odd multipliers of the polynomials (fixed values).
_GRAM_BASE, _TEXT_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

#: Symbols whose windows are looked at together.
_CHUNK = 1 << 20

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n modulo 2**64."""
    if base not in _powers or len(_powers[base]) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Substrings:
    """Hashes of substrings [start, end) of one sequence of symbols."""

    def __init__(self, symbols: np.ndarray, base: int = _TEXT_BASE):
        n = len(symbols)
        self.inverse = _power(pow(base, -1, 1 << 64), n)
        terms = (symbols.astype(np.uint64) + np.uint64(1)) * _power(base, n)[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def hashes(self, starts, ends) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return _mixed(raw + (np.asarray(ends) - starts).astype(np.uint64))


    def all(self, size: int) -> np.ndarray:
        """Hashes of all substrings of ``size`` symbols."""
        raw = (self.sums[size:] - self.sums[:-size]) * self.inverse[:len(self.sums) - size]
        return _mixed(raw + np.uint64(size))


def _leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value of every window of ``width``."""
    at, low, m = np.arange(len(values), dtype=np.int32), values, 1
    while m < width:
        step = min(m, width - m)
        later = low[step:] < low[:-step]
        at = np.where(later, at[step:], at[:-step])
        low = np.where(later, low[step:], low[:-step])
        m += step
    return at


def find_runs(symbols: np.ndarray, ends: np.ndarray, depth: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of several documents laid end to end (``ends``: where each stops).

    doc: index of the document; start: first window, in symbols from the
    document's start; n: windows; offset: of the anchor in the first window (one
    less in each next); key: hash of the anchor gram; content: hash of all the
    run's symbols, [start, start + n - 1 + depth).
    """
    out = {k: [] for k in ("doc", "start", "n", "offset", "key", "content")}
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    for low in range(0, len(symbols) - depth + 1, _CHUNK):
        part = symbols[low:low + _CHUNK + depth - 1]
        grams = Substrings(part, _GRAM_BASE)
        hashes = grams.all(gram)
        anchor = _leftmost_min(hashes, depth - gram + 1)
        starts = np.arange(len(anchor))
        doc = np.searchsorted(ends, starts + low, side="right")
        valid = starts + low + depth <= ends[doc]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        new |= np.concatenate([[True], valid[1:] != valid[:-1]])
        first = np.flatnonzero(new)
        n = np.diff(np.concatenate([first, [len(anchor)]]))
        keep = valid[first]
        first, n = first[keep], n[keep]
        out["doc"].append(doc[first])
        out["start"].append(first + low - begins[doc[first]])
        out["n"].append(n)
        out["offset"].append(anchor[first] - first)
        out["key"].append(hashes[anchor[first]])
        out["content"].append(Substrings(part).hashes(first, first + n - 1 + depth))
    kinds = {"key": np.uint64, "content": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, kinds.get(k, np.int64))
            for k, v in out.items()}


def byte_symbols(batch_texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text stops)."""
    raw = [t.encode() for t in batch_texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])


def word_symbols(batch_texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, where each text's words stop)."""
    raw = [t.encode() for t in batch_texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, stops = edge[::2], edge[1::2]
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    return Substrings(data).hashes(starts, stops), np.searchsorted(starts, text_ends)


RUN_FIELDS = "tid binary, start int, n int, offset int, key long, content long"


def runs(rows: DataFrame, symbols: Callable, depth: int, gram: int) -> DataFrame:
    """(doc_id, RUN_FIELDS) of every run of ``rows`` (doc_id, text).

    ``tid`` is the text's :func:`text_id`: it tells rows with one doc_id apart.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for batch in by_bytes(batches, "text"):
            found = find_runs(*symbols(batch.column("text").to_pylist()), depth, gram)
            doc = pa.array(found["doc"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(doc), batch.column("tid").take(doc),
                 *(pa.array(found[k].astype(np.int32)) for k in ("start", "n", "offset")),
                 *(pa.array(found[k].view(np.int64)) for k in ("key", "content"))],
                names=["doc_id", "tid", "start", "n", "offset", "key", "content"])

    return rows.withColumn("tid", text_id(F.col("text"))).mapInArrow(scan, f"doc_id {kind}, {RUN_FIELDS}")


def in_groups(rows: DataFrame, groups: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``groups`` (an aggregate of them by ``keys``).

    Both sides are shuffled for the join alone, so a hot key can be split.
    """
    first = F.col(keys[0])
    right = groups.withColumn("_k", apart(first)).drop(keys[0])
    on = ["_k", *keys[1:]]
    return rows.withColumn("_k", apart(first)).join(right, on, how).drop("_k")


def with_texts(rows: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    """``rows`` (doc_id, text) joined with one row per document (doc_id, tid, ...)."""
    left = rows.withColumn("tid", text_id(F.col("text")))
    right = per_doc.withColumnsRenamed({"doc_id": "_d", "tid": "_t"})
    return left.join(
        right, (F.col("tid") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")), how,
    ).drop("_d", "_t")


def per_document(spans: DataFrame) -> DataFrame:
    """(doc_id, tid, spans): the spans (start, stop) of each document, in one array."""
    return spans.groupBy("doc_id", "tid").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))


def covered(spans: list[dict] | None, size: int) -> np.ndarray:
    """Mask over ``size`` symbols of the union of spans [start, stop)."""
    if spans is None or not len(spans):
        return np.zeros(size, bool)
    ends = np.array([(s["start"], s["stop"]) for s in spans])
    edge = np.bincount(ends[:, 0], minlength=size + 1) - np.bincount(ends[:, 1], minlength=size + 1)
    return np.cumsum(edge)[:size] > 0


def mask_spans(mask: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs [start, stop) of a mask."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))
