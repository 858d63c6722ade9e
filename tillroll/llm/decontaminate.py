"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most e edits leaves at least one
of e + 1 pieces untouched.  The pieces of all items form one Aho-Corasick
automaton; it runs over every whole document, and each exact piece hit names
the place where the item would have to be.  There Myers' bit-parallel search
gives the exact edit distance, and the item counts if it is within its budget.

Items and documents are compared in lower case with white space runs as one
space.  The items are a stated query set: equal ones are made one, and
they are read in blocks, one automaton each.  A block holds BLOCK_BYTES at most,
or a single longer item.  The item ids are joined to the hits; the documents are
never shuffled.

Defined results: null and empty texts match nothing.  The few letters of an item
shorter than ``min_chars`` occur inside other words of clean text as well: such
an item has no edits to spend and counts only between word boundaries.
Repeated documents and items are reported row by row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import by_bytes, texts

#: Edits allowed, as a share of the item's characters.
ERROR_RATE = 0.08

#: Shortest item that may be edited or lie within a word, in normalized characters.
MIN_CHARS = 32

#: Bytes of item text in one block, and so in one broadcast.
BLOCK_BYTES = 4 << 20


def normalize(text: str) -> str:
    return " ".join(text.lower().split())


#: A letter or digit of a script that parts words; Thai to Khmer and Chinese to
#: Japanese are written without spaces, so any place in them may be a boundary.
_WORD = re.compile(r"(?![\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])\w")


def on_boundaries(text: str, start: int, end: int) -> bool:
    """Whether neither end of ``text[start:end]`` lies within a word."""
    return not any(0 < i < len(text) and _WORD.match(text[i - 1]) and _WORD.match(text[i])
                   for i in (start, end))


def budget(item: str, error_rate: float) -> int:
    return int(len(item) * error_rate)


def cut_pieces(item: str, count: int) -> Iterator[tuple[int, str]]:
    """(offset, piece) of ``count`` pieces of nearly equal length."""
    for k in range(count):
        a, b = len(item) * k // count, len(item) * (k + 1) // count
        yield a, item[a:b]


def best_distance(pattern: str, text: str) -> int:
    """Smallest edit distance between ``pattern`` and any substring of ``text``.

    Myers' algorithm: one column of the dynamic programme as two bit vectors.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best = m
    for c in text:
        eq = where.get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = (down | ~(horizontal | up)) & full
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            best = min(best, score)
        plus, minus = plus << 1 & full, minus << 1 & full
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical
    return best


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float, min_chars: int):
        self.min_chars = min_chars
        self.items = [(key, text, budget(text, error_rate) if len(text) >= min_chars else 0)
                      for key, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, edits) in enumerate(self.items):
            for at, piece in cut_pieces(text, edits + 1):
                places.setdefault(piece, []).append((n, at + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, at)
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> Iterator[tuple[object, int, int]]:
        """(item key, distance, budget) of every item found in ``text``."""
        if not self.items:
            return
        text = normalize(text)
        starts: dict[int, list[int]] = {}
        short: set[int] = set()
        for end, places in self.automaton.iter(text):
            for n, at in places:
                if len(self.items[n][1]) >= self.min_chars:
                    starts.setdefault(n, []).append(end - at)
                elif n not in short and on_boundaries(text, end - at, end + 1):
                    short.add(n)
        for n in short:
            yield self.items[n][0], 0, 0
        for n, found in starts.items():
            key, item, edits = self.items[n]
            best = edits + 1
            if item in text:
                best = 0
            else:
                for low, high in _merge(found, len(item) + 2 * edits):
                    part = text[max(0, low - edits):high + len(item) + edits]
                    best = min(best, best_distance(item, part))
            if best <= edits:
                yield key, best, edits


def _merge(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last start of each cluster, so that no text is searched twice."""
    starts = sorted(starts)
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > gap:
            yield low, high
            low = s
        high = s
    yield low, high


def _normalized(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, text, key): the normalized items that are not empty, and their digest."""
    rows = texts(items, id_col=id_col, text_col=text_col).withColumnRenamed("doc_id", "item_id")
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, "text"):
            text = [normalize(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(text, pa.string())], names=["item_id", "text"])

    return rows.mapInArrow(run, f"item_id {kind}, text string").filter("text != ''").withColumn(
        "key", F.sha2("text", 256))


def pack(rows: Iterator[tuple[str, str]], limit: int) -> Iterator[list[tuple[str, str]]]:
    """Lists of (key, text) with at most ``limit`` bytes of text, or one longer item."""
    block, held = [], 0
    for key, text in rows:
        size = len(text.encode())
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((key, text))
        held += size
    if block:
        yield block


def _blocks(items: DataFrame, error_rate: float, min_chars: int):
    """Broadcast items, each of them once, in blocks of at most BLOCK_BYTES."""
    rows = items.select("key", "text").dropDuplicates(["key"])
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The driver reads a partition at a time.
    rows = rows.repartition(max(1, math.ceil(size / BLOCK_BYTES)))
    empty = True
    for block in pack(((r.key, r.text) for r in rows.toLocalIterator()), BLOCK_BYTES):
        empty = False
        # The automaton is built where it is used: items are smaller to send.
        yield items.sparkSession.sparkContext.broadcast((block, error_rate, min_chars))
    if empty:
        yield items.sparkSession.sparkContext.broadcast(([], error_rate, min_chars))


_built: list = [None, None]


def _matcher(sent) -> Matcher:
    """The matcher of a broadcast block, built once in a worker."""
    if _built[0] is not sent:
        _built[:] = sent, Matcher(*sent)
    return _built[1]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, budget."""
    rows = texts(docs, id_col=id_col, text_col=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key string, distance int, budget int"
    named = _normalized(items, item_id_col, item_text_col)

    def search(sent):
        def run(batches):
            match = _matcher(sent.value)
            for batch in by_bytes(batches, "text"):
                keys, owner = batch.column("doc_id"), []
                found = []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    for hit in match(text):
                        owner.append(i)
                        found.append(hit)
                if found:
                    item, distance, most = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(owner)), pa.array(item, pa.string()),
                         pa.array(distance, pa.int32()), pa.array(most, pa.int32())],
                        names=["doc_id", "key", "distance", "budget"])

        return rows.mapInArrow(run, schema)

    hits = reduce(DataFrame.union, (search(b) for b in _blocks(named, error_rate, min_chars)))
    return hits.join(named.select("key", "item_id"), "key").select(
        "doc_id", "item_id", "distance", "budget")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents, with all columns, in which no item is found."""
    def clean(held, sent):
        def run(batches):
            match = _matcher(sent.value)
            for batch in by_bytes(batches, text_col):
                keep = [next(match(t or ""), None) is None
                        for t in batch.column(text_col).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return held.mapInArrow(run, held.schema)

    named = _normalized(items, item_id_col, item_text_col)
    for sent in _blocks(named, error_rate, min_chars):
        docs = clean(docs, sent)
    return docs
