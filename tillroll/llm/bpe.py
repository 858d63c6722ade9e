"""Byte-level BPE encoding and decoding with Spark's array functions.

A text is split into words by the tokenizer's pattern, in the JVM.  Documents
are packed into blocks of bounded bytes, and each block's distinct words are
encoded once: a fold over the word's bytes merges, step by step, the
neighbouring pieces whose union has the lowest rank (the leftmost of equals),
just as the reference algorithm does.  The fold's steps are projections one
after another, without lambdas, whose bodies Spark interprets; these it compiles.
Pieces are held as their ids.  Which two ids have a union, and its rank, is a table
of rows laid over one another in an array (``pair_table``), so that a pair costs
two array accesses; it travels with each block.  A block's words leave the fold
in their order, the last one with the block's documents, whose ids are then put
together.  Decoding concatenates the pieces of the ids.

The fold has a step per byte; a word longer than ``LONG_WORD`` bytes is merged with
a heap in the worker that packs the block, to the same ids, and a word that is a
piece itself is looked up there.  Nothing is shuffled.

Defined results: a null or empty text has no ids and decodes to nothing.
Repeated rows and null ids are encoded row by row; other columns are left out.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose distinct words are encoded together.
BLOCK_BYTES = 4 << 20

#: White space as the tokenizer's pattern means it (fixed values).
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

#: Bytes of a word beyond which it is merged with a heap.
LONG_WORD = 32

#: A piece in the fold: 24 bits of id, 16 of its place in the word, and above them
#: the rank of its union with the next one, or ``_NONE``.
_ID, _PAIR = 24, 40
_PLACES = (1 << _PAIR - _ID) - 1
_NONE = 1 << 22


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` vocabulary file (read on the driver)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def _class_ranges(kind: str) -> str:
    """Ranges from U+0870 of a Unicode class, as the tokenizer library knows it.

    Java's tables are older, so letters added since would split words elsewhere.
    """
    import tiktoken

    single = tiktoken.Encoding(
        "class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)},
        special_tokens={})
    ranges: list[list[int]] = []
    for low in range(0x870, 0x110000, 1 << 12):  # a few thousand points at a time
        some = "".join(chr(c) for c in range(low, min(low + (1 << 12), 0x110000))
                       if not 0xD800 <= c < 0xE000)
        for c in map(ord, bytes(single.encode_ordinary(some)).decode()):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


@lru_cache(maxsize=4)
def java_pattern(pattern: str) -> str:
    """The splitting pattern, with the classes it names spelt out for Java."""
    for kind in (r"\p{L}", r"\p{N}"):
        if kind in pattern:
            newer = rf"[\x{{870}}-\x{{10FFFF}}&&[{_class_ranges(kind)}]]"
            pattern = pattern.replace(kind, f"[{kind}{newer}]")
    return pattern.replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(start, union): the pieces ``a`` and ``b`` have a union of rank ``r`` if
    ``union[start[a] + b]`` is ``a << _ID | r``.

    The rows, one per ``a``, are moved against each other until no two entries
    meet, those with most entries first.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
            if left is not None and right is not None:
                rows.setdefault(left, []).append((right, rank))
    ids = max(ranks.values()) + 2  # and one that stands before and after a word
    room = 2 * sum(map(len, rows.values())) + 1
    free = np.ones(room + ids, bool)
    start, union = np.zeros(ids, np.int64), np.full(room + ids, 1 << 62, np.int64)
    draw = np.random.default_rng(0)
    for left, row in sorted(rows.items(), key=lambda r: -len(r[1])):
        right, rank = np.array(row).T
        while True:
            tried = draw.integers(0, room, 64)
            fits = np.flatnonzero(free[tried[:, None] + right].all(1))
            if len(fits):
                break
            more = room // 64 + 1  # the table grows until the row has a place
            free, room = np.append(free, np.ones(more, bool)), room + more
            union = np.append(union, np.full(more, 1 << 62, np.int64))
        start[left] = tried[fits[0]]
        union[start[left] + right] = left << _ID | rank
        free[start[left] + right] = False
    return start, union


def _pieces(ids: np.ndarray, place: np.ndarray, start: np.ndarray, union: np.ndarray) -> np.ndarray:
    """Pieces of the fold: of each id with the next one."""
    rank = np.full(len(ids), _NONE, np.int64)
    entry = union[start[ids[:-1]] + ids[1:]] ^ (ids[:-1] << _ID)
    rank[:-1] = np.minimum(entry, _NONE)  # entries of other rows differ in the id above the rank
    return rank << _PAIR | (place & _PLACES) << _ID | ids


def fold_words(words: DataFrame, steps: int) -> DataFrame:
    """``words`` with ``pieces`` (array<long>, between two that have no union with
    anything) merged ``steps`` times or as long as there are unions; ``start`` and
    ``union`` are columns as well.

    A rank stands above the place in the word, so the smallest piece is the left
    one of the leftmost pair of the lowest rank.  A step ranks the two pairs
    anew that the merged piece is in.
    """

    def long(number):
        return F.lit(number).cast("long")

    def ranked(left, right):
        entry = F.get("union", (F.get("start", left.cast("int")) + right).cast("int"))
        return F.shiftleft(F.least(entry.bitwiseXOR(F.shiftleft(left, _ID)), long(_NONE)), _PAIR)

    def id_of(piece):
        return piece.bitwiseAND(long((1 << _ID) - 1))

    def below(piece):
        return piece.bitwiseAND(long((1 << _PAIR) - 1))

    pieces, low = F.col("pieces"), F.col("_low")
    at = F.array_position(pieces, low).cast("int")  # counts from 1
    new, before = F.shiftright(low, _PAIR), F.get(pieces, at - 2)
    place = low.bitwiseAND(long(_PLACES << _ID))
    merged = F.concat(
        F.slice(pieces, F.lit(1), at - 2),
        F.array(ranked(id_of(before), new) + below(before),
                ranked(new, id_of(F.get(pieces, at + 1))) + place + new),
        F.slice(pieces, at + 2, F.size(pieces)))
    rest = [c for c in words.columns if c != "pieces"]
    for _ in range(steps):
        # Spark makes a step a method of its own, short enough to be compiled, only if
        # the step uses all its columns twice; that is why the others are asked for nulls.
        words = words.select(*rest, "pieces", F.array_min("pieces").alias("_low"))
        words = words.select(*(F.when(F.col(c).isNotNull(), F.col(c)).alias(c) for c in rest),
                             F.when(low >= _NONE << _PAIR, pieces).otherwise(merged).alias("pieces"))
    return words


def merge_with_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word in time n log n: the same merges, found through a heap."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # starts of neighbours
    alive = [True] * n

    def pair(i):
        mid = after[i]
        rank = ranks.get(word[i:after[mid]]) if mid < n else None
        return None if rank is None else (rank, i, mid, after[mid])

    heap = [p for p in map(pair, range(n)) if p]
    heapify(heap)
    while heap:
        _, i, mid, end = heappop(heap)
        if not (alive[i] and after[i] == mid and alive[mid] and after[mid] == end):
            continue  # one of the two has been merged since
        after[i], alive[mid] = end, False
        if end < n:
            before[end] = i
        for at in (i, before[i]):
            if at >= 0 and (p := pair(at)):
                heappush(heap, p)
    return [ranks[word[i:after[i]]] for i in range(n) if alive[i]]


def _blocks(batches, limit: int, ranks: dict[bytes, int], table: tuple[np.ndarray, np.ndarray]):
    """Rows (docs, words, start, union) of documents as indices into a block's
    distinct words, these as pieces, and the table of pairs."""
    held, size = [], 0
    alone = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    around = len(table[0]) - 1

    def pieces(words):
        known = [[ranks[w]] if w in ranks else merge_with_heap(w, ranks) if len(w) > LONG_WORD else None
                 for w in words]
        sizes = np.array([len(w if k is None else k) for w, k in zip(words, known)], np.int64)
        ends = np.cumsum(sizes + 2)
        first = ends - sizes - 2
        ids = np.full(ends[-1], around, np.int64)
        inner = np.ones(len(ids), bool)
        inner[first] = inner[ends - 1] = False
        coded = np.repeat([k is not None for k in known], sizes)
        row = np.zeros(len(coded), np.int64)
        row[coded] = [i for k in known if k is not None for i in k]
        row[~coded] = alone[np.frombuffer(
            b"".join(w for w, k in zip(words, known) if k is None), np.uint8)]
        ids[inner] = row
        place = np.arange(len(ids)) - np.repeat(first, sizes + 2)
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, ends), pa.int32()), _pieces(ids, place, *table))

    def block():
        lists = [pc.fill_null(b.column("words"), []) for b in held]
        coded = pa.chunked_array([x.flatten() for x in lists], pa.string())
        coded = coded.combine_chunks().dictionary_encode()
        ends = np.cumsum([0, *(n for x in lists for n in pc.list_value_length(x).to_pylist())])
        index = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), coded.indices)
        ids, rest = (pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "rest"))
        docs = pa.StructArray.from_arrays([ids, rest, index], names=["doc_id", "rest", "index"])
        # One more word, so that no block is without.
        words = pieces([*coded.dictionary.cast(pa.binary()).to_pylist(), b""])
        parts = [docs, words, *map(pa.array, table)]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in parts],
            names=["docs", "words", "start", "union"])

    for batch in batches:
        sizes = pc.list_flatten(batch.column("words")).nbytes / max(1, batch.num_rows)
        step = max(1, int(limit / max(1.0, sizes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            if held and size + sizes * part.num_rows > limit:
                yield block()
                held, size = [], 0
                pa.default_memory_pool().release_unused()
            held.append(part)
            size += sizes * part.num_rows
    if held:
        yield block()


def _documents(batches):
    """Rows (doc_id, ids, rest) of documents: a block's words come in order, the
    last one with its documents."""

    def put_together(words, docs):
        words = pa.concat_arrays(words)
        around = np.cumsum(pc.list_value_length(words).to_numpy())
        inner = np.ones(around[-1], bool)
        inner[around - 1] = inner[np.append(0, around[:-1])] = False
        ids = words.flatten().to_numpy()[inner] & ((1 << _ID) - 1)
        ends = np.append(0, around - 2 * np.arange(1, len(around) + 1))
        codes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        kind, rest, index = docs.flatten()
        at = index.flatten()
        length = np.append(0, np.cumsum(np.diff(ends)[at.to_numpy()]))
        word_ends = np.append(0, np.cumsum(pc.list_value_length(index).to_numpy()))
        ids = pa.ListArray.from_arrays(pa.array(length[word_ends], pa.int32()), codes.take(at).flatten())
        return pa.RecordBatch.from_arrays([kind, ids, rest], names=["doc_id", "ids", "rest"])

    held = []
    for batch in batches:
        begin, docs = 0, batch.column("docs")
        for last in np.flatnonzero(pc.list_value_length(docs).to_numpy()).tolist():
            held.append(batch.column("pieces").slice(begin, last + 1 - begin))
            yield put_together(held, docs.slice(last, 1).flatten())
            held, begin = [], last + 1
            pa.default_memory_pool().release_unused()
        held.append(batch.column("pieces").slice(begin))


def bpe_encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, ids (array<int>), and the columns ``keep``."""
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte-level vocabulary has a rank for every byte")
    if len(set(ranks.values())) < len(ranks) or not 0 <= min(ranks.values()) <= max(ranks.values()) < _NONE:
        raise ValueError(f"ranks are ids: each stands once, and is below {_NONE}")
    words = docs.select(
        docs[id_col].alias("doc_id"), F.struct(F.lit(0).alias("_"), *(docs[c] for c in keep)).alias("rest"),
        F.regexp_extract_all(
            F.coalesce(docs[text_col], F.lit("")), F.lit(java_pattern(pattern)), F.lit(0)).alias("words"))
    kind, rest = (words.schema[c].dataType.simpleString() for c in ("doc_id", "rest"))
    # A vocabulary file's bounded size.
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pair_table(ranks)))
    packed = f"array<struct<doc_id: {kind}, rest: {rest}, index: array<int>>>"
    blocks = words.mapInArrow(
        lambda batches: _blocks(batches, block_bytes, *sent.value),
        f"docs {packed}, words array<array<bigint>>, start array<bigint>, union array<bigint>")
    each = blocks.select("*", F.size("words").alias("n"), F.posexplode("words")).select(
        # An empty array, not a null: Arrow's writer goes over a run of nulls again for each row.
        F.when(F.col("pos") == F.col("n") - 1, F.col("docs")).otherwise(
            F.array().cast(packed)).alias("docs"), "start", "union",
        F.col("col").alias("pieces"))
    found = fold_words(each, LONG_WORD - 1).select("pieces", "docs").mapInArrow(
        _documents, f"doc_id {kind}, ids array<int>, rest {rest}")
    return found.select("doc_id", "ids", *(F.col("rest")[c].alias(c) for c in keep))


def decode_ids(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes (binary) that an array of ids stands for; unknown ids add nothing."""
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.encode(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""), "ISO-8859-1")
