"""Language-model scoring by context-tree weighting over bytes.

The model predicts a text's bytes (A-Z in lower case) and then its end, each as
eight binary decisions, in the context of the ``depth`` bytes before it.  Every context of every length from 0
to ``depth`` has an estimator for every decision (Krichevsky-Trofimov: counts
plus one half).  Context-tree weighting mixes the estimates of all depths: at
each context, the share of "stop here" against "look one byte further back" is
set by how well either has coded the training text.  The result is a code
length per byte, that is, the log probability of a text.

Training counts come from all training documents.  A counting task passes on a
packed row per bucket of grams, which are dealt by their last ``TABLE_DEPTH``
bytes of context, and of words.  The tree is built bottom up and read top down.
Up to ``TABLE_DEPTH`` bytes of context that is one aggregation and one join per
depth, with a row per context and decision seen; the deeper levels are worked out
bucket by bucket, in slices of whole contexts.

Scoring moves no text.  The ``GRAM_SHARE`` most frequent grams and the
``WORD_SHARE`` most frequent words are broadcast, whatever the corpus.  Everything
rarer is listed per document, joined with the full tables and added up; a rare key
is never a hot one.

Defined results: a null or empty text is its end alone, one token and one byte.  A
null id counts as the empty string when documents are dealt to training and
held-out.  Repeated rows are separate documents.  Extra columns are left out.
"""

from __future__ import annotations

import math
import zlib
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import by_bytes, materialize, release, texts

#: Bytes of context unless given, and at most: a gram must fit a long.
DEPTH, MAX_DEPTH = 3, 6

#: Bytes of context up to which a level of the tree is a table.
TABLE_DEPTH = 3

#: Grams and words that may be broadcast, the most frequent ones.
GRAM_SHARE, WORD_SHARE = 1 << 22, 1 << 18

#: Grams of whole groups that a task works out at a time.
_ROWS = 1 << 18

#: Whether a byte is white space.
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))

#: Distinct entries that a counting task holds before it passes them on.
_HELD = 1 << 19

#: Buckets that grams (by their ``TABLE_DEPTH`` bytes of context) and words are dealt to.
BUCKETS = 1021

#: The byte that ends every document: UTF-8 has no such byte.
_STOP = b"\xff"

_HALF = math.log(0.5)


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether a document is kept from training: crc32 of its id as text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def tokens(batch_texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct tokens, the one at each place, its document): words, then the end,
    an empty token (no word is empty)."""
    raw = [t.encode().lower() for t in batch_texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    space = _SPACE[data]
    last = np.zeros(len(data), bool)
    last[np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) - 1] = True
    new = last.copy()
    new[:1] |= ~space[:1]
    new[1:] |= space[:-1] & ~space[1:]
    start = np.flatnonzero(new)
    is_end = last[start]
    ends = np.where(is_end, start, 0)
    ends[~is_end] = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    # The words and what lies between them, in turn.
    cuts = np.stack([start, ends], 1).astype(np.int32).ravel()
    both = pa.Array.from_buffers(pa.binary(), max(0, len(cuts) - 1), [
        None, pa.py_buffer(cuts), pa.py_buffer(data)])
    found = both.take(pa.array(np.arange(0, len(both), 2))).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.cumsum(is_end) - is_end


def byte_grams(batch_texts: list[str], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(gram of every byte, its document): ``depth`` context bytes, the last one
    first, then the byte, so that in sorted grams every context is one run.

    Before a document's start the context is filled up with zeros; its end is
    coded as one more byte.
    """
    pad = bytes(depth)
    raw = [pad + t.encode().lower() + _STOP for t in batch_texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    raw.append(bytes(8))
    data = np.frombuffer(b"".join(raw), np.uint8)
    n = max(0, int(sizes.sum()) - depth)
    # The eight bytes from each place on, read as one number, last byte highest.
    grams = np.ndarray((n,), "<i8", data, strides=(1,)) & ((1 << 8 * depth) - 1)
    grams <<= 8
    grams |= data[depth:depth + n]
    # A gram is numbered by its last byte; the padding itself is not predicted.
    real = np.ones(n + depth, bool)
    starts = np.cumsum(sizes) - sizes
    for i in range(depth):
        real[starts + i] = False
    owner = np.repeat(np.arange(len(sizes)), sizes - depth)
    return grams[real[depth:]], owner


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers as compressed bytes, all first bytes in front."""
    return pa.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes, n: int, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_sorted(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(packed, n))


def _summed(parts: list) -> tuple:
    """Parts (keys, train, seen) as one with sorted distinct keys; empties the list."""
    columns = [list(c) for c in zip(*parts)]
    parts.clear()
    keys = np.concatenate(columns.pop(0))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    found = [keys[first]]
    del keys
    while columns:  # one at a time, to hold less
        found.append(np.add.reduceat(np.concatenate(columns.pop(0))[order], first))
    return tuple(found)


def _summed_words(parts):
    """Parts (words, train, seen) as one with distinct words."""
    keys, *counts = zip(*parts)
    found = pa.concat_arrays(keys).dictionary_encode()
    code = found.indices.to_numpy()
    return found.dictionary, *(np.bincount(code, np.concatenate(c)).astype(np.int64) for c in counts)


def _counted(rows: DataFrame, depth: int, then=None, schema: str | None = None) -> DataFrame:
    """(gram, word, train, seen): counts per task, one of gram and word null.

    ``then`` turns the batches into others, of ``schema``, in the same task.
    """

    def entries(gram, word, train, seen):
        n = len(train)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()) if gram is None else pa.array(gram, pa.int64()),
             pa.nulls(n, pa.binary()) if word is None else word,
             pa.array(train, pa.int64()), pa.array(seen, pa.int64())],
            names=["gram", "word", "train", "seen"])

    def count(batches):
        grams, words = [], []

        def runs(found, out):
            # The lowest bit tells held-out grams apart.
            keys = found << 1 | out
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            n = np.diff(np.append(first, len(keys)))
            keys = keys[first]
            return keys >> 1, n * (1 - (keys & 1)), n

        parts = 0
        for batch in by_bytes(batches, "text"):
            held, out = batch.column("text").to_pylist(), np.array(batch.column("held_out"), bool)
            distinct, code, owner = tokens(held)
            words.append((distinct, np.bincount(code, ~out[owner], len(distinct)).astype(np.int64),
                          np.bincount(code)))
            found, owner = byte_grams(held, depth)
            grams.append(runs(found, out[owner]))
            parts += 1
            if parts % 8 == 0:  # what is held is merged before it is passed on
                grams[:], words[:] = [_summed(grams)], [_summed_words(words)]
                if len(words[0][0]) > _HELD:
                    yield entries(None, *words.pop())
            if parts % 32 == 0 and len(grams[0][0]) > _HELD:
                keys, *counts = grams.pop()
                yield entries(keys, None, *counts)
        if words:
            yield entries(None, *_summed_words(words))
            words.clear()
        if grams:
            grams[:] = [_summed(grams)]
            keys, *counts = grams.pop()
            yield entries(keys, None, *counts)

    return rows.mapInArrow(lambda batches: then(count(batches)) if then else count(batches),
                           schema or "gram long, word binary, train long, seen long")


_PACKED = "bucket int, n int, grams binary, words binary, train binary, seen binary"

_MERGED = ("bucket int, n int, grams binary, train binary, seen binary, n_bytes long, "
           "word binary, word_train long, word_seen long, "
           "context long, node int, n0 long, n1 long, weighted double")


def _rows_of(schema: str, columns: dict) -> pa.RecordBatch:
    """A batch of ``schema``, null where ``columns`` has nothing."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, kinds[k]) if f not in columns else columns[f] if isinstance(columns[f], pa.Array)
         else pa.array(columns[f], kinds[k]) for f, k in fields],
        names=[f for f, _ in fields])


def _dealt(depth: int, top: int):
    """Turns the counts of a task into a row per bucket."""

    def deal(batches):
        for batch in batches:
            counts = [batch.column(c).to_numpy() for c in ("train", "seen")]
            if batch.column("word").null_count:
                kind, keys = "grams", batch.column("gram").to_numpy()
                bucket = (keys >> 8 * (depth - top + 1)) % BUCKETS
            else:
                kind, keys = "words", batch.column("word").to_numpy(zero_copy_only=False)
                bucket = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % BUCKETS
            order = np.argsort(bucket.astype(np.int16), kind="stable")
            keys, bucket, counts = keys[order], bucket[order], [c[order] for c in counts]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            ends = [0, *cuts.tolist(), len(keys)]
            spans = list(zip(ends, ends[1:]))
            # A word holds no white space.
            yield _rows_of(_PACKED, {
                "bucket": bucket[ends[:-1]], "n": np.diff(ends),
                kind: [_pack_sorted(keys[a:b]) if kind == "grams" else b"\n".join(keys[a:b])
                       for a, b in spans],
                "train": [_pack(counts[0][a:b]) for a, b in spans],
                "seen": [_pack(counts[1][a:b]) for a, b in spans]})

    return deal


def _buckets(batches):
    """(bucket, its batches) of batches sorted by bucket."""
    held, last = [], None
    for batch in batches:
        keys = batch.column("bucket").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(ends, ends[1:]):
            if a < b:
                if held and keys[a] != last:
                    yield last, held
                    held = []
                last = int(keys[a])
                held.append(batch.slice(a, b - a))
    if held:
        yield last, held


def _by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket")


def _merged(packed: DataFrame, depth: int, top: int) -> DataFrame:
    """The counts of all tasks: a row per bucket with its sorted grams, a row per word,
    and the decisions in contexts of ``top`` bytes with what their longer ones code."""

    def merge(batches):
        for bucket, held in _buckets(batches):
            words, parts, size = [], [], 0
            for row in (r for batch in held for r in batch.to_pylist()):
                train, seen = (_unpack(row[c], row["n"]) for c in ("train", "seen"))
                if row["grams"] is None:
                    words.append((pa.array(row["words"].split(b"\n"), pa.binary()), train, seen))
                    continue
                parts.append((_unpack_sorted(row["grams"], row["n"]), train, seen))
                size += row["n"]
                if size > 4 * _ROWS:
                    parts, size = [_summed(parts)], 0
            if words:
                keys, train, seen = _summed_words(words)
                yield _rows_of(_MERGED, {"word": keys, "word_train": train, "word_seen": seen})
            if parts:
                grams, train, seen = _summed(parts)
                yield _rows_of(_MERGED, {
                    "bucket": [bucket], "n": [len(grams)], "grams": [_pack_sorted(grams)],
                    "train": [_pack(train)], "seen": [_pack(seen)], "n_bytes": [int(seen.sum())]})
                near = grams >> 8 * (depth - top + 1)
                for a, b in _slices(near):
                    at, node, n0, n1, longer = map(
                        np.concatenate, zip(*(x[:5] for x in _deep(grams[a:b], train[a:b], depth, top)[-1])))
                    yield _rows_of(_MERGED, {
                        "context": near[a:b][at], "node": node, "n0": n0.astype(np.int64),
                        "n1": n1.astype(np.int64), "weighted": longer})

    return _by_bucket(packed).mapInArrow(merge, _MERGED)


def _least(counts: DataFrame, total: int, most: int) -> int:
    """The smallest ``seen`` that no more than ``most`` entries reach.

    ``counts`` has ``n`` entries per ``seen``, whose occurrences are ``total`` in all:
    fewer than ``most`` can have more than their share, so all those count as one.
    """
    least = above = total // most + 1
    rows = counts.groupBy(F.least("seen", F.lit(above)).alias("seen")).agg(F.sum("n")).collect()
    for seen, n in sorted(rows, reverse=True):
        most -= n
        if most < 0:
            break
        least = seen
    return least


def _log_gamma(x, log=F.log):
    """ln of the gamma function for x >= 1/2: Stirling's series at x + 8."""
    y = x + 8
    below = x
    for i in range(1, 8):
        below = below * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + series - log(below)


def _estimate(n0, n1, log=F.log):
    """Log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones.

    Of columns, or with ``np.log`` of arrays.
    """
    return (_log_gamma(n0 + 0.5, log) + _log_gamma(n1 + 0.5, log)
            - _log_gamma(n0 + n1 + 1, log) - math.log(math.pi))


def _slices(near: np.ndarray):
    """Ends of slices of whole groups of sorted ``near``, _ROWS grams or more each."""
    start = 0
    while start < len(near):
        last = near[min(start + _ROWS, len(near)) - 1]
        end = int(np.searchsorted(near, last, "right"))
        yield start, end
        start = end


class _Decisions(NamedTuple):
    """The decisions on one bit of the byte, at one depth of context."""

    at: np.ndarray  # the first gram of each
    node: np.ndarray  # a one and the byte's bits before this one
    n0: np.ndarray
    n1: np.ndarray
    longer: np.ndarray  # what the longer contexts code
    stop: np.ndarray  # the share of the context's own estimate
    parent: np.ndarray | None  # the decision in the context that is a byte shorter


def _deep(grams: np.ndarray, train: np.ndarray, depth: int, top: int) -> list[list[_Decisions]]:
    """The decisions of the sorted ``grams`` on each bit, from ``depth`` up to ``top``."""
    keys, n, at = grams, train.astype(float), np.arange(len(grams))
    levels: list[list[_Decisions]] = []
    coded: list[tuple] = []  # of the level below: the first key of each decision, its code
    for d in range(depth, top - 1, -1):
        if d < depth:
            # The byte furthest back is the lowest of the context.
            keys, first, place = np.unique(keys >> 16 << 8 | keys & 255, return_index=True,
                                           return_inverse=True)
            n, at = np.bincount(place, n, len(keys)), at[first]
        level, below, coded = [], coded, []
        for j in range(8):
            part = keys >> (8 - j)
            new = np.append(True, part[1:] != part[:-1])
            start = np.flatnonzero(new)
            n1 = np.add.reduceat(n * (keys >> (7 - j) & 1), start)
            n0 = np.add.reduceat(n, start) - n1
            alone = _estimate(n0, n1, np.log)
            if d == depth:
                longer, code, stop = np.zeros(len(start)), alone, np.ones(len(start))
            else:
                child, weighted = below[j]
                parent = (np.cumsum(new) - 1)[place[child]]
                levels[-1][j] = levels[-1][j]._replace(parent=parent)
                longer = np.bincount(parent, weighted, len(start))
                both = np.logaddexp(alone, longer)
                code, stop = both + _HALF, np.exp(alone - both)
            byte = keys[start] & 255
            level.append(_Decisions(at[start], byte >> (8 - j) | 1 << j, n0, n1, longer, stop, None))
            coded.append((start, code))
        levels.append(level)
    return levels


def _occurrences(grams: DataFrame, most: int) -> DataFrame:
    """(seen, n): how many grams occur so often; from ``most`` on they are one group."""

    def count(batches):
        for batch in batches:
            for seen, n in zip(*(batch.column(c).to_pylist() for c in ("seen", "n"))):
                kinds, n = np.unique(np.minimum(_unpack(seen, n), most), return_counts=True)
                yield pa.RecordBatch.from_pydict({"seen": kinds, "n": n})

    return grams.select("seen", "n").mapInArrow(count, "seen long, n long")


def _tree(below: DataFrame, depth: int, top: int) -> list[tuple[DataFrame, str]]:
    """Tables (context, node, n0, n1, stop) per depth up to ``top``: ``stop`` is the
    share of the context's own estimate, the rest being that of the longer contexts."""
    levels = []
    for d in range(top, -1, -1):
        own = F.col("context") if d == top else F.shiftright("context", 8)
        table = below.groupBy(own.alias("context"), "node").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("longer"))
        table = table.withColumn("alone", _estimate(F.col("n0").cast("double"), F.col("n1").cast("double")))
        if d == depth:
            table = table.withColumn("weighted", F.col("alone")).withColumn("stop", F.lit(1.0))
        else:
            most = F.greatest("alone", "longer")
            both = most + F.log(F.exp(F.col("alone") - most) + F.exp(F.col("longer") - most))
            table = table.withColumn("weighted", both + _HALF).withColumn(
                "stop", F.exp(F.col("alone") - both))
        levels.append(materialize(
            table.select("context", "node", "n0", "n1", "weighted", "stop"), f"tree-{d}"))
        below = levels[-1][0].drop("stop")
    return levels[::-1]


def _gram_scores(grams: DataFrame, levels: list[DataFrame], depth: int, least: int) -> DataFrame:
    """(gram, often, score): log10 probability of the gram's byte in its context, and
    whether it was seen ``least`` times."""
    one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    mixed = levels[0].select("context", "node", (F.col("stop") * one).alias("p"),
                             (1 - F.col("stop")).alias("rest"))
    top = len(levels) - 1
    for d in range(1, top + 1):
        parent = mixed.select(F.col("context").alias("_c"), F.col("node").alias("_n"), "p", "rest")
        mixed = levels[d].join(
            parent, (F.shiftright("context", 8) == F.col("_c")) & (F.col("node") == F.col("_n"))
        ).select("context", "node", (F.col("p") + F.col("rest") * F.col("stop") * one).alias("p"),
                 (F.col("rest") * (1 - F.col("stop"))).alias("rest"))

    def score_slice(grams, train, above):
        levels = _deep(grams, train, depth, top)
        total = np.zeros(len(grams))
        for j in range(8):
            # The rows from above are sorted, and so are the decisions.
            mine = above["node"] >> j == 1
            p, rest = above["p"][mine], above["rest"][mine]
            for level in levels[-2::-1]:
                _, _, n0, n1, _, stop, parent = level[j]
                own = rest[parent] * stop
                p, rest = p[parent] + own * (n1 + 0.5) / (n0 + n1 + 1), rest[parent] - own
            run = np.zeros(len(grams), np.int64)
            run[levels[0][j].at[1:]] = 1
            run = np.cumsum(run)
            total += np.where(grams >> (7 - j) & 1, np.log10(p)[run], np.log10(1 - p)[run])
        return total

    def score(batches):
        for bucket, held in _buckets(batches):
            table = pa.Table.from_batches(held)
            above = table.filter(table.column("node").is_valid()).sort_by(
                [("context", "ascending"), ("node", "ascending")])
            above = {c: above.column(c).to_numpy() for c in ("context", "node", "p", "rest")}
            row, = table.filter(table.column("grams").is_valid()).to_pylist()
            grams, n = _unpack_sorted(row["grams"], row["n"]), row["n"]
            train, often = _unpack(row["train"], n), _unpack(row["seen"], n) >= least
            near = grams >> 8 * (depth - top + 1)
            scores = np.empty(n)
            for a, b in _slices(near):
                c, d = np.searchsorted(above["context"], near[a]), np.searchsorted(
                    above["context"], near[b - 1], "right")
                scores[a:b] = score_slice(
                    grams[a:b], train[a:b], {k: x[c:d] for k, x in above.items()})
            yield pa.RecordBatch.from_pydict({"gram": grams, "often": often, "score": scores})

    both = grams.select("bucket", "n", "grams", "train", "seen").unionByName(
        mixed.withColumn("bucket", (F.col("context") % BUCKETS).cast("int")), allowMissingColumns=True)
    return _by_bucket(both).mapInArrow(score, "gram long, often boolean, score double")


def _scan(rows: DataFrame, sent, depth: int) -> DataFrame:
    """One row per document: what the broadcast entries give, and the rest as lists.

    ``uid`` numbers the rows of the table this is written to.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches):
        (gaps, values, n_often), (words, counts, n_words), unit = sent.value
        keys, values = _unpack_sorted(gaps, n_often), _unpack(values, n_often, np.float64)
        words = dict(zip(words.split(b"\n"), _unpack(counts, n_words).tolist())) if n_words else {}
        number = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "text"):
            held = batch.column("text").to_pylist()
            n = len(held)
            grams, owner = byte_grams(held, depth)
            order = np.argsort(grams)
            grams = grams[order]
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            distinct, times = grams[first], np.diff(np.append(first, len(grams)))
            at = np.minimum(np.searchsorted(keys, distinct), max(0, len(keys) - 1))
            known = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
            value = np.empty(len(grams))
            value[order] = np.repeat(np.where(known, values[at] if len(keys) else 0.0, 0.0), times)
            total = np.bincount(owner, value, n)
            far = np.repeat(~known, times)
            gram_rest = _lists(owner[order[far]], grams[far], n, pa.int64())

            distinct, code, owner = tokens(held)
            distinct = distinct.to_numpy(zero_copy_only=False)
            count = np.fromiter(map(words.get, distinct, repeat(-1)), np.int64, len(distinct))
            base = np.where(count >= 0, np.log10((np.maximum(count, 0) + 0.5) / unit), 0.0)
            far = np.flatnonzero((count < 0)[code])
            word_rest = _lists(owner[far], code[far], n, pa.binary(), distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + np.arange(n)), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(np.bincount(owner, minlength=n)),
                 pa.array(np.bincount(owner, (count > 0)[code], n).astype(np.int64)),
                 pa.array(np.bincount(owner, base[code], n)), pa.array(total),
                 gram_rest, word_rest],
                names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score",
                       "grams", "words"])
            number += n

    pair = "array<struct<key: {}, n: int>>"
    return rows.mapInArrow(
        score, f"uid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
               f"base_score double, score double, grams {pair.format('long')}, "
               f"words {pair.format('binary')}")


def _lists(owner, keys, n, kind, names=None) -> pa.Array:
    """Per document the distinct keys (or ``names`` of them) with their counts."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(keys) != 0)])[:len(owner)]
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(owner)]]))
    shown = keys[first] if names is None else [names[k] for k in keys[first]]
    ends = np.searchsorted(owner[first], np.arange(n + 1))
    pairs = pa.StructArray.from_arrays(
        [pa.array(shown, kind), pa.array(count, pa.int32())], names=["key", "n"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def score_texts(
    docs: DataFrame,
    *,
    folds: int = 5,
    fold: int = 1,
    depth: int = DEPTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigram words) and score (context-tree weighting), both log10.
    ``depth`` is the bytes of context.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be 0 to {MAX_DEPTH}")
    top = min(depth, TABLE_DEPTH)
    spark = docs.sparkSession
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn(
        "held_out", held_out(F.col("doc_id"), folds, fold))
    counts, _ = materialize(_merged(
        _counted(rows, depth, _dealt(depth, top), _PACKED), depth, top), "counts")
    grams = counts.filter("grams IS NOT NULL").select("bucket", "n", "grams", "train", "seen", "n_bytes")
    words = counts.filter("word IS NOT NULL").select(
        "word", F.col("word_train").alias("train"), F.col("word_seen").alias("seen"))
    n_train, n_distinct, n_tokens = (x or 0 for x in words.agg(
        F.sum("train"), F.count_if(F.col("train") > 0), F.sum("seen")).first())
    n_bytes = grams.agg(F.sum("n_bytes")).first()[0] or 0
    unit = n_train + 0.5 * (n_distinct + 1)

    tree = _tree(counts.filter("context IS NOT NULL").select(
        "context", "node", "n0", "n1", "weighted"), depth, top)
    least = _least(_occurrences(grams, n_bytes // GRAM_SHARE + 1), n_bytes, GRAM_SHARE)
    scored, _ = materialize(_gram_scores(grams, [t for t, _ in tree], depth, least), "gram-scores")
    paths = [path for _, path in tree]
    del tree
    release(spark, *paths)
    often = scored.filter("often").select("gram", "score").toArrow()
    order = np.argsort(often.column("gram").to_numpy())
    often = (_pack_sorted(often.column("gram").to_numpy()[order]),
             _pack(often.column("score").to_numpy()[order]), len(order))
    least = _least(words.select("seen", F.lit(1).alias("n")), n_tokens, WORD_SHARE)
    common = words.filter(F.col("seen") >= least).select("word", "train").toArrow()
    sent = spark.sparkContext.broadcast((often, (
        b"\n".join(common.column("word").to_pylist()), _pack(common.column("train").to_numpy()),
        common.num_rows), unit))
    del often, order, common
    found, _ = materialize(_scan(rows, sent, depth), "scores")

    def rest(column, table, key, value):
        part = found.select("uid", F.explode(column).alias("e")).select("uid", "e.key", "e.n")
        return part.join(table.withColumnRenamed(key, "key"), "key").groupBy("uid").agg(*value)

    gram_rest = rest("grams", scored.filter("NOT often").select("gram", F.col("score").alias("s")), "gram",
                     [F.sum(F.col("n") * F.col("s")).alias("more_score")])
    unigram = F.log10((F.col("train") + 0.5) / F.lit(unit))
    word_rest = rest("words", words.select("word", "train"), "word",
                     [F.sum(F.col("n") * unigram).alias("more_base"),
                      F.sum(F.when(F.col("train") > 0, F.col("n")).otherwise(0)).alias("more_known")])
    zero = F.lit(0)
    return (
        found.drop("grams", "words").join(gram_rest, "uid", "left").join(word_rest, "uid", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            (F.col("base_score") + F.coalesce("more_base", zero)).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", zero)).alias("score"))
    )
