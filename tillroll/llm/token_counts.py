"""Token counts under a public tokenizer, by batch encoding in Arrow functions.

Only lengths leave the Python workers.  Batches are balanced by bytes, and a
long text is encoded in pieces cut where the tokenizer could not have joined
anything across, so one huge document neither fills a batch nor makes the
encoder's own buffers grow with it.  The pieces' counts add up to the whole
text's count exactly.

Defined results: a null or empty text has 0 bytes and 0 tokens.  Repeated rows
and null ids are counted row by row.  Other input columns are left out.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BATCH_BYTES, arrow_map, texts

#: Characters after which a text is cut at the next safe boundary.
PIECE_CHARS = 1 << 16

#: A space between two characters that are not white space (nor the mark
#: U+2581, which piece models use for a space).
_SAFE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


@lru_cache(maxsize=4)
def _counter(path: str, pattern: str | None):
    """(count a list of pieces, length of what a cut drops or None if uncut)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = "▁"
        names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        joins = any(mark in p.lstrip(mark) for p in names)
        same = model.encode("a b") == model.encode("a") + model.encode("b")
        # Each piece gets a mark in front, so the space at the cut is dropped.
        return (lambda xs: [len(i) for i in model.encode(xs, num_threads=1)],
                1 if same and not joins else None)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        return (lambda xs: [len(e) for e in model.encode_batch(xs, add_special_tokens=False)], 0)
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda xs: [len(model.encode_ordinary(x)) for x in xs], 0


def pieces(text: str, drop: int | None, limit: int = PIECE_CHARS) -> list[str]:
    """Cut ``text`` at the first safe boundary after every ``limit`` characters."""
    out, start = [], 0
    while drop is not None and len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        out.append(text[start:cut.start()])
        start = cut.start() + drop
    return [*out, text[start:]]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    *,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens.

    ``tokenizer`` is a path every executor can open (the installed vocabulary
    files): ``.model``, ``.json`` or ``.tiktoken`` (which needs ``pattern``).
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batch):
        encode, drop = _counter(tokenizer, pattern)
        cut = [pieces(t, drop) for t in batch.column("text").to_pylist()]
        owner = np.repeat(np.arange(len(cut)), [len(p) for p in cut])
        lengths = encode([p for ps in cut for p in ps])
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": batch.column("n_bytes"),
            "n_tokens": np.bincount(owner, lengths, len(cut)).astype(np.int64),
        }

    return arrow_map(
        rows.withColumn("n_bytes", F.octet_length("text").cast("long")), "text", count,
        f"doc_id {kind}, n_bytes long, n_tokens long", batch_bytes)
