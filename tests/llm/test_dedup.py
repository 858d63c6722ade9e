"""Suffix-array, substring and SimHash dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_helpers import frame, llm, make_docs, same  # noqa: F401
from tillroll.llm import anchors, components, simhash, substring_dedup, suffix_dedup


def removed_bytes(docs, depth):
    raw = [(t or "").encode() for _, t in docs]
    count = Counter(b[i:i + depth] for b in raw for i in range(len(b) - depth + 1))
    out = []
    for (d, _), b in zip(docs, raw):
        gone = [False] * len(b)
        for i in range(len(b) - depth + 1):
            if count[b[i:i + depth]] > 1:
                gone[i:i + depth] = [True] * depth
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("seed,depth,hot", [
    (1, 40, 1 << 21), (2, 7, 1 << 21), (1, 90, 1), (2, 40, 1000), (3, 9, 4000)])
def test_suffix_dedup(llm, monkeypatch, seed, depth, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 5000)
    docs = make_docs(seed)
    got = suffix_dedup.suffix_dedup(frame(llm, docs), depth).collect()
    same([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in got], removed_bytes(docs, depth))


@pytest.mark.parametrize("depth", [1, 7, 8, 9, 20])
def test_equal_windows(depth):
    r = random.Random(depth)
    data = bytes(r.choice(b"a\x00\xff") for _ in range(60)) * 3 + bytes(400)
    place = np.array([p for p in range(len(data) - depth + 1) if r.random() < 0.8])
    found, edge = suffix_dedup.equal_windows(np.frombuffer(data, np.uint8), place, depth)
    windows = [data[p:p + depth] for p in place]
    count = Counter(windows)
    got = [windows[i] for i in found]
    assert got == sorted(w for w in windows if count[w] > 1)
    assert len(set(found.tolist())) == len(found)
    assert edge.tolist() == [i for i, w in enumerate(got) if not i or w != got[i - 1]]


def test_suffix_dedup_of_nothing(llm):
    assert suffix_dedup.suffix_dedup(frame(llm, [])).collect() == []


def test_remove_repeats_keeps_columns_and_characters(llm):
    docs = [(1, "é" * 30 + "unique"), (2, "xx" + "é" * 30), (3, None), (None, "short")]
    df = frame(llm, docs)
    got = suffix_dedup.remove_repeats(df, 20)
    assert got.columns == df.columns
    same([(r.doc_id, r.text) for r in got.collect()],
         [(1, "unique"), (2, "xx"), (3, None), (None, "short")])


def removed_words(docs, depth):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - depth + 1) if d is not None else ():
            k = tuple(w[i:i + depth])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(docs, words):
        gone = [False] * len(w)
        for i in range(len(w) - depth + 1) if d is not None else ():
            if first[tuple(w[i:i + depth])] < d:
                gone[i:i + depth] = [True] * depth
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("seed,depth,hot", [(3, 20, 1 << 18), (4, 12, 100), (7, 20, 400), (8, 24, 1)])
def test_substring_dedup(llm, monkeypatch, seed, depth, hot):
    monkeypatch.setattr(substring_dedup, "HOT_WORDS", hot)
    monkeypatch.setattr(substring_dedup, "GROUP_WORDS", 2000)
    docs = make_docs(seed, sep="\t \n")
    same(substring_dedup.substring_dedup(frame(llm, docs), depth).collect(),
         removed_words(docs, depth))


def test_suffix_order_and_common_prefixes():
    r = random.Random(9)
    runs = [[r.randint(0, 1) for _ in range(n)] for n in (1, 40, 7, 0, 33)] + [[1] * 20] * 2
    flat = np.array([x for run in runs for x in run])
    ranks = substring_dedup.suffix_order(flat, np.array([len(x) for x in runs]))
    ends = [run + [2 + i] for i, run in enumerate(runs)]
    suffixes = [run[i:] for run in ends for i in range(len(run))]
    assert np.argsort(ranks[-1]).tolist() == sorted(range(len(suffixes)), key=suffixes.__getitem__)
    a, b = (np.array([r.randrange(len(suffixes)) for _ in range(2000)]) for _ in "ab")
    a, b = a[a != b], b[a != b]
    want = [next(i for i, (x, y) in enumerate(zip(suffixes[p], suffixes[q])) if x != y)
            for p, q in zip(a, b)]
    assert substring_dedup.common_prefix(ranks, a, b).tolist() == want


def test_substring_dedup_of_nothing(llm):
    assert substring_dedup.substring_dedup(frame(llm, [])).collect() == []


def test_runs_cover_every_window_once():
    r = random.Random(5)
    texts = ["".join(r.choice("ab") for _ in range(n)) for n in (0, 3, 50, 400, 7)]
    symbols, ends = anchors.byte_symbols(texts)
    found = anchors.find_runs(symbols, ends, 10, 3)
    windows = sorted((d, s + i) for d, s, n in zip(found["doc"], found["start"], found["n"])
                     for i in range(n))
    assert windows == [(d, i) for d, t in enumerate(texts) for i in range(len(t) - 9)]


def fingerprint(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(items, linked):
    """Smallest item reachable of each, by plain search."""
    out = {}
    for a in sorted(items):
        if a not in out:
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = a
                    todo += [y for y in items if y not in out and linked(x, y)]
    return out


def test_fingerprints_and_components(llm):
    docs = make_docs(6) + [(200, "A Ünï\nB"), (201, "a ünï b"), (202, "\x0b \t")]
    prints = {(d, t): fingerprint(t) for d, t in docs}
    close = grouped(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    want = []
    for d, t in docs:
        group = close[prints[d, t]]
        ids = [e for (e, u), f in prints.items() if close[f] == group and e is not None]
        want.append((d, prints[d, t], min(ids, default=None)))
    got = simhash.simhash_components(frame(llm, docs)).collect()
    same([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got], want)


@pytest.mark.parametrize("bits", [2, 3])
@pytest.mark.parametrize("hot", [1, 64])
def test_links_connect_what_is_close(llm, monkeypatch, bits, hot):
    monkeypatch.setattr(simhash, "HOT_HALF", hot)
    r = random.Random(bits)
    centres = [r.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5)))
              for c in centres for _ in range(25)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = llm.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(fps, bits)
    got = {(u % (1 << 64), v % (1 << 64)) for u, v in edges.collect()}
    assert all((u ^ v).bit_count() <= bits for u, v in got)
    want = grouped(prints, lambda a, b: (a ^ b).bit_count() <= bits)
    neighbours = {p: {q for e in got for q in e if p in e} for p in prints}
    assert grouped(prints, lambda a, b: b in neighbours[a]) == want


def test_components_of_chains_stars_and_nothing(llm):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(60, 50), (50, 60), (7, 7), (200, 200)]
    df = llm.createDataFrame(edges, "u long, v long")
    got = {tuple(r) for r in components.components(df).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)} | {(50, 50), (60, 50)}
    assert components.components(df.limit(0)).collect() == []


def test_keep_one_of_each_group(llm):
    near = " ".join(f"w{i}" for i in range(400))
    docs = [(5, near), (3, near), (9, near + " "), (8, "other words here now"), (8, "other words here now"),
            (None, near), (None, "only null ids"), (None, "only null ids"), (7, None), (6, "")]
    df = frame(llm, docs)
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    same([(r.doc_id, r.text) for r in got.collect()],
         [(3, near), (8, "other words here now"), (None, "only null ids"), (6, "")])


def test_rows_with_one_id_and_one_short_hash(llm):  # noqa: F811
    """Texts under one null id are told apart even if their 32-bit hashes agree."""
    from pyspark.sql import functions as F

    base = "the passage that occurs in both of the documents and a good deal longer than the window "
    texts = llm.range(300_000).select(F.concat(F.lit(base), F.col("id").cast("string"), F.repeat(F.lit("x"), (
        F.col("id") % 50).cast("int"))).alias("text")).withColumn("h", F.hash("text"))
    pair = texts.groupBy("h").agg(F.collect_set("text").alias("t")).filter(F.size("t") > 1).first().t
    docs = [(None, t) for t in pair] + [(5, None)]
    same([tuple(r) for r in suffix_dedup.suffix_dedup(frame(llm, docs), depth=40).collect()],
         [(d, n, m, s, bytearray(k)) for d, n, m, s, k in removed_bytes(docs, 40)])
    kept = simhash.keep_one(frame(llm, docs), width=3, max_bits=2).collect()
    assert {r.text for r in kept} <= {*pair, None}
