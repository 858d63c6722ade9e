"""Source divergence against a plain computation with Python's integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_helpers import llm, same  # noqa: F401
from tillroll.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, min_docs, top):
    docs = [(t or "", g or "", s or "") for t, g, s in docs]
    n, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for t, g, s in docs:
        terms = [x.translate(SMALL) for x in TERM.findall(t)]
        groups[g].add(s)
        n[g, s].update(terms)
        seen[g].update(set(terms))
    out = []
    for g, sources in groups.items():
        kept = [x for x, d in seen[g].items() if d >= min_docs]

        def parts(counts):
            total = sum(counts[x] for x in kept)
            return {x: 1 + 1_000_000_000 * (counts[x] + 2) // (total + 2 * len(kept)) for x in kept}

        p = {s: parts(n[g, s]) for s in sources}
        q = parts(sum((n[g, s] for s in sources), Counter()))
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(far(p[s][x], p[o][x]) for x in kept)) for o in sources if o != s]
            terms = [(x, far(p[s][x], q[x])) for x in kept if n[g, s][x] and p[s][x] > q[x]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(g, s, part, i, v, r + 1) for r, (i, v) in enumerate(found[:limit])]
    return out


def make(seed, size=120, sources=6):
    r = random.Random(seed)
    words = ["a", "Äb", "äb", "eightchr", "Ninechars", "sixteen_", "exactlysixteenab", "seventeenlettersx",
             "ж" * 9, "z" * 40, "日本語" * 30, "x1y", "don't", "É", "zz"]
    rows = [(None, None, None), ("", "en", "s0"), (None, "en", "quiet"), ("123 !?", "de", None)]
    for i in range(size):
        text = " ".join(r.choice(words) + r.choice(["", "-", "\x00", "@"]) for _ in range(r.randint(0, 12)))
        # A third of the rows come from one source.
        rows.append((text, r.choice(["en", "en", "de", None]),
                     "s0" if r.random() < 0.33 else f"s{r.randint(1, sources)}"))
    return rows + rows[5:8]


def frame(spark, rows):
    return spark.createDataFrame(
        [(t, "x", g, s, 1, 2) for t, g, s in rows],
        "text string, term string, lang string, source string, p long, value long").repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_computation(llm, seed):  # noqa: F811
    rows = make(seed)
    same(divergence.source_divergence(frame(llm, rows), min_docs=3, top=4).collect(), plain(rows, 3, 4))


def test_blocks_and_tiles(llm, monkeypatch):  # noqa: F811
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(divergence, "TILE_SOURCES", 4)
    rows = make(5, sources=14)
    same(divergence.source_divergence(frame(llm, rows), min_docs=2, top=3).collect(), plain(rows, 2, 3))


def test_no_kept_terms_and_no_rows(llm):  # noqa: F811
    rows = [("a b", "en", "s1"), ("c", "en", "s2")]
    same(divergence.source_divergence(frame(llm, rows)).collect(),
         [("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)])
    assert divergence.source_divergence(frame(llm, rows).limit(0)).collect() == []


def test_long_text_is_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE", 50)
    raw = ("Word otherword " * 30 + "é" * 200 + " end").encode()
    terms, n = divergence._count_long(raw)
    want = Counter(x.lower() for x in TERM.findall(raw.decode()))
    assert dict(zip(terms, n)) == {k.encode(): v for k, v in want.items()}


def test_large_counts_do_not_overflow(llm):  # noqa: F811
    big = 8_000_000_000_000_000_000
    df = llm.createDataFrame([(big, big, 3)], "n long, total long, v long")
    got = df.select(divergence._parts("n", "total", "v").alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (big + 2) // (big + 6)


def test_radix_order_is_stable():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 5, 500).astype(np.uint64) << np.uint64(40), r.integers(0, 3, 500).astype(np.uint32)
    assert (divergence._radix_order([a, b]) == np.lexsort([a, b])).all()
