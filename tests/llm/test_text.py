"""Decontamination, byte-level BPE and language-model scoring."""

import functools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import frame, llm, make_docs, same  # noqa: F401
from tillroll.llm import bpe, context_tree, decontaminate, html_text, queries


def edit_search(pattern, text):
    """Smallest edit distance of the pattern to a substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_distance():
    r = random.Random(1)
    for _ in range(300):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 70)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 90)))
        assert decontaminate.best_distance(p, t) == edit_search(p, t)


def planted(seed):
    r = random.Random(seed)
    letters = "abcdefgh é"
    items = [(i, "".join(r.choice(letters) for _ in range(r.randint(40, 150)))) for i in range(6)]
    items += [(20, None), (21, ""), (22, "short"), (3, items[3][1]), (None, items[0][1])]
    docs = []
    for i in range(40):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 300)))
        if r.random() < 0.7:
            part = list(r.choice(items[:6])[1])
            for _ in range(r.randint(0, 14)):
                at = r.randrange(len(part))
                part[at:at + 1] = r.choice([[], ["X"], ["y", "z"], [part[at].upper()]])
            text = text[:50] + "".join(part).replace(" ", r.choice([" ", "\n  "])) + text[50:]
        docs.append((i, text))
    return docs + [(90, None), (91, ""), (None, items[1][1]), docs[0]], items


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_find_items(llm, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = planted(2)
    want = []
    for d, t in docs:
        for key, item in items:
            item = decontaminate.normalize(item or "")
            if len(item) >= decontaminate.MIN_CHARS:
                most = decontaminate.budget(item, 0.08)
                found = edit_search(item, decontaminate.normalize(t or ""))
                if found <= most:
                    want.append((d, key, found, most))
    tests = llm.createDataFrame(items, "item_id long, text string")
    same(decontaminate.find_items(frame(llm, docs), tests).collect(), want)
    df = frame(llm, docs)
    clean = decontaminate.decontaminate(df, tests)
    hit = Counter((w[0]) for w in want)
    assert clean.columns == df.columns
    assert sorted([r.doc_id for r in clean.collect()], key=repr) == sorted(
        [d for d, _ in docs if d not in hit], key=repr)


def test_find_items_of_empty_tables(llm):
    docs, items = planted(3)
    none = llm.createDataFrame([], "item_id long, text string")
    some = llm.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_items(frame(llm, docs), none).collect() == []
    assert decontaminate.find_items(frame(llm, []), some).collect() == []


def test_bpe_equals_the_library(llm, monkeypatch):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    letters = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x110000)) if r.random() < 0.02]
    texts = ["", None, " ", "  a", "it's 42!!  x\n\n y\t", "ab" * 700, "<|endoftext|>", "\u00a0x\u3000 y\x85"]
    texts += ["".join(letters[i:i + 100]) for i in range(0, len(letters), 100)]
    texts += ["".join(r.choice("abc '\n1,sté") for _ in range(200)) for _ in range(30)]
    docs = [*enumerate(texts), (None, "null id"), (1, None)]
    coded = bpe.bpe_encode(frame(llm, docs), ranks, public.PATTERN, block_bytes=4000)
    got = coded.select("doc_id", "ids", bpe.decode_ids(F.col("ids"), ranks).alias("raw")).collect()
    same([(x.doc_id, x.ids, bytes(x.raw)) for x in got],
         [(d, own.encode_ordinary(t or ""), (t or "").encode()) for d, t in docs])
    assert bpe.bpe_encode(frame(llm, []), ranks, public.PATTERN).collect() == []


def test_heap_merges_equal_the_fold():
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(5)
    for _ in range(200):
        word = "".join(r.choice("abcdetionsé漢 ") for _ in range(r.randint(1, 300)))
        assert bpe.merge_with_heap(word.encode(), ranks) == own.encode_ordinary(word)


def test_fold_is_compiled_and_equals_the_heap(llm):
    """Made-up vocabularies, whose unions tie and come out of rank order."""
    r = random.Random(6)
    for size in (0, 30, 300):
        pieces = {bytes([b]) for b in range(256)}
        pieces |= {"".join(r.choice("abc") for _ in range(r.randint(2, 6))).encode() for _ in range(size)}
        ranks = dict(zip(r.sample(sorted(pieces), len(pieces)), range(len(pieces))))
        start, union = bpe.pair_table(ranks)
        for a, left in ranks.items():
            for b, right in r.sample(sorted(ranks.items()), 40):
                entry = union[start[left] + right] ^ left << 24
                assert (entry if entry < bpe._NONE else None) == ranks.get(a + b)
        docs = [(i, " ".join("".join(r.choice("abcé") for _ in range(r.randint(1, 45))) for _ in range(30)))
                for i in range(9)] + [(None, None), (9, "")]
        coded = bpe.bpe_encode(frame(llm, docs), ranks, r"\S+|\s", block_bytes=700, keep=("key",))
        want = [(d, sum((bpe.merge_with_heap(w.encode(), ranks) if w.encode() not in ranks else [ranks[w.encode()]]
                         for w in re.findall(r"\S+|\s", t or "")), []), "k") for d, t in docs]
        same(coded.collect(), want)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def test_bpe_refuses_ranks_that_are_no_ids(llm):
    with pytest.raises(ValueError):
        bpe.bpe_encode(frame(llm, []), {bytes([b]): b // 2 for b in range(256)}, ".")


def test_bpe_refuses_a_vocabulary_without_all_bytes(llm):
    with pytest.raises(ValueError):
        bpe.bpe_encode(frame(llm, []), {b"a": 0}, ".")


def brute_scores(docs, depth=3):
    def held(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1

    def tokens(t):
        return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b""]

    def decisions(t):
        raw = bytes(depth) + (t or "").encode().lower() + b"\xff"
        for i in range(depth, len(raw)):
            for j in range(8):
                yield raw[i - depth:i], 1 << j | raw[i] >> 8 - j, raw[i] >> 7 - j & 1

    count, n, longer = Counter(), defaultdict(lambda: [0, 0]), defaultdict(set)
    for d, t in docs:
        if not held(d):
            count.update(tokens(t))
            for context, node, bit in decisions(t):
                for k in range(depth + 1):
                    n[context[depth - k:], node][bit] += 1
                    if k:
                        longer[context[depth + 1 - k:], node].add(context[depth - k:])

    def alone(key):
        a, b = n[key]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.lru_cache(maxsize=None)
    def weighted(key):
        if len(key[0]) == depth:
            return alone(key)
        rest = sum(weighted((c, key[1])) for c in longer[key])
        return math.log(0.5) + max(alone(key), rest) + math.log1p(math.exp(-abs(alone(key) - rest)))

    known = {k: (alone(k), weighted(k)) for k in list(n)}

    def one(context, node, k=0):
        key = context[depth - k:], node
        if key not in known:
            return 0.5
        a, b = n[key]
        here = (b + .5) / (a + b + 1)
        if k == depth:
            return here
        stop = math.exp(math.log(0.5) + known[key][0] - known[key][1])
        return stop * here + (1 - stop) * one(context, node, k + 1)

    total, kinds = sum(count.values()), len(count)
    for d, t in docs:
        score = sum(math.log10(p if bit else 1 - p)
                    for c, node, bit in decisions(t) for p in [one(c, node)])
        words = tokens(t)
        base = sum(math.log10((count[w] + .5) / (total + .5 * (kinds + 1))) for w in words)
        yield d, held(d), len(words), sum(count[w] > 0 for w in words), total, round(base, 6), round(score, 6)


@pytest.mark.parametrize("shares", [(1 << 20, 1 << 19), (20, 10)])
def test_scores(llm, monkeypatch, shares):
    monkeypatch.setattr(context_tree, "GRAM_SHARE", shares[0])
    monkeypatch.setattr(context_tree, "WORD_SHARE", shares[1])
    docs = make_docs(8, size=25) + [(400, "ÄB Ab\x0bab"), (401, None)]
    got = context_tree.score_texts(frame(llm, docs)).collect()
    same([(*r[:5], round(r[5], 6), round(r[6], 6)) for r in got], brute_scores(docs))


def test_scores_at_the_depth_of_the_query(llm):
    docs = make_docs(4, size=18) + [(400, "ÄB Ab\x0bab"), (401, None)]
    got = context_tree.score_texts(frame(llm, docs), depth=queries.LM_DEPTH).collect()
    same([(*r[:5], round(r[5], 6), round(r[6], 6)) for r in got], brute_scores(docs, queries.LM_DEPTH))


def test_counting_merges_sorted_parts(monkeypatch):
    """What a counting task holds is merged every few parts, and leaves it sorted."""
    real = context_tree.by_bytes
    monkeypatch.setattr(context_tree, "by_bytes", lambda batches, column: real(batches, column, 50))
    monkeypatch.setattr(context_tree, "_HELD", 300)
    docs = [(i, t or "") for i, (_, t) in enumerate(make_docs(5, size=120))]
    batch = pa.RecordBatch.from_pydict(
        {"text": [t for _, t in docs], "held_out": [i % 5 == 1 for i, _ in docs]})

    class Rows:
        def mapInArrow(self, fn, schema):
            return list(fn([batch]))

    seen, train, parts = Counter(), Counter(), 0
    for out in context_tree._counted(Rows(), 3):
        keys = out.column("gram").drop_null().to_pylist()
        assert keys == sorted(set(keys))
        parts += bool(keys)
        for gram, n, m in zip(*(out.column(c).to_pylist() for c in ("gram", "train", "seen"))):
            if gram is not None:
                train[gram] += n
                seen[gram] += m
    want, learnt = Counter(), Counter()
    for i, t in docs:
        grams, _ = context_tree.byte_grams([t], 3)
        want.update(grams.tolist())
        learnt.update([] if i % 5 == 1 else grams.tolist())
    assert parts > 1 and seen == want and +train == learnt


def test_only_what_passes_the_bound_is_listed_and_joined(llm, monkeypatch):
    """As many grams and words are broadcast as the bound allows, the most frequent
    first, so a document lists only what is past it."""
    docs = [(i, t or "") for i, (_, t) in enumerate(make_docs(9, size=60))]
    grams = Counter(context_tree.byte_grams([t for _, t in docs], 3)[0].tolist())
    words = Counter(w for _, t in docs for w in [*t.encode().lower().split(), b""])
    listed = []
    real = context_tree.materialize

    def keep(df, name):
        out = real(df, name)
        if name == "scores":
            listed.extend(({e.key for r in out[0].collect() for e in r[c]} for c in ("grams", "words")))
        return out

    monkeypatch.setattr(context_tree, "materialize", keep)
    for bound in (len(grams), len(grams) // 2):
        monkeypatch.setattr(context_tree, "GRAM_SHARE", bound)
        monkeypatch.setattr(context_tree, "WORD_SHARE", bound)
        got = context_tree.score_texts(frame(llm, docs)).collect()
        same([(*r[:5], round(r[5], 6), round(r[6], 6)) for r in got], brute_scores(docs))
    least = sorted(grams.values())[-(len(grams) // 2)]
    assert listed[0] == listed[1] == set() and len(words) < len(grams) // 2
    assert {g for g, n in grams.items() if n < least} <= {g for g in listed[2]}
    assert {g for g in listed[2]} <= {g for g, n in grams.items() if n <= least} and listed[3] == set()


def test_counts_travel_packed_by_bucket():
    """A counting task passes on a row per bucket, a few bytes per gram in it."""
    docs = [t or "" for _, t in make_docs(5, size=400)]
    batch = pa.RecordBatch.from_pydict({"text": docs, "held_out": [i % 5 == 1 for i in range(len(docs))]})

    class Rows:
        def mapInArrow(self, fn, schema):
            return list(fn([batch]))

    out = context_tree._counted(Rows(), 6, context_tree._dealt(6, 3), context_tree._PACKED)
    rows = [r for b in out for r in b.to_pylist()]
    assert len(rows) <= 2 * context_tree.BUCKETS
    seen, said = Counter(), Counter()
    for r in rows:
        n = context_tree._unpack(r["seen"], r["n"]).tolist()
        if r["grams"] is not None:
            found = context_tree._unpack_sorted(r["grams"], r["n"])
            assert set((found >> 32) % context_tree.BUCKETS) == {r["bucket"]}
            seen.update(dict(zip(found.tolist(), n)))
        else:
            said.update(dict(zip(r["words"].split(b"\n"), n)))
    assert seen == Counter(context_tree.byte_grams(docs, 6)[0].tolist())
    assert said == Counter(w for t in docs for w in [*t.encode().lower().split(), b""])


def test_probabilities_of_all_texts_add_up(llm):
    """The end is coded, so longer texts are less likely: the sum over all texts of
    up to two bytes of a two-letter world stays below one, and the empty text's
    probability is what it was seen to be."""
    docs = [(0, "a"), (2, "b"), (3, ""), (5, "ab"), (7, None)]
    got = {(r.doc_id): r.score for r in context_tree.score_texts(frame(llm, docs), depth=2).collect()}
    assert got[3] == got[7] < 0
    assert sum(10 ** got[i] for i in (0, 2, 3, 5)) < 1


def test_scores_of_nothing(llm):
    assert context_tree.score_texts(frame(llm, [])).collect() == []


@pytest.mark.parametrize("tables, rows", [(0, 1), (1, 50), (2, 1 << 18)])
def test_scores_with_deep_levels_in_groups(llm, monkeypatch, tables, rows):
    """Levels worked out in the tasks give what levels in tables give."""
    monkeypatch.setattr(context_tree, "TABLE_DEPTH", tables)
    monkeypatch.setattr(context_tree, "_ROWS", rows)
    docs = make_docs(8, size=25) + [(400, "ÄB Ab\x0bab"), (401, None)]
    got = context_tree.score_texts(frame(llm, docs)).collect()
    same([(*r[:5], round(r[5], 6), round(r[6], 6)) for r in got], brute_scores(docs))


def test_query_sees_whole_words(llm, tmp_path):
    """The last byte of each word follows from the first, six bytes before."""
    r = random.Random(6)
    docs = [(i, "".join(r.choice(["axxxxxa", "bxxxxxb"]) for _ in range(100))) for i in range(40)]
    frame(llm, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_lm_scoring(llm, str(tmp_path)).collect()
    held = [x.score for x in got if x.held_out]
    # A hundred free choices of one bit; blind to the first byte it is 200.
    assert held and all(-140 < x / math.log10(2) < -95 for x in held)


def test_short_items_are_searched_on_word_boundaries(llm):
    docs = [(1, "What is 2 + 2?  It is four"), (2, "thefourth"), (3, "four"), (4, "fou r, faur"),
            (5, "我住在东京吗"), (6, "f(x)=four."), (7, "xwhat is 2 + 2?"), (8, None)]
    items = [(1, "WHAT is\n2 + 2?"), (2, "four"), (3, "东京"), (4, ""), (5, None), (6, " "), (2, "Four")]
    tests = llm.createDataFrame(items, "item_id long, text string")
    want = [(1, 1, 0, 0)] + [(d, 2, 0, 0) for d in (1, 1, 3, 3, 6, 6)] + [(5, 3, 0, 0)]
    same(decontaminate.find_items(frame(llm, docs), tests).collect(), want)
    clean = decontaminate.decontaminate(frame(llm, docs), tests).collect()
    assert sorted(r.doc_id for r in clean) == [2, 4, 7, 8]


def test_item_blocks_are_bounded(llm, monkeypatch):
    """Repeated items are sent once, and no block holds more than its bytes."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    sent = []
    real = type(llm.sparkContext).broadcast
    monkeypatch.setattr(type(llm.sparkContext), "broadcast",
                        lambda sc, value: sent.append(value[0]) or real(sc, value))
    items = [(i, "the same item again and again") for i in range(30)] + [
        (100 + i, f"item number {i} of the others") for i in range(20)] + [(200, "long " * 50)]
    docs = frame(llm, [(1, "x The same  item again and again y"), (2, "none")])
    found = decontaminate.find_items(docs, llm.createDataFrame(items, "item_id long, text string"))
    same(found.collect(), [(1, i, 0, 0) for i in range(30)])
    assert sum(map(len, sent)) == 22
    assert all(len(b) == 1 or sum(len(t.encode()) for _, t in b) <= 100 for b in sent)


PROSE = "<p>" + "A paragraph of the article, with text enough to count. " * 6 + "</p>"


@pytest.mark.parametrize("page,first", [
    ('<svg class="i"/><article><h1>Title</h1>{}</article>', "Title A"),
    ("<form><nav><a>Home</a> Menu</nav><article><h1>Title</h1>{}</article><footer>foot</footer></form>", "Title A"),
    ('<form action="/"><div id="c"><h1>Title</h1>{}</div><footer>foot</footer></form>', "Title A"),
    ("<header>Site</header><article><header><h1>Title</h1></header>{}</article>", "Title A"),
    ('<article><div class="post-header"><h1>Title</h1></div>{}<div class="share-buttons">Share</div></article>', "Title A"),
    ('<article><header><a>One</a> <a>Two</a></header>{}<div class="comments"><p>Nice!</p></div></article>', "A"),
    ('<article><h1>Title</h1><section class="market-share">{}</section><aside>Also</aside></article>', "Title A"),
    ('<article><img alt="a > b" src=x><h1>Title</h1>{}</article><div class="sidebar-left">x</div>', "Title A"),
])
def test_html_keeps_the_whole_article(page, first):
    text = html_text.extract(f"<html><body>{page.format(PROSE)}</body></html>", None)
    assert text.startswith(first + " paragraph") and text.endswith("to count.") and text.count("count") == 6


@pytest.mark.parametrize("part", ["<a ", '<a "', '<a ">', "<a '\">", "<", "<!--", "<svg ", "<script>", "<form><p>x", "<div>t", "</div>"])
def test_html_broken_markup_takes_linear_time(part):
    import time

    took = []
    for size in (1 << 16, 1 << 20):
        start = time.perf_counter()
        html_text.extract(part * (size // len(part)) + ">", None)
        took.append(time.perf_counter() - start)
    assert took[1] < 60 * took[0] + 1


def test_html_large_host_table_is_joined_by_salts(llm, monkeypatch):  # noqa: F811
    rows = [(i, f"http://h{i % 3}.org/x", f"<body><div class='c{i % 2}'>{PROSE} {i}</div></body>") for i in range(12)]
    rows += [(None, None, None), (5, "", ""), (5, "", "")]
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    whole = html_text.extract_text(df).collect()
    monkeypatch.setattr(html_text, "MAX_BROADCAST_BYTES", -1)
    same(html_text.extract_text(df).collect(), whole)
    assert len(whole) == len(rows) and sum(bool(r.text) for r in whole) == 12


def test_html_is_not_shuffled_for_few_hosts(llm):  # noqa: F811
    df = llm.createDataFrame([(1, "http://a.b/", f"<body>{PROSE}</body>")], "page_id long, url string, html string")
    plan = html_text.extract_text(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
