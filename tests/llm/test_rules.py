"""Quality rules, URL filter, token counts and HTML extraction."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_helpers import frame, llm, make_docs, same  # noqa: F401
from tillroll.llm import html_text, quality, token_counts, url_filter


def plain_signals(text, depth):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)
    three = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    in_three, covered, longest = [False] * n, [False] * n, 0
    for i in range(n - 2):
        if three[tuple(w[i:i + 3])] > 1:
            in_three[i:i + 3] = [True] * 3
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= depth:
            covered[i:i + best] = [True] * best
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), sum(in_three), sum(covered), longest)


def test_quality_signals(llm):
    limits = quality.Limits(min_repeat=4)
    docs = make_docs(7, sep="\n") + [
        (300, "#a*\n#a*\n \n$ %&|<>\u00a0x"), (301, " ".join(f"w{i}" for i in range(60)))]
    got = quality.quality_signals(frame(llm, docs), limits).collect()
    want = []
    for d, t in docs:
        s = plain_signals(t, 4)
        n = s[0]
        failed = n < 50 or 100 * s[4] > 50 * n
        bad = 100 * s[5] > 30 * n or (s[6] >= 4 and 100 * s[6] > 20 * n)
        want.append((d, *s, failed, not failed and not bad))
    same(got, want)


def test_quality_filter_keeps_columns(llm):
    docs = [(1, " ".join(f"w{i}" for i in range(60))), (2, "a b"), (3, None),
            (None, " ".join(f"v{i}" for i in range(50))),
            (4, " ".join(f"u{i % 45}" for i in range(60)))]
    df = frame(llm, docs)
    got = quality.quality_filter(df)
    assert got.columns == df.columns and df.columns == frame(llm, docs).columns
    assert sorted(r.text.split()[0] for r in got.collect()) == ["v0", "w0"]
    assert quality.quality_filter(frame(llm, [])).collect() == []


def test_repeat_lengths_of_one_batch():
    r = random.Random(1)
    ids = np.array([r.randint(0, 2) for _ in range(200)] + [3])
    _, ids = np.unique(ids, return_inverse=True)
    got = quality.repeat_lengths(ids)
    for i in range(200):
        want = 0
        for j in range(200):
            k = 0
            while i != j and max(i, j) + k < 201 and ids[i + k] == ids[j + k]:
                k += 1
            want = max(want, k)
        assert got[i] == want


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"), ("block", "a.example.com/"), ("allow", "a.example.com/de/x")]


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://A.example.NET/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/de/1?x#y", "example.net", "/de/1", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://myexample.com/de/", "myexample.com", "/de/", None, "allow"),
    ("x://b.example.com/de/#a", "b.example.com", "/de/", "example.com/de/", "block"),
    ("x://a.example.com/de/xyz", "a.example.com", "/de/xyz", "a.example.com/de/x", "allow"),
    ("x://a.example.com/de/", "a.example.com", "/de/", "a.example.com/", "block"),
    ("x://w.org/fr/a/b", "w.org", "/fr/a/b", "org/fr/", "allow"),
    ("no host", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://ÄB.net/", "Äb.net", "/", "net/", "block"),
])
def test_url_filter(llm, url, host, path, rule, verdict):
    pages = llm.createDataFrame([(1, url, "h", None)], "page_id long, url string, host string, rule string")
    assert url_filter.url_filter(pages, RULES).collect() == [(1, host, path, rule, verdict)]


def test_url_filter_equals_a_scan_of_the_rules():
    r = random.Random(2)
    labels, segments = ["a", "b", "net"], ["", "x", "xy", "y"]
    rules = sorted({(r.choice(["allow", "block"]),
                     ".".join(r.choices(labels, k=r.randint(1, 3))) + "/" + "/".join(r.choices(segments, k=r.randint(1, 3))))
                    for _ in range(40)})
    trie = url_filter.compile_rules(rules)
    for _ in range(500):
        host = ".".join(r.choices(labels, k=r.randint(1, 4)))
        path = "/" + "/".join(r.choices(segments, k=r.randint(0, 3)))
        fits = []
        for verdict, rule in rules:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((h.count("."), len(p), verdict == "block", verdict, rule))
        want = max(fits)[3:] if fits else None
        assert url_filter.lookup(trie, host, path) == want


def test_url_filter_refuses_an_unbounded_list(llm, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_RULE_BYTES", 10)
    with pytest.raises(ValueError):
        url_filter.url_filter(llm.createDataFrame([], "page_id long, url string"), RULES)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json",
                                  "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"])
def test_token_counts(llm, monkeypatch, name):
    public = pytest.importorskip("public_tokenizers")
    path = public.path(name)
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 50)
    r = random.Random(3)
    texts = ["", None, " ", "  a  b ", "<s> x </s>", "word " * 500, "x" * 400, "a\u2581 b\u3000c d" * 30]
    texts += ["".join(r.choice("ab 'é\n\t漢🙂,. ") for _ in range(r.randint(0, 400))) for _ in range(60)]
    docs = list(enumerate(texts))
    got = token_counts.token_counts(frame(llm, docs), path, pattern=public.PATTERN).collect()
    encode, _ = token_counts._counter(path, public.PATTERN)
    same(got, [(d, len((t or "").encode()), encode([t or ""])[0]) for d, t in docs])


def test_pieces_join_to_the_text():
    text = "aa bb  cc\ndd ee " * 20
    assert " ".join(token_counts.pieces(text, 1, 10)) == text
    assert "".join(token_counts.pieces(text, 0, 10)) == text
    assert token_counts.pieces(text, None, 10) == [text]
    assert len(token_counts.pieces("x" * 100, 1, 10)) == 1


ARTICLE = "<h1>Title &amp; more</h1><p>First&nbsp;para with <b>bold</b>text.<br>line\n\n two<p>Second <a href=y>link</a> a < b.<ul><li>one<li>two</ul>"
WANT = "Title & more First para with boldtext. line two Second link a < b. one two"


def page(article, rest=""):
    return (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">'
        '<header><h1>Site</h1></header><div id="main-nav"><a href=x>Home</a></div>'
        f'<div class="cookie-notice">We use cookies</div><main><div class="post-7 body">{article}'
        '<script>var t="</p>";</script><div class="ad">Buy</div></div>'
        f'<section class="comments"><p>nice post</p></section></main>{rest}<aside>side</aside>'
        '<form>sub <input></form><!-- c <p>no</p> --><footer>&copy; x</footer></body></html>')


def test_extract_one_page():
    assert html_text.extract(page(ARTICLE), None) == WANT
    assert html_text.extract(page(ARTICLE), ">html>body.has-sidebar>main>div.body.post-#") == WANT
    assert html_text.extract("", None) == "" and html_text.extract("plain  text", None) == "plain text"
    for broken in ("<", "<a", "<p a='", "<!-- x", "</p></div>x", "<script>x", "<div" * 50):
        html_text.extract(broken, None)


def test_host_consensus(llm):
    """A short article beside a long unknown box is read at its host's path."""
    box = "<section><p>" + "long unknown box " * 40 + "</p></section>"
    long = "<p>" + "many words of text " * 60 + "</p>"
    rows = [(i, "http://h.example/1", page(long)) for i in range(5)]
    rows += [(10, "http://h.example/2", page("<p>short one</p>", box)), (11, "http://o.example/", None),
             (None, None, page(ARTICLE)), (12, "http://o.example/x", ""), (12, "http://o.example/x", "")]
    pages = llm.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, path string")
    got = html_text.extract_text(pages).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(i, "http://h.example/1", ("many words of text " * 60).strip()) for i in range(5)]
        + [(10, "http://h.example/2", "short one"), (11, "http://o.example/", ""), (None, None, WANT),
           (12, "http://o.example/x", ""), (12, "http://o.example/x", "")], key=repr)
    assert html_text.extract_text(pages.limit(0)).collect() == []


INNER = {
    "body": "<div class=body><p>{}</p></div>",
    "table": "<table><tr><td>{}</td></tr></table>",
    "list": "<ul><li>{}</li></ul>",
    "quote": "<blockquote>{}</blockquote>",
    "section": "<div><section><p>{}</p></section></div>",
}


@pytest.mark.parametrize("outer", ["article", "main", "div"])
@pytest.mark.parametrize("inner", INNER)
def test_title_and_lead_around_a_long_container(outer, inner):
    def text(n):
        long = INNER[inner].format("long text " * n)
        return (f"<html><body><nav>menu</nav><{outer}><h1>Title</h1><p>lead</p>{long}<p>end</p>"
                f'<div class="share">Share</div></{outer}><footer>foot</footer></body></html>')

    want = "Title lead " + "long text " * 50 + "end"
    assert html_text.extract(text(50), None) == want
    best, _ = html_text.best_container(html_text.parse(text(50)))
    assert best.path == f">html>body>{outer}"
    # Two boundaries, one in the other: the text between them is kept as well.
    both = "<main><h1>Title</h1><article>" + INNER[inner].format("long text " * 50) + "</article></main>"
    assert html_text.extract(both, None) == "Title " + ("long text " * 50).strip()


def test_host_path_is_only_part_of_a_page(llm):
    """A host's narrow path does not cut the pages that hold more around it."""
    def html(rest, n):
        return f"<body><nav>menu</nav><article>{rest}<div class=body><p>{'text ' * n}</p></div></article></body>"

    rows = [(i, "http://h.example/1", html("", 200)) for i in range(5)]
    rows += [(9, "http://h.example/2", html("<h1>Title</h1><table><tr><td>" + "cell " * 90 + "</td></tr></table>", 5))]
    got = html_text.extract_text(llm.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {
        **{i: ("text " * 200).strip() for i in range(5)}, 9: "Title " + "cell " * 90 + ("text " * 5).strip()}
