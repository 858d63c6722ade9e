"""Main text of web pages by consensus host paths.

Pages of one host share a layout.  Each page is parsed once for the container
that holds its text: the deepest with most of it, widened to the ancestor, up to
article, main or body, that holds all text around it.  That container's path of
tags and generalised classes is a vote for the host, weighted by the text in it.
Spark adds up the votes; every page is then read again under its host's winning
path, widened likewise where this page has text around it.  A page without an
element on that path falls back on its own best container.

Votes are summed per task before the shuffle, so a hot host costs no more than
another.  The winners, one short row per host, are written to the shared folder;
if they are few bytes they are broadcast and no page is shuffled.  Else pages are
dealt by host and a salt, and each winner is repeated for every salt.

Chrome is what its tag, role or name says, with three exceptions: a container
that wraps the page (a form around everything) is none; a header within an
article or main is the article's own, unless most of its text is links; and
within an article a name with other words than plain ones is a name of content.

Defined results: null or empty html gives an empty text.  A URL without a host
votes among the other such pages.  Repeated rows are extracted row by row;
other input columns are left out.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import by_bytes, materialize
from tillroll.llm.url_filter import host_path
from tillroll.operators.joins import MAX_BROADCAST_BYTES, planned_bytes

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRS = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(
    r"""\b(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Characters within which a tag's quotes must close, else it ends at the next ``>``.
_WINDOW = 1 << 14

#: Nested containers beyond which a path grows no longer.
_DEEP = 256

#: Tasks over which the pages of one host are spread where winners are not broadcast.
_SALTS = 32

#: Elements whose content is not markup, or never article text.
_RAW = frozenset("script style noscript template textarea select svg iframe title object".split())

#: Elements kept on the stack of open containers.
_CONTAINERS = frozenset(
    "html body div section article main aside nav header footer form ul ol dl table tbody thead "
    "tr td th figure blockquote details dialog fieldset center menu address button".split())

#: Elements that end a block without being containers.
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr br figcaption caption summary legend".split())

#: Containers that are never article text.
_CHROME_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
_CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog".split())
#: Words in class or id names that mark such containers.
_CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead "
    "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup "
    "login comment comments disqus reply replies respond discussion share sharing social related "
    "recommended recommendations pagination pager toolbar widget widgets skip".split())

#: A layout's class that only mentions one ("has-sidebar") is none itself.
_MENTIONS = frozenset("with without has no".split())
#: Elements that names alone never make chrome.
_CORE_TAGS = frozenset("html body main article".split())

#: Words that say nothing about what a container holds.
_PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card cell col column container content entry "
    "form google grid group heading icon icons inline inner item items label left link links list "
    "main outer page panel post region right row section site slot space text title top unit user "
    "users wrap wrapper article story".split())
#: Names of an article's own header.
_HEADER_WORDS = frozenset("header masthead banner".split())
#: Containers that are chrome however much text they hold.
_NEVER_WRAP = frozenset("nav header footer aside menu dialog".split())

_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_NAME_PART = re.compile(r"[a-z]+")


class _Element:
    """A container.  ``mark``: it is chrome itself; ``soft``: only if most of its text
    is links; ``prose``: it holds paragraphs of its own."""

    __slots__ = ("tag", "path", "parent", "depth", "mark", "soft", "prose", "chrome")

    def __init__(self, tag, path, parent, mark, soft=False):
        self.tag, self.path, self.parent, self.mark, self.soft = tag, path, parent, mark, soft
        self.depth = parent.depth + 1 if parent else 0
        self.prose, self.chrome = tag in ("article", "main"), None


def _named_chrome(name: str, inside: bool) -> tuple[bool, bool]:
    """(whether one class or id name stands for chrome, whether only for a header).

    camelCase and - _ part words.  Outside an article one such word suffices;
    inside, all others must be plain, so that "market-share" is text.
    """
    words = _NAME_PART.findall(_HUMP.sub(" ", name).lower())
    found = _CHROME_WORDS.intersection(words)
    if not found or not _MENTIONS.isdisjoint(words):
        return False, False
    if inside and any(w not in _CHROME_WORDS and w not in _PLAIN_WORDS for w in words):
        return False, False
    return True, found <= _HEADER_WORDS


def _step(tag: str, attrs: str, inside: bool) -> tuple[str, bool, bool]:
    """(generalised path step, whether it is chrome, whether it is so as a header
    within an article) of a start tag."""
    hard, header, classes = tag in _CHROME_TAGS and tag != "header", tag == "header", ""
    for m in _ATTR.finditer(attrs) if attrs else ():
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "role":
            hard = hard or value.lower() in _CHROME_ROLES
        elif kind == "style":
            hard = hard or "display:none" in value.lower().replace(" ", "")
        elif kind == "aria-hidden":
            hard = hard or value.lower() == "true"
        else:
            names = value.split()
            for chrome, only in (_named_chrome(n, inside) for n in names if tag not in _CORE_TAGS):
                header, hard = header or (chrome and only), hard or (chrome and not only)
            if kind == "class":
                classes = "".join("." + _DIGITS.sub("#", c.lower()) for c in sorted(names))
    return tag + classes, hard or header, inside and not hard


def _next_tag(html: str, at: int) -> tuple[int, int, bool, str, str] | None:
    """(start, stop, is an end tag, name, attributes) of the first tag from ``at``.

    Comments and declarations have no name.  None if no tag ends any more.
    """
    while (i := html.find("<", at)) >= 0:
        if html.startswith(("<!", "<?"), i):
            mark = "-->" if html.startswith("<!--", i) else ">"
            stop = html.find(mark, i + 2 * len(mark) - 2)
            return i, len(html) if stop < 0 else stop + len(mark), False, "", ""
        if m := _NAME.match(html, i):
            attrs = _ATTRS.match(html, m.end(), i + _WINDOW)
            stop = attrs.end() if attrs else html.find(">", m.end()) + 1
            return (i, stop, bool(m[1]), m[2].lower(), html[m.end():stop - 1]) if stop else None
        at = i + 1
    return None


def parse(html: str) -> list[tuple[_Element, str, bool]]:
    """(container, text, inside a link) of every piece of text outside chrome.

    A block's end is a piece of its own with the text ``"\\n"``.
    """
    root = _Element("", "", None, False)
    here, pieces, at, link, inside = root, [], 0, False, 0
    open_tags: dict[str, int] = {}
    while True:
        found = _next_tag(html, at)
        raw = html[at:found[0]] if found else html[at:]
        if raw:
            pieces.append((here, unescape(raw) if "&" in raw else raw, link))
        if not found:
            break
        _, at, end, tag, attrs = found
        if not tag:
            continue
        if tag in _RAW and not end:
            if not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.I).search(html, at)
                at = close.end() if close else len(html)
        elif tag == "a":
            link = not end
        elif tag in _CONTAINERS:
            pieces.append((here, "\n", False))
            link = False
            if not end:
                if not attrs.endswith("/"):
                    step, mark, soft = _step(tag, attrs, inside > 0)
                    here = _Element(tag, f"{here.path}>{step}" if here.depth < _DEEP else here.path, here, mark, soft)
                    inside += tag in ("article", "main")
                    open_tags[tag] = open_tags.get(tag, 0) + 1
            elif open_tags.get(tag):
                stop = False
                while not stop:
                    stop = here.tag == tag
                    inside -= here.tag in ("article", "main")
                    open_tags[here.tag] -= 1
                    here = here.parent
            pieces.append((here, "\n", False))
        elif tag in _BLOCKS:
            pieces.append((here, "\n", False))
            link = False
            here.prose = here.prose or tag == "p"
    _judge(pieces, root)
    return [p for p in pieces if not p[0].chrome]


def _judge(pieces, root: _Element) -> None:
    """Decide ``chrome`` of every container that holds a piece.

    A mark is void on a container that wraps the page: one with paragraphs in it
    and four fifths of all text that is in no link.  A header's mark within an
    article holds only if most of the text is links.
    """
    plain, linked, prose = text_sizes(pieces), text_sizes(pieces, links=True), set()
    for element, _, _ in pieces:
        above = element if element.prose else None
        while above is not None and above not in prose:
            prose.add(above)
            above = above.parent
    total = plain.get(root, 0)

    def marked(e):
        if not e.mark:
            return False
        if e.soft:
            return linked.get(e, 0) > plain.get(e, 0)
        return e.tag in _NEVER_WRAP or e not in prose or not 5 * plain.get(e, 0) >= 4 * total > 0

    root.chrome = False
    for element, _, _ in pieces:
        chain = []
        while element.chrome is None:
            chain.append(element)
            element = element.parent
        for e in reversed(chain):
            e.chrome = e.parent.chrome or marked(e)


def text_sizes(pieces, links: bool = False) -> dict[_Element, int]:
    """Characters of text that is in no link (or in links), of every container that
    holds any."""
    held: dict[_Element, int] = {}
    for element, text, link in pieces:
        if link == links and (size := len(text.strip())):
            held[element] = held.get(element, 0) + size
    # From the deepest up, so that each container is added to its parent once.
    deepest = sorted(held, key=lambda e: e.depth, reverse=True)
    levels: dict[int, list[_Element]] = {}
    for e in deepest:
        levels.setdefault(e.depth, []).append(e)
    for depth in range(max(levels, default=0), 0, -1):
        for e in levels.get(depth, ()):
            if e.parent not in held:
                held[e.parent] = 0
                levels.setdefault(depth - 1, []).append(e.parent)
            held[e.parent] += held[e]
    return held


def widened(element: _Element, held: dict[_Element, int]) -> _Element:
    """The lowest ancestor, or the element, with all text up to article, main or body.

    That is the outermost article or main around it; body, or what stands for it
    in a page without one, where there is neither.  Chrome is not in ``held``.
    """
    chain = [element]
    while chain[-1].parent is not None:
        chain.append(chain[-1].parent)
    bounds = [i for i, e in enumerate(chain) if e.tag in ("article", "main")] or [
        i for i, e in enumerate(chain) if e.tag == "body"] or [len(chain) - 1]
    most = held.get(chain[bounds[-1]], 0)
    return next(e for e in chain if held.get(e, 0) == most)


def best_container(pieces) -> tuple[_Element | None, int]:
    """The deepest container with four fifths of the text that is in no link, widened."""
    held = text_sizes(pieces)
    if not held:
        return None, 0
    total = max(held.values())
    # Four fifths can be held by one chain of ancestors only.
    rich = [e for e, n in held.items() if 5 * n >= 4 * total]
    best = widened(max(rich, key=lambda e: e.depth), held)
    return best, held[best]


def text_under(pieces, inside) -> str:
    """The text of the containers for which ``inside`` holds, white space as one space."""
    known: dict[_Element | None, bool] = {None: False}

    def within(element):
        chain = []
        while element not in known:
            chain.append(element)
            element = element.parent
        for e in reversed(chain):
            known[e] = known[e.parent] or inside(e)
        return known[chain[0] if chain else element]

    return " ".join("".join(text for element, text, _ in pieces if within(element)).split())


def extract(html: str, path: str | None) -> str:
    pieces = parse(html)
    on_path = {e for e, _, _ in pieces if e.path == path and not e.chrome}
    if on_path:
        held = text_sizes(pieces)
        wide = {widened(e, held) for e in on_path}
        return text_under(pieces, lambda e: e in wide)
    best, _ = best_container(pieces)
    return text_under(pieces, lambda e: e is best) if best else ""


def extract_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: page_id, url, text (empty if none)."""
    rows = host_path(pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"),
        F.coalesce(pages[html_col], F.lit("")).alias("html"))).drop("path")
    kind = rows.schema["page_id"].dataType.simpleString()

    def vote(batches):
        for batch in by_bytes(batches, "html"):
            found = [best_container(parse(h)) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"),
                 pa.array([e.path if e else None for e, _ in found], pa.string()),
                 pa.array([n for _, n in found], pa.int64())], names=["host", "path", "weight"])

    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, weight long")
    winners, _ = materialize(
        votes.filter("path IS NOT NULL")
        .groupBy("host", "path").agg(F.sum("weight").alias("weight"))
        .groupBy("host").agg(F.max(F.struct("weight", "path")).alias("best"))
        .select(F.col("host").alias("h"), F.col("best.path").alias("path")), "host-paths")

    def read(batches):
        for batch in by_bytes(batches, "html"):
            found = [extract(h, p) for h, p in
                     zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())],
                names=["page_id", "url", "text"])

    if planned_bytes(winners) <= MAX_BROADCAST_BYTES:
        routed = rows.join(F.broadcast(winners), F.col("host") == F.col("h"), "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int")
        each = winners.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        routed = rows.withColumn("salt", salt).join(
            each, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("s")), "left")
    return routed.select("page_id", "url", "html", "path").mapInArrow(
        read, f"page_id {kind}, url string, text string")
