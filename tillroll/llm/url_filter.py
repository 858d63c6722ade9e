"""URL allow and block lists: a trie over reversed host labels and path segments.

The driver compiles the rules into one trie (host labels from the right, then
path segments from the left).  The list is an input of the caller, not of the
tables; its size is checked before it is broadcast.  Each URL then walks the
trie once, whatever the number of rules, and the deepest rule that fits wins.

Defined results: a null URL or one without ``://`` has an empty host and path,
which no rule fits; the verdict without a rule is ``default``.  Repeated and
null ids pass through row by row.  The input's other columns are left out.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ascii_lower

#: Bytes of rule text that may be broadcast; longer lists are refused.
MAX_RULE_BYTES = 64 << 20

ALLOW, BLOCK = "allow", "block"


def compile_rules(rules: list[tuple[str, str]]) -> dict:
    """Trie of ``(verdict, rule)`` pairs, a rule being ``host/path``.

    A node is ``{"next": {label: node}, "path": node or None}``; a path node is
    ``{"next": {segment: node}, "ends": [(partial segment, verdict, rule)]}``.
    A rule's path fits every URL path that starts with it, so its last, open
    segment is kept apart: ``/de/`` ends in an empty one, ``/de`` in ``de``.
    Of equal rules, the block entry wins.
    """
    root: dict = {"next": {}, "path": None}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".") if host else []):
            node = node["next"].setdefault(label, {"next": {}, "path": None})
        if node["path"] is None:
            node["path"] = {"next": {}, "ends": []}
        node = node["path"]
        *whole, last = (slash + path).split("/")
        for segment in whole:
            node = node["next"].setdefault(segment, {"next": {}, "ends": []})
        node["ends"].append((last, verdict, rule))
        node["ends"].sort(key=lambda e: (-len(e[0]), e[1] != BLOCK))
    return root


def _longest_path(node: dict, segments: list[str]):
    best = None
    for i, segment in enumerate(segments):
        for partial, verdict, rule in node["ends"]:
            if segment.startswith(partial):
                best = (verdict, rule)
                break
        node = node["next"].get(segment) if i + 1 < len(segments) else None
        if node is None:
            break
    return best


def lookup(trie: dict, host: str, path: str):
    """(verdict, rule) of the longest rule that fits, or None.

    More host labels win first; under the same labels, the longer path.
    """
    segments = path.split("/")
    best = _longest_path(trie["path"], segments) if trie["path"] else None
    node = trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        if node["path"]:
            best = _longest_path(node["path"], segments) or best
    return best


def host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a URL without ``://``."""
    url = F.coalesce(pages[url_col], F.lit(""))
    part = r"://([^/?#]*)([^?#]*)"
    return pages.withColumns({
        "host": ascii_lower(F.regexp_extract(url, part, 1)),
        "path": F.regexp_extract(url, part, 2),
    })


def url_filter(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """One row per page: ``id_col``, host, path, rule (null if none), verdict."""
    if sum(len(rule.encode()) for _, rule in rules) > MAX_RULE_BYTES:
        raise ValueError(f"the rules exceed {MAX_RULE_BYTES} bytes; split the list")
    trie = pages.sparkSession.sparkContext.broadcast(compile_rules(rules))
    cut = host_path(pages.select(pages[id_col], pages[url_col].alias("url")))

    def judge(batches):
        for batch in batches:
            found = [lookup(trie.value, h, p) for h, p in
                     zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns,
                 pa.array([f and f[1] for f in found], pa.string()),
                 pa.array([f[0] if f else default for f in found], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"])

    cut = cut.select(id_col, "host", "path")
    kind = cut.schema[id_col].dataType.simpleString()
    return cut.mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
